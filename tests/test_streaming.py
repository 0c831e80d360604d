"""Streams give what tables give, and row-by-row simulations agree."""

from __future__ import annotations

from math import sqrt

from pyspark.sql import functions as F

from logweir.operators import sessions, vector33
from logweir.plans.queries import malicious_talk, talk
from logweir.plans.views import flows
from logweir.streaming import stateful

from .conftest import SMALL


def simulate(rows):
    """Flow counts, ports and gaps of sources, one row at a time."""
    state, out = {}, {}
    for r in rows:
        src = r.orig_h or "unknown"
        n, last, gaps, ports = state.get(src, (0, 0, [], set()))
        if n == 2000:
            n, last, gaps, ports = 0, 0, [], set()
        n, ports = n + 1, ports | {r.resp_p}
        gap = r.us - last
        if last > 0 and 0 < gap < 3_600_000_000:
            gaps = [*gaps, gap][-100:]
        state[src] = (n, r.us, gaps, ports)
        mean = sum(gaps) / len(gaps) if gaps else 0.0
        std = sqrt(sum((g - mean) ** 2 for g in gaps) / len(gaps)) if gaps else 0.0
        out[r.seq] = (n, len(ports), round(mean / 1e6, 4), round(std / 1e6, 3))
    return out


def history(rows):
    return {r.seq: (r.flow_count, r.distinct_ports, round(r.iat_mean, 4), round(r.iat_std, 3)) for r in rows}


def test_history_equals_a_simulation_past_an_epoch(spark):
    base = flows(spark, SMALL).withColumn("orig_h", F.lit("10.0.0.1"))
    many = base.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(2)))).withColumn("seq", F.col("seq") * 3 + F.col("k")).withColumn("us", F.col("us") + F.col("k") * 1000)
    held = vector33.iat_stats(vector33.interaction(many))
    assert history(held.collect()) == simulate(many.orderBy("us", "seq").collect())


def test_stream_of_histories_equals_the_table(spark, tmp_path):
    rows = flows(spark, SMALL).select("seq", "us", "orig_h", "resp_p")
    expected = history(vector33.iat_stats(vector33.interaction(rows)).collect())
    half = rows.count() // 2
    for i, part in enumerate((rows.orderBy("us", "seq").limit(half), rows.orderBy(F.desc("us"), F.desc("seq")).limit(rows.count() - half))):
        part.coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
    source = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    q = stateful.write_batches(stateful.stateful_history(source), str(tmp_path / "out"), str(tmp_path / "check"))
    q.awaitTermination(240)
    assert history(spark.read.parquet(str(tmp_path / "out")).collect()) == expected


def test_stream_of_sessions_equals_the_table(spark, tmp_path):
    t = talk(spark, SMALL)
    bad = malicious_talk(t)
    expected = {tuple(r) for r in sessions.session_assemble(t, bad).select("uid", "arrival", "conn", "n_dns", "n_http", "n_ssl").collect()}
    tagged = t.withColumn("trigger", F.lit(0)).unionByName(bad.withColumn("trigger", F.lit(1))).withColumn("arrival", F.col("arrival").cast("long"))
    tagged.coalesce(1).write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(tagged.schema).parquet(str(tmp_path / "in"))
    q = stateful.write_batches(stateful.stateful_session(source), str(tmp_path / "out"), str(tmp_path / "check"))
    q.awaitTermination(240)
    assert {tuple(r)[:6] for r in spark.read.parquet(str(tmp_path / "out")).select("uid", "arrival", "conn", "n_dns", "n_http", "n_ssl").collect()} == expected


def test_scored_stream_drops_trusted_sources(spark, tmp_path):
    rows = flows(spark, SMALL).select("seq", "orig_h")
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    trusted = spark.createDataFrame([("10.0.0.1",)], "ip string")
    q = stateful.score_stream(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")), lambda: trusted, lambda b: b, str(tmp_path / "out"), str(tmp_path / "check"))
    q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).filter("orig_h = '10.0.0.1'").count() == 0
