"""Streams with timers, seeds, watermarks, failing stores, clocks and switches; models that are saved and loaded."""

from __future__ import annotations

import json
import os
import time
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from logweir.operators import anomaly, attack, attack_pipeline, batches, registry, training, vector33
from logweir.plans.queries import QUERIES
from logweir.plans.views import flows
from logweir.sources import logs
from logweir.streaming import reload, stateful, timed

from .conftest import SMALL
from .test_streaming import history

ROW = "log_type string, n long, note string, at timestamp, x double"


def rows_of(spark, numbers, log_type="conn"):
    return spark.createDataFrame([(log_type, i, None if i % 3 else f"note {i}", None, i / 7) for i in numbers], ROW)


def source_of(spark, folder, schema=ROW, **options):
    return spark.readStream.schema(schema).options(**options).parquet(str(folder))


def wait_for(query, done, seconds=90):
    ends = time.time() + seconds
    while not done():
        assert query.exception() is None and time.time() < ends
        time.sleep(0.3)


def read(spark, folder, schema):
    return spark.read.schema(schema).parquet(str(folder)) if os.path.exists(folder) else spark.createDataFrame([], schema)


def test_rows_that_no_other_follows_are_flushed(spark, tmp_path):
    rows_of(spark, range(49)).coalesce(1).write.parquet(str(tmp_path / "in"))
    made = timed.batches_by_time(source_of(spark, tmp_path / "in"), ["log_type"], ["n"])
    q = stateful.write_batches(made, str(tmp_path / "out"), str(tmp_path / "check"), once=False, every="100 milliseconds")
    try:
        wait_for(q, lambda: read(spark, tmp_path / "out", made.schema).count() == 49)
        rows_of(spark, range(49, 160)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))  # two full batches and eleven rows
        wait_for(q, lambda: read(spark, tmp_path / "out", made.schema).count() == 160)
    finally:
        q.stop()
    got = read(spark, tmp_path / "out", made.schema).orderBy("place").collect()
    assert [r.n for r in got] == list(range(160)) and [r.place for r in got] == list(range(1, 161))
    assert [r.batch_id for r in got] == [0] * 49 + [1] * 50 + [2] * 50 + [3] * 11
    assert [r.slot for r in got] == [*range(49), *range(50), *range(50), *range(11)]
    assert all(r.x == r.n / 7 and r.note == (None if r.n % 3 else f"note {r.n}") and r["at"] is None for r in got)


def test_thresholds_of_a_stream_equal_the_table(spark, tmp_path):
    rng = np.random.default_rng(0)
    scores = [None if i % 97 == 5 else float(x) for i, x in enumerate(rng.gamma(2.0, 0.1, 2600))]
    rows = spark.createDataFrame([("a" if i % 3 else "b", i // 3 if i % 3 == 0 else i - i // 3 - 1, s) for i, s in enumerate(scores)], "log_type string, n long, mae double")
    held = batches.score_batches(rows, ["log_type"], ["n"])
    for i in range(4):  # batches are cut by micro-batches
        held.filter((F.col("place") > i * 330) & (F.col("place") <= (i + 1) * 330 if i < 3 else F.lit(True))).coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
        time.sleep(0.05)
    source = source_of(spark, tmp_path / "in", held.schema, maxFilesPerTrigger=1, recursiveFileLookup=True)
    stateful.write_batches(timed.adaptive_stream(source, 0.3, ["log_type"]), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination(240)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == 2600
    by = {(r.log_type, r.batch_id): (round(r.threshold, 9), r.drift_clamped) for r in got.select("log_type", "batch_id", "threshold", "drift_clamped").distinct().collect()}
    assert by == {(r.log_type, r.batch_id): (round(r.threshold, 9), r.drift_clamped) for r in anomaly.adaptive_threshold(held, 0.3, ["log_type"]).collect()}
    assert all(r.is_anomaly == (r.mae is not None and r.mae >= r.threshold) for r in got.collect())


def test_last_scores():
    rng = np.random.default_rng(1)
    seen, line = timed.LastScores([], 50), []
    for x in [*rng.normal(size=200), float("nan"), 1.0, 1.0, *rng.normal(size=30)]:
        seen.add(x)
        line = [*line, x][-50:]
        some = [v for v in line if v == v]
        assert seen.sizes == sorted(some) and abs(seen.quantile(0.95) - np.quantile(some, 0.95)) < 1e-12
    assert timed.bounded_threshold(timed.LastScores([]), None) == (anomaly.BASE_DEFAULT, False)
    assert timed.bounded_threshold(timed.LastScores([9.0] * 1000), 0.2) == (0.4, True)


class FailingStore:
    """A store that is away while a file is there."""

    def __init__(self, folder):
        self.folder, self.files = str(folder), logs.BatchFiles(f"file://{folder}/kept")

    def __call__(self, key, number, rows):
        if os.path.exists(f"{self.folder}/away"):
            raise ConnectionError("away")
        self.files(key, number, rows)


def kept(folder):
    """Lines of all batches in order of their numbers."""
    files = sorted((f for f in os.listdir(folder) if f.endswith(".json") and not f.startswith(("_", "."))), key=lambda f: int(f.split("-")[-1][:-5]))
    return [json.loads(line) for f in files for line in open(f"{folder}/{f}")]


def test_rows_wait_while_the_store_is_away(spark, tmp_path):
    (tmp_path / "away").touch()
    rows_of(spark, range(25)).coalesce(1).write.parquet(str(tmp_path / "in"))
    made = timed.collected(source_of(spark, tmp_path / "in"), ["log_type"], ["n"], FailingStore(tmp_path), size=10, keep=3, wait_ms=300)
    q = stateful.write_batches(made, str(tmp_path / "out"), str(tmp_path / "check"), once=False, every="100 milliseconds")
    told = lambda: read(spark, tmp_path / "out", made.schema)
    try:
        wait_for(q, lambda: told().filter("not stored").count() >= 2)  # once for the rows, then by the timer
        rows_of(spark, range(25, 40)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        wait_for(q, lambda: told().agg(F.max("dropped")).first()[0] == 10)
        (tmp_path / "away").unlink()
        wait_for(q, lambda: (told().filter("stored").agg(F.sum("rows")).first()[0] or 0) == 30)
    finally:
        q.stop()
    assert [r["n"] for r in kept(tmp_path / "kept")] == list(range(10, 40))  # the newest thirty, in order, once each
    assert set(r.failure for r in told().filter("not stored").collect()) == {"ConnectionError"}
    assert [(r.number, r.rows) for r in told().filter("stored").orderBy("number").collect()] == [(0, 10), (1, 10), (2, 10)]


def test_collection_ends_with_the_switch(spark, tmp_path):
    rows_of(spark, range(7)).withColumn("learning", F.col("n") < 5).coalesce(1).write.parquet(str(tmp_path / "in"))
    source = source_of(spark, tmp_path / "in", ROW + ", learning boolean")
    made = timed.collected(source, ["log_type"], ["n"], logs.BatchFiles(f"file://{tmp_path}/kept"), learning="learning", size=10, wait_ms=3_600_000)
    stateful.write_batches(made, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination(120)
    assert [r["n"] for r in kept(tmp_path / "kept")] == list(range(5))


def test_a_failed_batch_is_written_over(tmp_path):
    store = logs.BatchFiles(f"file://{tmp_path}", fails_first=1)
    store(("a",), 0, ['{"n":1}', "{}"])
    with pytest.raises(OSError):
        store(("a",), 1, ['{"n":2}'])
    store(("a",), 1, ['{"n":2}'])
    store(("a",), 1, ['{"n":3}'])
    assert kept(tmp_path) == [{"log_type": "a", "number": 0, "n": 1}, {"log_type": "a", "number": 0}, {"log_type": "a", "number": 1, "n": 3}]


@pytest.mark.parametrize("cut", [1999, 2000, 2001, 2500])
def test_streams_go_on_from_a_table(spark, tmp_path, cut):
    base = flows(spark, SMALL).withColumn("orig_h", F.when(F.col("seq") % 40 == 0, "10.9.9.9").otherwise("10.0.0.1"))
    many = base.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(2)))).select(*[(F.col("seq") * 3 + F.col("k")).alias("seq") if x == "seq" else (F.col("us") + F.col("k") * 1000).alias("us") if x == "us" else x for x in base.columns])
    many = many.withColumn("at", F.expr("row_number() over (order by us, seq)")).persist()
    rest = many.filter(F.col("at") > cut).drop("at")
    rest.coalesce(1).write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(rest.schema).parquet(str(tmp_path / "in"))
    made = stateful.stateful_history(source, history=many.filter(F.col("at") <= cut).drop("at"))
    stateful.write_batches(made, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination(240)
    whole = history(vector33.iat_stats(vector33.interaction(many.drop("at"))).collect())
    got = history(spark.read.parquet(str(tmp_path / "out")).collect())
    assert len(got) == many.count() - cut and all(whole[k] == v for k, v in got.items())
    many.unpersist()


def test_stateful_queries_in_a_session_of_other_settings(spark):
    key, default = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    other = spark.newSession()
    other.conf.set(key, default)
    assert QUERIES["stateful_vector33"](other, SMALL).count() == 1000
    assert QUERIES["stateful_session"](other, SMALL).count() > 0
    assert other.conf.get(key) == default and other.conf.get("spark.sql.streaming.noDataMicroBatches.enabled") == "true"


def timed_rows(spark, rows):
    return spark.createDataFrame(rows, "uid string, record string, s long").select("uid", "record", F.timestamp_seconds("s").alias("time"))


def test_joined_streams_let_state_go(spark, tmp_path):
    raw = [(f"u{i % 50}", f"r{i}", 1_000_000 + i) for i in range(400)]
    bad = [(f"u{i % 50}", f"m{i}", 1_000_000 + i + 5) for i in range(0, 400, 7)]
    later = 1_000_000 + 90_000
    for part, (r, m) in enumerate([(raw, bad), ([("z", "r", later)], [("z", "m", later + 1)]), ([("z", "r2", later + 90_000)], [("z", "m2", later + 90_000)])]):
        timed_rows(spark, r).coalesce(1).write.mode("append").parquet(str(tmp_path / "raw"))
        timed_rows(spark, m).coalesce(1).write.mode("append").parquet(str(tmp_path / "bad"))
        schema = "uid string, record string, time timestamp"
        joined = reload.session_join_stream(source_of(spark, tmp_path / "bad", schema), source_of(spark, tmp_path / "raw", schema), 60, "10 seconds")
        q = stateful.write_batches(joined, str(tmp_path / "out"), str(tmp_path / "check"))
        q.awaitTermination(240)
        held = q.lastProgress["stateOperators"][0]["numRowsTotal"]
        if part == 0:
            assert held >= 400
    assert held <= 6  # the watermark has passed all but the last rows
    got = Counter((r.malicious, r.raw) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    want = Counter((m, r) for u, m, t in bad for v, r, s in raw if u == v and t - 60 <= s <= t) + Counter([("m", "r"), ("m2", "r2")])
    assert got == want


def test_repeats_across_micro_batches_go(spark, tmp_path):
    schema = "value string, time timestamp"
    rows = lambda part: spark.createDataFrame(part, "value string, s long").select("value", F.timestamp_seconds("s").alias("time"))
    for part in ([("a", 1_000_000), ("a", 1_000_001), (None, 1_000_002)], [("a", 1_000_100), ("b", 1_000_101), (None, 1_000_102)], [("c", 1_100_000)], [("d", 1_100_000)], [("a", 1_100_001), ("c", 1_100_002)]):
        rows(part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        q = stateful.write_batches(reload.dedup_stream(source_of(spark, tmp_path / "in", schema), ["value"], "1 hour"), str(tmp_path / "out"), str(tmp_path / "check"))
        q.awaitTermination(120)
    assert Counter(r.value for r in spark.read.parquet(str(tmp_path / "out")).collect()) == Counter(["a", None, "b", "c", "d", "a"])  # a came again when its hour was over
    assert q.lastProgress["stateOperators"][0]["numRowsTotal"] <= 3


def test_small_tables_are_read_by_the_clock(spark, tmp_path):
    now, at = [0.0], str(tmp_path / "ips.txt")
    listed = reload.reloaded_list(spark, at, lambda: logs.load_ip_list(spark, at), lambda: now[0])
    ips = lambda: sorted(r.ip for r in listed().collect())
    (tmp_path / "ips.txt").write_text("10.0.0.1\n# no\n")
    assert ips() == ["10.0.0.1"] and listed.reads == 1
    (tmp_path / "ips.txt").write_text("10.0.0.2\n")
    os.utime(at, (time.time() + 50, time.time() + 50))
    (tmp_path / ".ips.txt.crc").unlink(missing_ok=True)
    now[0] = 9.9
    assert ips() == ["10.0.0.1"] and listed.reads == 1  # not looked at yet
    now[0] = 10.0
    assert ips() == ["10.0.0.2"] and listed.reads == 2
    now[0] = 25.0
    assert ips() == ["10.0.0.2"] and listed.reads == 2  # looked at, unchanged
    held, models = [0.0], lambda: spark.createDataFrame([("conn", held[0])], "log_type string, anomaly_threshold double")
    limits = reload.reloaded_threshold(models, lambda: now[0])
    assert limits().first().anomaly_threshold == 0.0
    held[0], now[0] = 0.7, 25.0 + 299
    assert limits().first().anomaly_threshold == 0.0
    now[0] = 25.0 + 300
    assert limits().first().anomaly_threshold == 0.7 and limits.reads == 2
    gone = reload.Reloaded(lambda: 1 / 0, 1)
    with pytest.raises(ZeroDivisionError):
        gone()
    limits.read, now[0] = (lambda: 1 / 0), 10_000.0
    assert limits().first().anomaly_threshold == 0.7  # what was at hand stays


def test_routes_after_a_batch_that_runs_again(spark, tmp_path):
    on = [True]
    status = lambda: spark.createDataFrame([("conn", on[0])], "log_type string, enabled boolean")

    def run():
        q = reload.routed_stream(source_of(spark, tmp_path / "in"), status, lambda b: b.withColumn("mae", F.col("x")), str(tmp_path / "stored"), str(tmp_path / "scored"), str(tmp_path / "check"))
        q.awaitTermination(120)

    rows_of(spark, range(10)).write.parquet(str(tmp_path / "in"))
    rows_of(spark, range(10, 14), "dns").write.mode("append").parquet(str(tmp_path / "in"))
    run()
    on[0] = False
    rows_of(spark, range(20, 30)).write.mode("append").parquet(str(tmp_path / "in"))
    run()
    found = lambda name: sorted(r.n for r in spark.read.parquet(str(tmp_path / name)).collect())
    assert found("stored") == list(range(10)) and found("scored") == [*range(10, 14), *range(20, 30)]
    last = max(int(f) for f in os.listdir(tmp_path / "check/commits") if f.isdigit())
    for f in (f"{last}", f".{last}.crc"):
        (tmp_path / "check/commits" / f).unlink(missing_ok=True)
    run()  # the last micro-batch again
    assert found("stored") == list(range(10)) and found("scored") == [*range(10, 14), *range(20, 30)]


def stored_vectors(spark, n=120, log_type="conn"):
    rng = np.random.default_rng(3)
    return spark.createDataFrame([(i, log_type, [float(x) for x in np.sin(i / 5 + np.arange(4)) + rng.normal(0, 0.05, 4)]) for i in range(n)], "id long, log_type string, features array<double>")


def test_models_lie_where_their_row_says(spark, tmp_path):
    rows = stored_vectors(spark)
    empty = spark.createDataFrame([], "log_type string, model_path string, created_at timestamp, anomaly_threshold double")
    tables = training.Registry(rows, empty, spark.createDataFrame([], "log_type string, count long"))
    trained, after = training.run_training(tables, "conn", f"file://{tmp_path}/one", pd.Timestamp("2030-01-01").to_pydatetime(), components=5)
    want = {r.id: (r.mae, r.is_anomaly) for r in training.score_rows(rows, trained, [], ["id"]).collect()}
    del trained
    loaded = training.load_latest(after.models, "conn")
    got = {r.id: (r.mae, r.is_anomaly) for r in training.score_rows(rows, loaded, [], ["id"]).collect()}
    assert len(want) == 111 and got.keys() == want.keys() and all(abs(got[i][0] - want[i][0]) < 1e-12 and got[i][1] == want[i][1] for i in want)
    # the parts alone, by hand
    parts = pd.read_parquet(tmp_path / "one")
    scaler = np.stack(parts[parts.part == "scaler"].sort_values("i").x)
    mean, axes = parts[parts.part == "mean"].x.iloc[0], np.stack(parts[parts.part == "axes"].sort_values("i").x)
    x = (np.array([r.features for r in rows.orderBy("id").collect()]) - scaler[:, 0]) / np.where(scaler[:, 1] == 0, 1, scaler[:, 1])
    for i in (9, 50, 119):
        w = x[i - 9 : i + 1].ravel() - mean
        assert abs(np.abs(w - w @ axes @ axes.T).mean() - want[i][0]) < 1e-9
    row = after.models.first()
    assert (row.input_dim, row.timesteps, row.training_samples) == (4, 10, 120)
    assert training.load_latest(after.models, "dns") is None
    training.save_model(loaded, f"file://{tmp_path}/two")
    later = registry.save_model_row(after.models, spark.createDataFrame([("conn", f"file://{tmp_path}/two", pd.Timestamp("2031-01-01").to_pydatetime(), 0.5)], "log_type string, model_path string, created_at timestamp, anomaly_threshold double"))
    assert training.load_latest(later, "conn").threshold == loaded.threshold
    spark.read.parquet(str(tmp_path / "two")).filter("part <> 'limit'").write.parquet(str(tmp_path / "torn"))
    with pytest.raises(ValueError):
        training.load_model(spark, f"file://{tmp_path}/torn")


def test_a_pipeline_keeps_its_codes(spark, tmp_path):
    rows = spark.createDataFrame([(float(i % 2), 1.0, float(i % 2 * 10 + i % 3), 2.0, ("tcp", "udp")[i % 2], "http", "SF") for i in range(60)], "y double, weight double, spkts double, dpkts double, proto string, service string, state string")
    made = attack_pipeline.attack_pipeline(["spkts", "pkt_diff", "proto"], scaled=("spkts",), trees=3, depth=3).fit(rows)
    made.write().overwrite().save(f"file://{tmp_path}/p")
    loaded = attack_pipeline.PipelineModel.load(f"file://{tmp_path}/p")
    asked = spark.createDataFrame([(0, 3.0, 1.0, "udp", "x", None), (1, None, 1.0, "sctp", "http", "SF"), (2, 11.0, 2.0, None, "http", "SF")], "id long, spkts double, dpkts double, proto string, service string, state string")
    before, after = ({r.id: r for r in attack_pipeline.predict_with(m, asked).collect()} for m in (made, loaded))
    assert before == after
    assert [(after[i].proto, after[i].service, after[i].state) for i in range(3)] == [(1.0, -1.0, -1.0), (-1.0, 0.0, 0.0), (-1.0, 0.0, 0.0)]
    plain = attack.engineer_features(asked)
    assert [r.pkt_diff for r in plain.orderBy("id").collect()] == [after[i].pkt_diff for i in range(3)]
    mean, std = np.mean([r.spkts for r in rows.collect()]), np.std([r.spkts for r in rows.collect()])
    assert abs(after[0].spkts - (3.0 - mean) / std) < 1e-12
