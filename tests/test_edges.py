"""Odd values, sources and sinks, models."""

from __future__ import annotations

import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from logweir.functions import scalar as S
from logweir.operators import anomaly, attack, batches, filters, registry, typed, vector33
from logweir.operators.training import train_job
from logweir.plans.queries import vectors
from logweir.sources import logs

from .conftest import SMALL


def one(spark, value, kind, *columns):
    return spark.createDataFrame([(value,)], f"x {kind}").select(*columns).first()


@pytest.mark.parametrize(("ip", "first"), [("999.1.1.1", 0.0), ("1.2.3.4.", 1 / 255), ("::1", 0.0), (None, 0.0), ("", 0.0), ("1.2.3", 0.0), ("10.0.0.1", 10 / 255)])
def test_addresses(spark, ip, first):
    row = one(spark, ip, "string", *S.enc_ip5(F.col("x")))
    assert row[0] == pytest.approx(first) and row[4] == (1.0 if ip == "10.0.0.1" else 0.0)


def test_octets_without_a_range_check(spark):
    assert one(spark, "999.1.1.1", "string", vector33.ip_octets4(F.col("x"))[0])[0] == pytest.approx(999 / 255)


@pytest.mark.parametrize(("uri", "path", "params"), [("/", 0, 0.0), ("a?", 1 / 20, 0.0), ("/a/b?x=1&y=2", 3 / 20, 2 / 50), ("?", None, 0.0), ("", 0.0, 0.0), (None, 0.0, 0.0)])
def test_uris(spark, uri, path, params):
    row = one(spark, uri, "string", *S.enc_uri6(F.col("x")))
    assert row[1] == (None if path is None else pytest.approx(path)) and row[3] == pytest.approx(params)


@pytest.mark.parametrize(("status", "share"), [(0, 0.0), (404, 404 / 600), (700, 599 / 600), (None, 0.0), (-5, 0.0)])
def test_statuses(spark, status, share):
    assert one(spark, status, "int", S.enc_status6(F.col("x"))[0])[0] == pytest.approx(share)


def test_numbers(spark):
    assert one(spark, float("nan"), "double", S.safe_log(F.col("x")))[0] == 0.0
    assert one(spark, -3, "long", S.norm_bytes(F.col("x")))[0] == 0.0
    assert one(spark, None, "int", S.norm_port(F.col("x")))[0] == 0.0
    assert one(spark, " x ", "string", S.parse_ts(F.col("x")))[0] == 0.0
    assert one(spark, "sf", "string", S.enc_conn_state(F.col("x")))[0] == 0.0
    assert one(spark, "...", "string", S.parts(F.col("x"), "."))[0] == 0


def test_a_gap_of_an_hour_is_none(spark):
    rows = [(1, 1_000_000), (2, 1_000_000), (3, 3_601_000_000), (4, 3_601_500_000)]
    df = spark.createDataFrame(rows, "seq long, us long").withColumn("orig_h", F.lit("a")).withColumn("resp_p", F.lit(1))
    got = {r.seq: r.iat_mean for r in vector33.iat_stats(vector33.interaction(df)).collect()}
    assert got == {1: 0.0, 2: 0.0, 3: 0.0, 4: 0.5}


def test_a_uri_of_question_marks_drops_its_record(spark):
    from logweir.plans.queries import http_view

    rows = http_view(spark, SMALL).withColumn("uri", F.when(F.col("seq") == 0, "??").otherwise(F.col("uri")))
    assert typed.encode_dispatch(rows, "HTTP").count() == rows.count() - 1
    assert typed.encode_dispatch(rows, "other").count() == 0


def test_uids_and_types(spark):
    rows = ['{"uid":"","zeek-conn":{"uid":"C1"}}', '{"zeek-dns":{"uid":"D1","query":null,"rcode_name":"x"}}', '{"a":1}', "broken"]
    df = logs.decode_json(spark.createDataFrame([(x,) for x in rows], "value string"))
    assert [r.u for r in df.select(filters.extract_uid(F.col("value")).alias("u")).collect()] == [None, "D1", None]
    assert [r.t for r in df.select(filters.infer_log_type(F.col("value")).alias("t")).collect()] == [None, "dns", None]


def test_packed_vectors(spark):
    df = spark.createDataFrame([(struct.pack("<2d", 1.5, -2.0),), (b"abc",), (None,)], "b binary")
    assert [r.v for r in df.select(logs.decode_packed("b").alias("v")).collect()] == [[1.5, -2.0], None, None]


def test_store_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([(i, [float(i + j) for j in range(10)], None) for i in range(3)] + [(9, [1.0], None)], "id long, features array<double>, timestamp timestamp")
    logs.append_features(rows, str(tmp_path / "store"), "conn", 10)
    logs.append_features(rows, str(tmp_path / "store"), "dns", 10)
    store = spark.read.parquet(str(tmp_path / "store"))
    assert [r.id for r in logs.load_features(store, "conn", 10).collect()] == [0, 1, 2]
    assert registry.clear_type(store, "conn").count() == 3


def test_files(spark, tmp_path):
    (tmp_path / "ips").write_text("# list\n 10.0.0.1 \n\n10.0.0.2\n")
    assert {r.ip for r in logs.load_ip_list(spark, str(tmp_path / "ips")).collect()} == {"10.0.0.1", "10.0.0.2"}
    assert logs.load_ip_list(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "a.csv").write_text("id,attack_cat\n1,DoS\n")
    (tmp_path / "b.csv").write_text("id,attack_cat\n2,Normal\n")
    assert {(r.id, r.split) for r in logs.read_labelled(spark, str(tmp_path / "a.csv"), str(tmp_path / "b.csv")).collect()} == {(1, "train"), (2, "test")}
    records = spark.createDataFrame([("t", i, v) for i, v in enumerate(("b", "a", "b", "c"))], "topic string, offset long, value string")
    logs.export_topics(records, str(tmp_path / "out"), most=2, dedup=True)
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect()) == ["a", "b"]
    options = logs.kafka_options(" h:9 ", [" zeek-conn ", "zeek-dns"])
    assert options["subscribe"] == "zeek-conn,zeek-dns" and options["startingOffsets"] == "earliest"


def test_fifty_records_make_one_batch_and_one_is_emitted(spark):
    rows = spark.range(50).select(F.col("id").alias("seq"), F.concat(F.lit("10.0.0."), (F.col("id") % 8).cast("string")).alias("src"), F.when(F.col("id") == 0, 0.9).otherwise(0.1).alias("mae"))
    b = batches.score_batches(rows.withColumn("t", F.lit("conn")), ["t"], ["seq"])
    assert b.select("batch_id").distinct().count() == 1
    assert filters.over_threshold(b, "mae", 0.5).count() == 1


def test_learning_keeps_the_newest(spark):
    rows = spark.range(100).withColumn("t", F.lit("conn"))
    kept = batches.learning_batches(rows, ["t"], ["id"], 10, 3)
    assert sorted(r.id for r in kept.collect()) == list(range(70, 100))


def test_adaptive_threshold_equals_percentiles(spark):
    rng = np.random.default_rng(1)
    s = rng.random(2600)
    df = spark.createDataFrame([("c", i + 1, i // 50, float(x)) for i, x in enumerate(s)], "t string, place long, batch_id long, mae double")
    got = {r.batch_id: r.threshold for r in anomaly.adaptive_threshold(df, None, ["t"]).collect()}
    for b in range(52):
        h = s[max(0, b * 50 - 1000) : b * 50]
        assert got[b] == pytest.approx(0.1 if len(h) < 100 else min(1.0, max(0.001, float(np.percentile(h, 95)))))


def test_planted_outliers_rebuild_worse(spark):
    rng = np.random.default_rng(0)
    base = rng.normal(size=(300, 3)) @ rng.normal(size=(3, 33))
    base[250] += rng.normal(size=33) * 20
    store = spark.createDataFrame([(i, "conn", r.tolist()) for i, r in enumerate(base)], "id long, log_type string, features array<double>")
    trained = train_job(store, "conn", components=8)
    assert trained.basis == "validation" and trained.rows == 300
    w = batches.train_windows(store.select("id", "features"), [], ["id"]).select("place", "window")
    mae, _ = anomaly.window_error(F.col("window"), F.col("rebuilt"))
    scaled = anomaly.minmax_apply_fit(w.select("place", F.posexplode("window").alias("step", "features")), trained.fit)
    w = scaled.groupBy("place").agg(F.transform(F.sort_array(F.collect_list(F.struct("step", "features"))), lambda s: s["features"]).alias("window"))
    scores = {r.place: r.mae for r in anomaly.reconstruct(w, trained.model).select("place", mae.alias("mae")).collect()}
    hit = [scores[p] for p in scores if 251 <= p <= 260]  # windows that hold the planted row
    assert min(hit) > np.quantile([s for p, s in scores.items() if not 251 <= p <= 260], 0.9)
    assert train_job(store.limit(5), "conn") is None


def test_standardised_and_normal_values(spark):
    df = vectors(spark, SMALL).select(F.col("vec_id").alias("id"), F.col("features")[0].alias("x"))
    z = attack.standardize(df, attack.standard_fit(df, ["x"]), ["x"]).agg(F.avg("x"), F.stddev_pop("x")).first()
    assert z[0] == pytest.approx(0, abs=1e-9) and z[1] == pytest.approx(1)
    q = attack.quantile_fit(df, "x", 100)
    n = df.select(attack.quantile_normal(F.col("x"), q).alias("n")).agg(F.avg("n"), F.max("n")).first()
    assert abs(n[0]) < 0.05 and 2 < n[1] < 5.3


def test_negative_thresholds_are_rejected(spark):
    with pytest.raises(ValueError):
        registry.set_threshold(spark.createDataFrame([("a", 1.0)], "log_type string, anomaly_threshold double"), "a", -1)


def test_the_entry_point_gives_the_flagship(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["seq", "src", "mae"]
    assert set(entry.oracle_sql()) <= set(entry.queries())


def _exchanges(df):
    """Shuffles by key in the plan, broadcasts left out."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum("Exchange " in line and "BroadcastExchange" not in line for line in plan.splitlines())


def test_a_hot_source_in_ranges_counts_as_in_one_task(spark, monkeypatch):
    from logweir.functions import frames

    step = F.when(F.col("seq") % 7 == 0, 0).when(F.col("seq") % 11 == 0, 3_600_000_000).otherwise(F.col("seq") % 5 * 1000 + 1)
    rows = spark.range(1, 900).withColumnRenamed("id", "seq").withColumn("src", F.when(F.col("seq") % 9 == 0, F.lit(None)).otherwise(F.when(F.col("seq") % 4 == 0, "b").otherwise("hot")))
    from pyspark.sql import Window

    rows = rows.withColumn("us", F.sum(step).over(Window.partitionBy(F.lit(1)).orderBy("seq")) + 1).withColumn("k", F.when(F.col("seq") % 3 == 0, F.lit(None)).otherwise(F.col("seq") % 2))
    rows = frames.stored(rows, "t")
    plain = {r.seq: r for r in frames.last_gaps(rows, ["src"], ["us", "seq"], 50, "g").collect()}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    ranged = frames.ranged(rows, ["src"], ["us", "seq"])
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert ranged.select("__pid").distinct().count() > 2
    counters = {"a": ["src", "k"], "b": ["src"], "c": ["k", "src"]}
    with_counts = frames.hot_counts(ranged, counters, ["us", "seq"], 100)
    after_counts = frames.hot_gaps(ranged, "src", ["us", "seq"], 50, "g", with_counts)
    assert _exchanges(after_counts) == _exchanges(with_counts)  # full rows are dealt once for both
    many = ranged.drop("__pid").repartitionByRange(60, "src", "us", "seq").withColumn("__pid", F.spark_partition_id())
    many = frames.stored(many, "many")  # few gaps in each range, so frames reach over several
    for got in (frames.hot_gaps(ranged, "src", ["us", "seq"], 50, "g"), after_counts, frames.hot_gaps(many, "src", ["us", "seq"], 50, "g")):
        got = got.collect()
        assert len(got) == 899 and sum(r.g_gap is not None for r in got) > 300
        for r in got:
            p = plain[r.seq]
            assert r.g_gap == p.g_gap
            if r.g_gap is not None:
                assert r.g_mean == pytest.approx(p.g_mean) and r.g_std == pytest.approx(p.g_std, abs=1e-9)
    counted = with_counts
    tasks = counted.select("__pid", F.spark_partition_id().alias("task")).distinct().collect()
    assert len(tasks) == len({r.task for r in tasks}) == len({r["__pid"] for r in tasks})  # a task for each range
    counts = counted.collect()
    seen = {}
    for r in sorted(counts, key=lambda r: (r.us, r.seq)):
        for name, keys in counters.items():
            at = (name, *(r[k] for k in sorted(keys)))
            seen[at] = seen.get(at, 0) + 1
            assert r[name] == min(seen[at], 100)


def test_ranges_grow_with_the_bytes_of_the_input(spark, monkeypatch):
    from logweir.functions import frames

    rows = frames.stored(spark.range(20_000).select(F.col("id").alias("seq"), (F.col("id") % 3).alias("src")), "t")
    size = frames.input_bytes(rows)
    assert 0 < size < 1 << 20
    twice = rows.join(rows.withColumnRenamed("src", "other"), "seq")
    assert frames.input_bytes(twice) == 2 * size  # not their product
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert frames.ranged(rows, ["src"], ["seq"]).select("__pid").distinct().count() <= usual
    monkeypatch.setattr(frames, "RANGE_BYTES", size // (3 * usual))
    ranged = frames.ranged(rows, ["src"], ["seq"])
    assert 2 * usual < ranged.select("__pid").distinct().count() <= 4 * usual
    got = frames.numbered(rows, ["src"], ["seq"], "n")
    assert got.count() == 20_000 and got.filter("n <> seq div 3 + 1").count() == 0
    unknown = spark.createDataFrame(rows.rdd)  # its size isn't known, so it has the usual number
    assert frames.input_bytes(unknown) == 0
    assert frames.ranged(unknown, ["src"], ["seq"]).select("__pid").distinct().count() <= usual


def test_quantiles_and_normal_values_equal_plain_ones(spark):
    from statistics import NormalDist

    from logweir.functions import frames

    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(size=700), np.zeros(300)])
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)] + [(-1, None)], "id long, x double")
    shares = [i / 99 for i in range(100)]
    assert np.allclose(frames.exact_quantiles(df, "x", shares), np.quantile(x, shares))
    assert frames.exact_quantiles(df.limit(0), "x", shares) == []
    q = np.array(attack.quantile_fit(df, "x", 100))
    p = np.linspace(0, 1, 100)
    for r in df.filter("x is not null").select("x", attack.quantile_normal(F.col("x"), q.tolist()).alias("z")).collect():
        below, upto = np.interp(r.x, q, p), 1 - np.interp(-r.x, -q[::-1], 1 - p[::-1])
        rank = (below + upto) / 2
        assert r.z == pytest.approx(NormalDist().inv_cdf(min(max(rank, 1e-7), 1 - 1e-7)), abs=1e-6)
