"""How work is dealt, and that few rows move."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from logweir.operators import attack

from .conftest import SMALL


def test_rows_of_a_class_stay_in_their_tasks(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")  # as for tables whose sizes the optimizer overrates
    try:
        rows = spark.range(0, 4000, 1, 4).select("id", F.when(F.col("id") % 10 == 0, "b").otherwise("a").alias("label"))
        coded = attack.label_encode(rows.withColumn("y", F.col("label")), ("y",)).join(attack.class_weights(rows, "label"), "label")
        tasks = coded.groupBy(F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("n")).collect()
        assert sorted(r.n for r in tasks) == [1000] * 4
        split = attack.stratified_split(rows, "label", "id").groupBy("split").count().collect()
        assert {r.split: r["count"] for r in split} == {"validation": 600, "train": 3400}
    finally:
        spark.conf.set(key, before)


def test_information_by_slots_equals_plain_ranks(spark, monkeypatch):
    monkeypatch.setattr(attack, "SLOTS", 40)
    rng = np.random.default_rng(3)
    n = 6000
    x, few = rng.normal(size=n), rng.integers(0, 5, n).astype(float)
    odd = [None if i % 11 == 0 else float("nan") if i % 13 == 0 else float("-inf") if i % 17 == 0 else -0.0 if i % 3 == 0 else float(v) for i, v in enumerate(np.where(np.arange(n) % 2 == 0, 0.0, x))]
    y = [None if i % 19 == 0 else "a" if v + few[i] > 2 else "b" for i, v in enumerate(x)]
    df = spark.createDataFrame([(float(a), float(b), c, d) for a, b, c, d in zip(x, few, odd, y, strict=True)], "x double, few double, odd double, y string").repartition(4)
    got = {r.feature: r.mi for r in attack.mutual_information(df, ["x", "few", "odd"], "y").collect()}
    for name, values in (("x", x), ("few", few), ("odd", odd)):
        key = [(0, 0) if v is None else (2, 0) if math.isnan(v) else (1, v + 0.0) for v in values]
        rank = {k: r for r, k in reversed(list(enumerate(sorted(key))))}  # the least rank of equal ones
        counts: dict = {}
        for k, label in zip(key, y, strict=True):
            if k != (0, 0):
                counts[32 * rank[k] // n, label] = counts.get((32 * rank[k] // n, label), 0) + 1
        side = lambda i, v: sum(m for k, m in counts.items() if k[i] == v)  # noqa: B023, E731
        assert got[name] == pytest.approx(sum(m / n * math.log(m * n / (side(0, b) * side(1, label))) for (b, label), m in counts.items() if label is not None))
    assert attack.mutual_information(df.limit(0), ["x"], "y").count() == 0


def test_models_see_equal_rows_once(spark):
    base = spark.range(0, 600, 1, 4).select((F.col("id") % 30).cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b"), (F.col("id") % 30 >= 15).cast("double").alias("y"), F.lit(2.0).alias("weight"))
    many = base.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(50)))).withColumn("a", F.when((F.col("copy") == 1) & (F.col("a") == 0), None).otherwise(F.col("a")))
    model = attack.shellcode_model(many, ["a", "b"], rounds=3)
    units = model.counted(many, "y", F.col("weight"))
    assert units.count() == 210 and units.agg(F.sum("__n"), F.sum("weight")).first()[:] == (30_000, 60_000.0)
    odd = spark.createDataFrame([(None, 1.0, 0), (float("nan"), 1.0, 1), (-5.0, None, 0), (99.0, 3.0, 1), (14.0, 2.0, 0), (15.0, 2.0, 1)], "a double, b double, side int")
    for model in (attack.shellcode_model(many, ["a", "b"], rounds=3), attack.attack_model(many, ["a", "b"], trees=9, depth=4)):
        p = attack.predict_attack(model, odd, ["a", "b"])
        assert p.columns == ["a", "b", "side", "probabilities"]
        assert all((r.probabilities[1] > 0.5) == r.side and sum(r.probabilities) == pytest.approx(1) for r in p.collect())


def test_ranges_hold_a_bounded_part_of_the_input(spark, tmp_path, monkeypatch):
    from logweir.functions import frames
    from logweir.streaming import stateful

    rows = frames.stored(spark.range(40_000).select(F.col("id").alias("seq"), (F.col("id") % 3).alias("src")), "t")
    monkeypatch.setattr(frames, "RANGE_BYTES", frames.input_bytes(rows) // 3 + 1)
    ranged = frames.ranged(rows, ["src"], ["seq"])  # adaptive execution would make one of what is as small as this
    assert sorted(r["count"] > 5_000 for r in ranged.groupBy("__pid").count().collect()) == [True] * 4
    seen = []

    def look(batch, number):
        seen.append((frames.input_bytes(batch) > 0, frames.ranged(batch, ["src"], ["seq"]).select("__pid").distinct().count()))

    rows.write.parquet(str(tmp_path / "in"))
    stateful._start(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")), look, str(tmp_path / "check"), True).awaitTermination(120)
    assert seen == [(True, 4)]  # a micro-batch from files has a known size too


def test_a_rate_at_the_threshold_is_no_attack(spark, tmp_path):
    import os

    import duckdb

    from logweir.plans.oracles import SQL
    from logweir.plans.queries import QUERIES

    for name in os.listdir(SMALL):
        if not name.startswith("events"):
            os.symlink(f"{SMALL}/{name}", tmp_path / name)
    ties = [(i, 2, "view", round(2.5 * p - 0.01 + more, 2), f'{{"k": {p}}}') for more in (0.0, -0.01) for i, p in enumerate(p for p in range(1, 50) if p % 10)]
    rows = spark.createDataFrame([(60 + 40 * i + 25, *r[1:]) for i, r in enumerate(ties)], "event_id long, user_id long, event_type string, value double, props string")
    rows = rows.withColumn("ts", F.timestamp_seconds(F.col("event_id") + 1_700_000_000).cast("timestamp_ntz"))
    rows.write.parquet(str(tmp_path / "events.parquet"))
    got = {(r.orig_h, r.label): r.n for r in QUERIES["classify_stream"](spark, str(tmp_path)).collect()}
    with duckdb.connect() as con:
        con.sql(f"create view events as select * from '{tmp_path}/events.parquet/*.parquet'")
        assert got == {(h, label): n for h, label, n in con.sql(SQL["classify_stream"]).fetchall()}
    generic = sum(r[4] is not None and int(r[4][6:-1]) - (60 + 40 * i + 25) % 40 > 25 for i, r in enumerate(ties))
    assert got.get(("10.0.0.2", "Generic"), 0) == generic and sum(got.values()) < len(ties)


def test_all_collected_rows_may_wait(spark, monkeypatch):
    from logweir.plans import queries

    class Seen(Exception):
        pass

    def collected(rows, keys, order, sink, size, keep, wait_ms):
        raise Seen(size * keep)

    monkeypatch.setattr(queries, "scored", lambda spark, d: spark.range(1_500_000).select(F.lit("view").alias("log_type"), F.col("id").alias("event_id")))
    monkeypatch.setattr(queries.timed, "collected", collected)
    with pytest.raises(Seen) as seen:
        queries.q_learning_batches_stream(spark, SMALL)
    assert seen.value.args[0] >= 1_500_000


@pytest.mark.parametrize(("stream", "plain", "keys"), [("stateful_vector33", "vector33", ["seq"]), ("seeded_vector33", "vector33", ["seq"]), ("adaptive_threshold_stream", "adaptive_threshold", ["log_type", "batch_id"])])
def test_streams_in_bounded_micro_batches(spark, monkeypatch, stream, plain, keys):
    from logweir.functions import frames
    from logweir.plans import queries

    bounded = []

    def writes(batches, out, check, **more):
        bounded.append(out)
        return original(batches, out, check, **more)

    original = queries.stateful.write_batches
    monkeypatch.setattr(queries.stateful, "write_batches", writes)
    monkeypatch.setattr(queries, "FILES", 3)
    monkeypatch.setattr(frames, "RANGE_BYTES", 1 << 12)
    got = {tuple(r[k] for k in keys): r for r in queries.QUERIES[stream](spark, SMALL).collect()}
    monkeypatch.setattr(frames, "RANGE_BYTES", 1 << 30)
    whole = {tuple(r[k] for k in keys): r for r in queries.QUERIES[plain](spark, SMALL).collect()}
    assert got and all(whole[k] == r for k, r in got.items()) and (stream == "seeded_vector33" or len(got) == len(whole))
    assert spark.read.parquet(bounded[0]).select("batch").distinct().count() > 1


def test_sessions_are_read_by_several_tasks(spark, monkeypatch):
    from logweir.plans import queries

    seen = []
    monkeypatch.setattr(queries, "talk", lambda spark, d: spark.range(0, 40, 1, 4).select(F.concat(F.lit("V"), F.col("id") % 5).alias("uid"), F.col("id").alias("arrival"), F.lit("conn").alias("log_type"), F.lit("r").alias("record")))
    monkeypatch.setattr(queries, "streamed", lambda rows, *more: seen.append(rows.rdd.getNumPartitions()) or rows.withColumns({"conn": F.lit(""), "n_dns": F.lit(0), "n_http": F.lit(0), "n_ssl": F.lit(0)}))
    queries.q_stateful_session(spark, SMALL)
    assert seen[0] >= 4


def test_records_are_parsed_and_encoded_once(spark):
    from logweir.operators import typed
    from logweir.plans.queries import flows, raw_json
    from logweir.sources import logs

    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert plan(logs.typed_logs(raw_json(spark, SMALL), "conn")).count("from_json(") == 1
    assert plan(typed.encode_dispatch(flows(spark, SMALL), "conn").select("features")).count("tcp") == plan(flows(spark, SMALL).select(typed.vec_conn41().alias("features"))).count("tcp")


def test_only_wanted_columns_are_dealt(spark, monkeypatch):
    from logweir.functions import frames
    from logweir.plans import queries

    dealt, original = [], frames.ranged
    monkeypatch.setattr(frames, "ranged", lambda df, keys, order: dealt.append(set(df.columns)) or original(df, keys, order))
    found = queries.QUERIES["classify_stream_overrides"](spark, SMALL)
    assert found.count() > 0 and dealt and not dealt[0] & {"uid", "ts", "local_orig", "missed_bytes", "log_type"}
    whole = queries.unsw.unsw_conn42(queries.flows(spark, SMALL)).select("seq", "features").collect()
    assert sorted(whole) == sorted(queries.unsw.unsw_conn42(queries.flows(spark, SMALL), keep=["seq"]).collect())


def test_flows_are_numbered_once(spark, monkeypatch):
    from logweir.functions import frames
    from logweir.operators import anomaly, batches, vector33
    from logweir.plans import queries

    numbered, original = [], frames.ranged
    monkeypatch.setattr(frames, "ranged", lambda df, keys, order: numbered.append(keys) or original(df, keys, order))
    queries.QUERIES["anomalous_flows"](spark, SMALL)
    assert numbered == [["src"]]
    monkeypatch.setattr(vector33, "FLOWS_PER_EPOCH", 100)
    held = vector33.vector33(queries.flows(spark, SMALL), place="place")
    names = ["seq", "place", "batch_id", "slot"]
    got = batches.numbered_batches(held).select(*names).collect()
    assert sorted(got) == sorted(batches.score_batches(held.drop("place"), ["src"], ["us", "seq"]).select(*names).collect())
    rows = spark.createDataFrame([([1.0, 5.0],), ([3.0, None],), ([2.0, 5.0],), (None,)], "features array<double>")
    fit = anomaly.minmax_fit(rows.limit(2))
    assert anomaly.minmax_apply_live(rows, fit, width=2).collect() == anomaly.minmax_apply_live(rows, fit).collect()


def test_a_split_reads_full_rows_once_and_loses_none(spark):
    import hashlib

    # one key twice where b is cut, one key for all of c; null is a class
    keys = [(None, f"n{k}") for k in range(200)] + [("a", f"a{k}") for k in range(3000)] + [("b", f"b{k // 2}") for k in range(100)] + [("c", "same")] * 40
    rows = spark.createDataFrame([(label, key, i) for i, (label, key) in enumerate(keys)], "label string, key string, i int").repartition(4)
    split = attack.stratified_split(rows, "label", "key")
    got = split.collect()
    assert split.columns == ["label", "key", "i", "split"] and sorted(r.i for r in got) == list(range(len(keys)))
    h = lambda key: hashlib.md5(f"{key}-42".encode()).hexdigest()
    for label, n in ((None, 30), ("a", 450), ("b", 15), ("c", 6)):
        wanted = sorted(h(key) for of, key in keys if of == label)[:n]
        assert sorted(h(r.key) for r in got if r.label == label and r.split == "validation") == wanted
    plain = attack.stratified_split(rows.filter("label = 'a' or label is null"), "label", "key")
    found = plain._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in found and "Union" not in found and {r.split: r["count"] for r in plain.groupBy("split").count().collect()} == {"validation": 480, "train": 2720}
    assert attack.stratified_split(rows.limit(0), "label", "key").count() == 0
    assert {r.split for r in attack.stratified_split(rows.limit(5), "label", "key").collect()} == {"train"}


def test_what_models_are_tried_on_is_read_once_and_slim(spark):
    from logweir.plans import queries

    held, names = queries.split_items(spark, SMALL)
    assert sorted(held.columns) == sorted([*names, "label", "split", "y", "weight"])
    leaves = held._jdf.queryExecution().optimizedPlan().collectLeaves()
    assert sum("l_returnflag" in leaves.apply(k).toString() for k in range(leaves.size())) <= 2  # another one for line items that share an id at the cut
    i = queries.items(spark, SMALL).withColumn("label", attack.clean_labels(F.col("attack_cat")))
    weights = {r.label: r.weight for r in attack.class_weights(i, "label").collect()}
    coded = attack.label_encode(i.withColumn("y", F.col("label")), ("proto", "service", "state", "y"))
    kinds = ["label", "proto", "service", "state", "y"]
    assert sorted(held.groupBy(*kinds).count().collect()) == sorted(coded.groupBy(*kinds).count().collect())
    assert {(r.label, r.weight) for r in held.select("label", "weight").distinct().collect()} == set(weights.items())


def test_units_are_counted_by_few_integers_and_dealt_once(spark):
    names = [f"f{k}" for k in range(23)]  # more than go into two integers
    value = lambda k: F.when(F.col("id") % 41 == k, None).when(F.col("id") % 43 == k, float("nan")).otherwise(F.floor(F.col("id") / (k + 1)) % (3 * k + 2))
    rows = spark.range(0, 4000, 1, 4).select((F.col("id") % 3).alias("y"), (F.col("id") % 5 + 1).alias("weight"), *[value(k).cast("double").alias(n) for k, n in enumerate(names)])
    model = attack.BinnedModel(names, attack._bin_bounds(rows, names, F.col("weight"), 4000))
    units = model.counted(rows, "y", F.col("weight"))
    plain = model.binned(rows).groupBy(*[F.col(b).cast("byte").alias(b) for b in model.bins], F.col("y").cast("double").alias("y")).agg(F.sum("weight").cast("double").alias("weight"), F.count(F.lit(1)).alias("__n"))
    order = [*model.bins, "y", "weight", "__n"]
    assert [n for n, _ in units.dtypes] == order and [n for _, n in units.dtypes[:23]] == ["tinyint"] * 23
    assert sorted(tuple(r) for r in units.select(order).collect()) == sorted(tuple(r) for r in plain.select(order).collect())
    assert units.agg(F.max(model.bins[-1])).first()[0] == attack.BINS  # the bin of NaN
    assert len(units.inputFiles()) == 8  # twice the cores, however small
    seen = []
    model.fit(type("Trees", (), {"fit": lambda self, df: seen.append(df)})(), units)
    assert "Repartition" not in seen[0]._jdf.queryExecution().optimizedPlan().toString()


def test_what_equal_rows_are_given_sums_to_what_all_are(spark):
    rows = spark.range(0, 6000, 1, 4).select(*[(F.col("id") % k).cast("double").alias(f"f{k}") for k in (7, 11, 30)], F.when(F.col("id") % 30 + F.col("id") % 7 > 18, 1.0).otherwise(0.0).alias("y"), F.lit(1.0).alias("weight"))
    names = ["f7", "f11", "f30"]
    for model in (attack.attack_model(rows, names, trees=5, depth=3), attack.shellcode_model(rows, names, rounds=2)):
        all_of = attack.predict_attack(model, rows, names).groupBy("y", F.col("probabilities")[1].alias("p")).agg(F.count(F.lit(1)).alias("n"))
        few = attack.predict_counted(model, rows, "y")
        assert few.columns == ["y", "probabilities", "n"] and few.count() == 2310  # of 6000
        summed = few.groupBy("y", F.col("probabilities")[1].alias("p")).agg(F.sum("n").alias("n"))
        assert sorted(map(tuple, summed.collect())) == sorted(map(tuple, all_of.collect()))
