"""Classifying attacks: labels, derived features, selection, models, decisions, evaluation."""

from __future__ import annotations

from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import Bucketizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import frames
from ..sources.scratch import stored

# How classes merge, which columns are logarithms, where the 42 features have names.
RENAMED = {"Backdoors": "Backdoor", "Fuzzers": "Fuzzer"}
MERGED = ("Analysis", "Backdoor", "DoS")
LOGGED = ("sbytes", "dbytes", "sload", "dload", "dur", "sinpkt", "dinpkt")
FORCED = ("timing_ratio", "slow_scan", "mean_pkt_asymmetry", "ttl_ratio", "total_mean_pkt")
NAMED42 = {1: "dur", 2: "proto", 3: "service", 4: "state", 5: "spkts", 6: "dpkts", 7: "sbytes", 8: "dbytes", 10: "sttl", 11: "dttl", 12: "sload", 13: "dload", 16: "sinpkt", 17: "dinpkt", 27: "smean", 28: "dmean", 29: "trans_depth", 30: "response_body_len", 31: "ct_srv_src", 32: "ct_state_ttl", 33: "ct_dst_ltm", 34: "ct_src_dport_ltm", 35: "ct_dst_sport_ltm", 36: "ct_dst_src_ltm", 37: "is_ftp_login", 38: "ct_ftp_cmd", 40: "ct_src_ltm", 41: "ct_srv_dst", 42: "is_sm_ips_ports"}
UNLOGGED42 = ("dur", "sinpkt", "dinpkt")
#: Slots of values that ranks are counted by, and rows looked at to place them.
SLOTS, LOOKED_AT = 2048, 40_000
#: Bins of a feature that trees choose among, and units of equal rows that a forest's bags draw from, at least where there are so many rows.
BINS, UNITS = 32, 200_000
FLOOR, WORMS_SHARE, SHELLCODE_SHARE = 0.10, 0.70, 0.65


def clean_labels(label: Column) -> Column:
    """Trimmed, renamed and merged; null is Normal."""
    t = F.trim(F.coalesce(label, F.lit("Normal")))
    for old, new in RENAMED.items():
        t = F.when(t == old, new).otherwise(t)
    return F.when(t.isin(*MERGED), "Other").otherwise(t)


def engineer_features(rows: DataFrame) -> DataFrame:
    """rows with the derived columns whose inputs are there (from raw values), then seven raw columns as logarithms; null and infinite as 0."""
    c, have = F.col, set(rows.columns)
    made = {
        "pkt_diff": (("spkts", "dpkts"), lambda a, b: a - b),
        "byte_ratio": (("sbytes", "dbytes"), lambda a, b: a / (b + 1)),
        "load_ratio": (("sload", "dload"), lambda a, b: a / (b + 1)),
        "pkt_rate": (("spkts", "dur"), lambda a, b: a / (b + 0.001)),
        "byte_per_pkt": (("sbytes", "spkts"), lambda a, b: a / (b + 1)),
        "load_x_pkt": (("sload", "spkts"), lambda a, b: a * b),
        "dur_x_bytes": (("dur", "sbytes"), lambda a, b: a * b),
        "spkt_dpkt_ratio": (("spkts", "dpkts"), lambda a, b: a / (b + 1)),
        "sbyte_dbyte_diff": (("sbytes", "dbytes"), lambda a, b: a - b),
        "pkt_intensity": (("spkts", "dpkts", "dur"), lambda a, b, d: (a + b) / (d + 0.001)),
        "mean_pkt_size": (("sbytes", "dbytes", "spkts", "dpkts"), lambda a, b, p, q: (a + b) / (p + q + 1)),
        "ttl_delta": (("sttl", "dttl"), lambda a, b: F.abs(a - b)),
        "ttl_ratio": (("sttl", "dttl"), lambda a, b: a / (b + 1)),
        "slow_scan": (("sinpkt", "dpkts"), lambda a, b: a * F.log1p(b)),
        "timing_ratio": (("sinpkt", "dinpkt"), lambda a, b: a / (b + 0.001)),
        "mean_pkt_asymmetry": (("smean", "dmean"), lambda a, b: a / (b + 1)),
        "total_mean_pkt": (("smean", "dmean"), lambda a, b: a + b),
    }
    clean = lambda x: F.when(x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")), 0.0).otherwise(x)
    d = lambda n: c(n).cast("double")
    new = {name: clean(f(*map(d, needs))) for name, (needs, f) in made.items() if have.issuperset(needs)}
    new |= {n: clean(F.log1p(F.greatest(d(n), F.lit(0.0)))) for n in LOGGED if n in have}
    return rows.withColumns(new)  # all at once: every formula sees the raw columns


def label_codes(rows: DataFrame, column: str) -> DataFrame:
    """column, code: rank among the sorted distinct values, from 0. Distinct values are few and meet in one task."""
    return rows.select(column).filter(F.col(column).isNotNull()).distinct().withColumn("code", (F.dense_rank().over(Window.orderBy(column)) - 1).cast("double"))


def label_encode(rows: DataFrame, columns: tuple[str, ...] = ("proto", "service", "state"), fitted: dict[str, DataFrame] | None = None) -> DataFrame:
    """Columns as codes, refitted on rows unless fitted ones are given (values unknown to those: -1). Codes are few and are
    broadcast: a join by shuffle would put all rows of a value in one task."""
    for name in columns:
        codes = (fitted or {}).get(name)
        codes = label_codes(rows, name) if codes is None else codes
        at = codes.select(F.col(name).alias("__k"), F.col("code").alias("__c"))
        rows = rows.join(F.broadcast(at), F.col(name) == F.col("__k"), "left").withColumn(name, F.coalesce("__c", F.lit(-1.0))).drop("__k", "__c")
    return rows


def _looked_at(rows: DataFrame, columns: dict[str, Column], n: int) -> dict[str, np.ndarray]:
    """Columns, as numbers, of a bounded number of rows, to place bounds by."""
    some = rows.select(*[x.cast("double").alias(k) for k, x in columns.items()]).sample(min(1.0, LOOKED_AT / max(n, 1)), 42).toPandas()
    return {k: some[k].to_numpy(float) for k in columns}


def _by_slot(bounds: list[np.ndarray], slots: int, cut: list[np.ndarray] | None = None):
    """What mapInArrow takes over y and one column for each feature: counts of (f, slot, y), or, if cut tells which slots, their
    values one by one. Slots go from 1 up in order of value, NaN has the last one, null none."""

    def placed(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray]:
        held = batch.column(i + 1)
        x = held.to_numpy(zero_copy_only=False) + 0.0  # -0.0 becomes 0.0
        at = np.where(np.isnan(x), slots - 1, 1 + np.searchsorted(bounds[i], x, side="right"))
        return x, np.where(held.is_null().to_numpy(zero_copy_only=False), 0, at) if held.null_count else at

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict = {}
        for batch in batches:
            y = batch.column(0).dictionary_encode()
            codes = y.indices.fill_null(len(y.dictionary)).to_numpy(zero_copy_only=False)
            for i in range(len(bounds)):
                n = np.bincount(codes * slots + placed(batch, i)[1], minlength=(len(y.dictionary) + 1) * slots).reshape(-1, slots)
                for value, one in zip([*y.dictionary.to_pylist(), None], n, strict=True):
                    found[i, value] = found.get((i, value), 0) + one
        for (i, value), n in found.items():
            (at,) = np.nonzero(n)
            yield pa.RecordBatch.from_pydict({"f": pa.array(np.full(len(at), i, np.int32)), "slot": pa.array(at.astype(np.int32)), "y": pa.array([value] * len(at), y.dictionary.type), "n": pa.array(n[at].astype(np.int64))})

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(bounds)):
                x, at = placed(batch, i)
                (here,) = np.nonzero(cut[i][at])
                yield pa.RecordBatch.from_pydict({"f": pa.array(np.full(len(here), i, np.int32)), "slot": pa.array(at[here].astype(np.int32)), "x": pa.array(x[here]), "y": batch.column(0).take(pa.array(here))})

    return count if cut is None else values


def mutual_information(rows: DataFrame, features: list[str], label: str, bins: int = 32) -> DataFrame:
    """feature, mi: between the class and `bins` rank bins (floor(bins * (rank - 1) / n), ties share a rank).

    Rows are counted by slots of values, so that tasks send a bounded number of counts. A slot that lies in one bin whole needs
    no more. Only the values of slots in which a bin ends, at most `bins` of a feature, are counted one by one and ranked: the
    bins are exact, and little of the table is shuffled. Where slots begin is read off a sample, which decides about the work
    alone."""
    n = rows.count()
    seen = _looked_at(rows, {f: F.col(f) for f in features}, n)
    bounds = []
    for f in features:
        x = np.sort(seen[f][np.isfinite(seen[f])] + 0.0)
        bounds.append(np.unique(x[np.linspace(0, len(x) - 1, SLOTS - 2).astype(int)]) if len(x) else np.zeros(0))
    kind = rows.schema[label].dataType.simpleString()
    held = rows.select(F.col(label).alias("y"), *[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)])
    counted = held.mapInArrow(_by_slot(bounds, SLOTS + 1), f"f int, slot int, y {kind}, n long")
    counted = stored(counted.groupBy("f", "slot", "y").agg(F.sum("n").alias("n")), "slots")
    upto = Window.partitionBy("f").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    slots = counted.groupBy("f", "slot").agg(F.sum("n").alias("m")).withColumn("before", F.coalesce(F.sum("m").over(upto), F.lit(0)))
    bin_of = lambda rank: F.floor(F.lit(bins) * rank / F.lit(n))
    slots = slots.withColumns({"bin": bin_of(F.col("before")), "cut": bin_of(F.col("before")) != bin_of(F.col("before") + F.col("m") - 1)})
    slots = stored(slots.filter("slot > 0"), "slot-ranks")  # nulls have a rank, but no bin
    cut = [np.zeros(SLOTS + 1, bool) for _ in features]
    for r in slots.filter("cut").select("f", "slot").collect():  # at most `bins` of a feature
        cut[r.f][r.slot] = True
    by = held.mapInArrow(_by_slot(bounds, SLOTS + 1, cut), f"f int, slot int, x double, y {kind}")
    by = stored(by.groupBy("f", "slot", "x", "y").agg(F.count(F.lit(1)).alias("n")), "cut-values")
    own = Window.partitionBy("f", "slot").orderBy("x").rowsBetween(Window.unboundedPreceding, -1)
    ranks = by.groupBy("f", "slot", "x").agg(F.sum("n").alias("m")).withColumn("in_slot", F.coalesce(F.sum("m").over(own), F.lit(0)))
    ranks = ranks.join(F.broadcast(slots.select("f", "slot", "before")), ["f", "slot"]).select("f", "slot", "x", bin_of(F.col("before") + F.col("in_slot")).alias("bin"))
    parted = by.join(ranks, ["f", "slot", "x"]).select("f", "bin", "y", "n")
    plain = counted.join(F.broadcast(slots.filter("not cut").select("f", "slot", "bin")), ["f", "slot"]).select("f", "bin", "y", "n")
    names = F.array(*[F.lit(f) for f in features])
    binned = stored(plain.unionByName(parted).groupBy("f", "bin", "y").agg(F.sum("n").alias("n")).select(names[F.col("f")].alias("feature"), "bin", "y", "n"), "binned")
    px = binned.groupBy("feature", "bin").agg(F.sum("n").alias("nx"))
    py = binned.groupBy("feature", "y").agg(F.sum("n").alias("ny"))
    met = binned.join(px, ["feature", "bin"]).join(py, ["feature", "y"])
    p = F.col("n") / F.lit(float(n))
    return met.groupBy("feature").agg(F.sum(p * F.log(F.col("n") * F.lit(float(n)) / (F.col("nx") * F.col("ny")))).alias("mi"))


def mi_select(rows: DataFrame, features: list[str], label: str, top: int = 40, forced: tuple[str, ...] = FORCED) -> DataFrame:
    """feature, mi of the best features and of those that always stay."""
    mi = mutual_information(rows, features, label)
    best = mi.orderBy(F.desc(F.round("mi", 9)), "feature").limit(top)
    return best.unionByName(mi.filter(F.col("feature").isin(*forced)).join(best, "feature", "left_anti"))


def standard_fit(rows: DataFrame, columns: list[str]) -> DataFrame:
    """One row: mean and population deviation of each column."""
    return rows.agg(*[f(F.col(c).cast("double")).alias(f"{n}_{c}") for c in columns for n, f in (("mean", F.avg), ("std", F.stddev_pop))])


def standardize(rows: DataFrame, fit: DataFrame, columns: list[str]) -> DataFrame:
    held = rows.crossJoin(F.broadcast(fit))  # one row
    return held.withColumns({c: (F.col(c) - F.col(f"mean_{c}")) / F.when(F.col(f"std_{c}") == 0, 1.0).otherwise(F.col(f"std_{c}")) for c in columns}).drop(*fit.columns)


def quantile_fit(rows: DataFrame, column: str, quantiles: int = 1000) -> list[float]:
    """Values at evenly spaced ranks, exact."""
    return frames.exact_quantiles(rows, column, [i / (quantiles - 1) for i in range(quantiles)])


def quantile_normal(values: Column, quantiles: list[float]) -> Column:
    """Each value's interpolated rank as a standard normal value; ties take the mean of their ranks; bounded to about 5.2."""
    q = np.array(quantiles, float)
    p = np.linspace(0, 1, len(q))

    @F.pandas_udf("double")
    def run(x: pd.Series) -> pd.Series:
        v = x.to_numpy(float)
        rank = 0.5 * (np.interp(v, q, p) - np.interp(-v, -q[::-1], -p[::-1])) if len(q) else np.full(len(v), 0.5)
        inverse = NormalDist().inv_cdf
        return pd.Series([None if np.isnan(r) else inverse(min(max(r, 1e-7), 1 - 1e-7)) for r in rank], dtype="float64")

    return run(values)


def class_weights(rows: DataFrame, label: str, most: float = 30.0, counted: str | None = None) -> DataFrame:
    """label, weight: n / (classes * count), at most 30. A row for each class, to be broadcast where it is joined: by shuffle, all
    rows of a class would meet in one task. counted: a column that says how many rows each of rows stands for."""
    counts = rows.groupBy(label).agg((F.sum(counted) if counted else F.count(F.lit(1))).alias("n"))
    whole = counts.agg(F.sum("n").alias("__n"), F.count(F.lit(1)).alias("__k"))
    return F.broadcast(counts.crossJoin(F.broadcast(whole)).select(label, F.least(F.col("__n") / (F.col("__k") * F.col("n")), F.lit(most)).alias("weight")))  # one row


def stratified_split(rows: DataFrame, label: str, key: str, share: float = 0.15, seed: int = 42) -> DataFrame:
    """rows with split: the given share of each class, first in order of a hash of the key, validates. Null is a class too.

    A class can be most of the table, so hashes are counted in 4096 slots and ranked in the one slot that the cut falls in. That
    gives the hash at which each class is cut, a row for each, which is broadcast: full rows are read once and not moved. Only
    if rows that share a key lie on both sides of the cut are those numbered."""
    held = rows.withColumn("__h", F.md5(F.concat_ws("-", F.col(key).cast("string"), F.lit(str(seed)))))
    hashes = held.select(F.col(label).alias("__of"), F.substring("__h", 1, 3).alias("__slot"), "__h")
    of = Window.partitionBy("__of")
    before = lambda n, order: F.coalesce(F.sum(n).over(of.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    slots = hashes.groupBy("__of", "__slot").agg(F.count(F.lit(1)).alias("__n"))
    slots = slots.withColumns({"__before": before("__n", "__slot"), "__want": F.floor(F.sum("__n").over(of) * share)})
    reached = (F.col("__before") < F.col("__want")) & (F.col("__before") + F.col("__n") >= F.col("__want"))
    slot = slots.filter(reached).select(F.col("__of").alias("__class"), F.col("__slot").alias("__at"), (F.col("__want") - F.col("__before")).alias("__left"))
    inside = hashes.join(F.broadcast(slot), F.col("__of").eqNullSafe(F.col("__class")) & (F.col("__slot") == F.col("__at")))  # a row of each class
    inside = inside.groupBy("__of", "__left", "__h").agg(F.count(F.lit(1)).alias("__n")).withColumn("__before", before("__n", "__h"))
    reached = (F.col("__before") < F.col("__left")) & (F.col("__before") + F.col("__n") >= F.col("__left"))
    cuts = inside.filter(reached).select(F.col("__of").alias("__class"), F.col("__h").alias("__cut"), (F.col("__left") - F.col("__before")).alias("__left"), "__n")
    cuts = stored(cuts, "cuts")
    same = F.col(label).eqNullSafe(F.col("__class"))
    met = held.join(F.broadcast(cuts), same, "left")
    validates = F.col("__h") <= F.col("__cut")
    split = lambda part, first: part.withColumn("split", F.when(first, "validation").otherwise("train")).select(*rows.columns, "split")
    shared = cuts.filter("__left < __n")
    if shared.isEmpty():
        return split(met, validates)
    rest = met.filter(F.coalesce((F.col("__h") != F.col("__cut")) | (F.col("__left") == F.col("__n")), F.lit(True)))
    rank = F.row_number().over(Window.partitionBy(label).orderBy(key))
    return split(rest, validates).unionByName(split(held.join(F.broadcast(shared), same & (F.col("__h") == F.col("__cut"))), rank <= F.col("__left")))


def _vectors(rows: DataFrame, features: list[str]) -> DataFrame:
    return rows.withColumn("features", array_to_vector(F.array(*[F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features])))


def _bin_bounds(rows: DataFrame, features: list[str], weight: Column, n: int) -> list[list[float]]:
    """For each feature bounds of at most BINS bins of about equal weight, halfway between neighbours in a bounded sample: the
    candidates that Spark's trees would look for in such a sample themselves."""
    seen = _looked_at(rows, {**{f: F.coalesce(F.col(f), F.lit(0.0)) for f in features}, "__w": weight}, n)
    out = []
    for f in features:
        fine = np.isfinite(seen[f])
        x, at = np.unique(seen[f][fine] + 0.0, return_inverse=True)
        upto = np.cumsum(np.bincount(at, seen["__w"][fine], minlength=len(x)))
        ends = np.arange(len(x) - 1)
        if len(x) > BINS:
            ends = np.unique(np.searchsorted(upto, upto[-1] * np.arange(1, BINS) / BINS))
            ends = ends[ends < len(x) - 1]
        inner = np.unique((x[ends] + x[ends + 1]) / 2) if len(ends) else np.zeros(1)
        out.append([-float("inf"), *inner.tolist(), float("inf")])
    return out


class BinnedModel:
    """A model of trees over the numbers of bins, for rows with the features themselves."""

    def __init__(self, features: list[str], bounds: list[list[float]]):
        self.features, self.bounds, self.trees = features, bounds, None
        self.bins = [f"__bin{i}" for i in range(len(features))]

    def binned(self, rows: DataFrame) -> DataFrame:
        values = [f"__value{i}" for i in range(len(self.features))]
        held = rows.withColumns({v: F.coalesce(F.col(f).cast("double"), F.lit(0.0)) + 0.0 for v, f in zip(values, self.features, strict=True)})
        return Bucketizer(inputCols=values, outputCols=self.bins, splitsArray=self.bounds, handleInvalid="keep").transform(held).drop(*values)

    def counted(self, rows: DataFrame, label: str, weight: Column) -> DataFrame:
        """Rows of equal bins and label as one, with their weight and number, stored in twice as many parts as there are cores,
        for compressed bytes say little of the work. Trees see nothing else of rows. To be counted, bins go into few integers,
        some bits each."""
        bits = BINS.bit_length()  # a bin more is for NaN
        at = {b: (f"__word{i // (63 // bits)}", i % (63 // bits) * bits) for i, b in enumerate(self.bins)}
        words: dict[str, Column] = {}
        for b, (word, shift) in at.items():
            placed = F.shiftleft(F.col(b).cast("long"), shift)
            words[word] = words[word].bitwiseOR(placed) if word in words else placed
        held = self.binned(rows).select(*[w.alias(k) for k, w in words.items()], F.col(label).cast("double").alias("y"), weight.alias("__w"))
        by = held.groupBy(*words, "y").agg(F.sum("__w").alias("weight"), F.count(F.lit(1)).alias("__n"))
        bins = [F.shiftright(word, shift).bitwiseAND(F.lit((1 << bits) - 1)).cast("byte").alias(b) for b, (word, shift) in at.items()]
        tasks = 2 * rows.sparkSession.sparkContext.defaultParallelism
        return stored(by.repartition(tasks, *words, "y").select(*bins, "y", "weight", "__n"), "units")

    def fit(self, trees, units: DataFrame) -> BinnedModel:
        self.trees = trees.fit(_vectors(units, self.bins))
        return self

    def transform(self, rows: DataFrame) -> DataFrame:
        return self.trees.transform(_vectors(self.binned(rows), self.bins)).drop(*self.bins)


def attack_model(rows: DataFrame, features: list[str], label: str = "y", weight: str = "weight", trees: int = 40, depth: int = 8) -> BinnedModel:
    """A weighted forest over numbered classes.

    Trees tell rows apart by bins alone, so rows of equal bins and class are counted first. A tree's bag draws units of at
    most n / UNITS such rows, which are single rows in tables of up to UNITS."""
    n = rows.count()
    model = BinnedModel(features, _bin_bounds(rows, features, F.col(weight), n))
    units = model.counted(rows, label, F.col(weight)).withColumn("__parts", F.ceil(F.col("__n") / F.lit(-(-n // UNITS) or 1)).cast("int"))
    units = units.withColumn("weight", F.col("weight") / F.col("__parts")).withColumn("__part", F.explode(F.sequence(F.lit(1), "__parts")))
    return model.fit(RandomForestClassifier(featuresCol="features", labelCol="y", weightCol="weight", numTrees=trees, maxDepth=depth, maxBins=BINS + 1, seed=42), units)


def shellcode_model(rows: DataFrame, features: list[str], label: str = "y", most: float = 150.0, rounds: int = 20) -> BinnedModel:
    """Boosted trees for one class against the rest (label 1.0 or 0.0), positives weighted by min(neg / pos, 150). Rows of equal
    bins and label are counted first; they get the same gradients, so that the sums are the same."""
    n = rows.agg(F.count_if(F.col(label) == 1).alias("p"), F.count(F.lit(1)).alias("n")).first()
    weight = F.when(F.col(label) == 1, float(min((n.n - n.p) / max(1, n.p), most))).otherwise(1.0)
    model = BinnedModel(features, _bin_bounds(rows, features, weight, n.n))
    return model.fit(GBTClassifier(featuresCol="features", labelCol="y", weightCol="weight", maxIter=rounds, maxBins=BINS + 1, seed=42), model.counted(rows, label, weight))


def predict_attack(model, rows: DataFrame, features: list[str], out: str = "probabilities") -> DataFrame:
    """rows with the probability of each class, in order of its number."""
    return model.transform(_vectors(rows, features)).withColumn(out, vector_to_array("probability")).drop("features", "rawPrediction", "probability", "prediction")


def predict_counted(model: BinnedModel, rows: DataFrame, label: str, out: str = "probabilities") -> DataFrame:
    """label as a number, the probability of each class, and n, for rows of equal bins and label as one. The model gives such rows
    the same, so what is summed over rows, as its quality is, needs no more, and trees are walked once for each."""
    units = model.counted(rows, label, F.lit(1.0))
    return model.trees.transform(_vectors(units, model.bins)).select(F.col("y").alias(label), vector_to_array("probability").alias(out), F.col("__n").alias("n"))


def attack_scorer(model, features: list[str], classes: list[str], worms: float | None, shellcode: float | None, shellcode_model=None, vector: str = "features"):
    """What classify() takes: rows of 42-feature vectors get their named and derived columns, the model's class
    probabilities, the decision with its overrides (the second model's score for Shellcode where there is one) as label,
    and one less the label's probability as anomaly_score. `normal` where the decision is Normal."""

    def run(rows: DataFrame) -> DataFrame:
        kept = [c for c in rows.columns if c != vector]
        named = rows.select(*kept, F.explode(F.array(F.struct(*features42_to_row(F.col(vector))))).alias("__row"))
        clear = [c for c in kept if c not in NAMED42.values()]
        held = engineer_features(named.select(*clear, "__row.*"))
        held = predict_attack(model, held, features, "__p")
        score = None
        if shellcode_model is not None:
            held = predict_attack(shellcode_model, held, features, "__s")
            score = F.col("__s")[1]
        label = override_decision(F.col("__p"), classes, worms, shellcode, score)
        held = held.withColumn("label", label)
        sure, _ = confidence(F.col("__p"), classes, F.col("label"))
        return held.withColumn("anomaly_score", 1 - sure).withColumn("label", F.when(F.col("label") == "Normal", "normal").otherwise(F.col("label"))).drop("__p", "__s")

    return run


def pr_points(scores: DataFrame, score: str = "score", label: str = "y") -> DataFrame:
    """threshold, precision, recall, f1 at each distinct score. Scores are counted first; sums go over ranges of distinct ones."""
    by = scores.groupBy(F.col(score).alias("threshold")).agg(F.count_if(F.col(label) == 1).alias("p"), F.count(F.lit(1)).alias("n"))
    above = frames.sums_before(by.withColumn("down", -F.col("threshold")), [], ["down", "threshold"], ["p", "n"], "above")
    summed = above.withColumn("tp", F.col("above_p") + F.col("p")).withColumn("all", F.col("above_n") + F.col("n"))
    held = summed.crossJoin(F.broadcast(by.agg(F.sum("p").alias("pos"))))  # one row
    precision, recall = F.col("tp") / F.col("all"), F.when(F.col("pos") > 0, F.col("tp") / F.col("pos")).otherwise(0.0)
    return held.select("threshold", precision.alias("precision"), recall.alias("recall"), (2 * precision * recall / (precision + recall + 1e-10)).alias("f1"))


def pr_threshold(scores: DataFrame, floors: tuple[float, ...] = (0.50, 0.30), score: str = "score", label: str = "y") -> DataFrame:
    """One row, threshold: that of the best f1 where precision reaches the first floor that any point reaches, else of the
    best f1; the lowest among equals, and 0.10 at least. No positives: no row."""
    points = pr_points(scores, score, label)
    level = F.lit(len(floors))
    for i, floor in reversed(list(enumerate(floors))):
        level = F.when(F.col("precision") >= floor, i).otherwise(level)
    best = points.filter(F.col("recall").isNotNull()).orderBy(level, F.desc(F.round("f1", 12)), "threshold").limit(1)
    some = scores.agg(F.count_if(F.col(label) == 1).alias("__p")).filter("__p > 0")
    return best.crossJoin(some).select(F.greatest("threshold", F.lit(FLOOR)).alias("threshold"))  # one row each


def override_decision(probabilities: Column, classes: list[str], worms: float | None, shellcode: float | None, shellcode_score: Column | None = None) -> Column:
    """The most probable class (ties: the first in order of name), overridden by Worms and Shellcode where they are near enough."""
    order = sorted(range(len(classes)), key=lambda k: classes[k])
    top = F.array_max(probabilities)
    label = F.lit(classes[order[-1]])
    for k in reversed(order):
        label = F.when(probabilities[k] == top, classes[k]).otherwise(label)
    if worms is not None and "Worms" in classes:
        p = probabilities[classes.index("Worms")]
        hit = (p >= worms) & (p >= WORMS_SHARE * top)
        label, top = F.when(hit, "Worms").otherwise(label), F.when(hit, p).otherwise(top)
    if shellcode is not None:
        p = shellcode_score if shellcode_score is not None else probabilities[classes.index("Shellcode")]
        label = F.when((p >= shellcode) & (p >= SHELLCODE_SHARE * top), "Shellcode").otherwise(label)
    return label


def features42_to_row(vector: Column) -> list[Column]:
    """Named columns of a 42-feature vector; three of them back from logarithms."""
    out = []
    for i, name in NAMED42.items():
        x = F.element_at(vector, i)
        out.append((F.expm1(x) if name in UNLOGGED42 else x).alias(name))
    return out


def confidence(probabilities: Column, classes: list[str], label: Column) -> tuple[Column, Column]:
    """The probability of the chosen class, and one less it."""
    at = F.array_position(F.array(*map(F.lit, classes)), label).cast("int")
    p = F.when(at > 0, F.element_at(probabilities, F.when(at > 0, at).otherwise(1)))
    return p, 1 - p


def evaluate(rows: DataFrame, label: str = "label", predicted: str = "pred") -> DataFrame:
    """class, precision, recall, f1, support for each class, then the rows macro and weighted. From the counts of (label, predicted)."""
    counts = rows.groupBy(F.col(label).alias("l"), F.col(predicted).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    actual = counts.groupBy(F.col("l").alias("class")).agg(F.sum("n").alias("support"), F.sum(F.when(F.col("l") == F.col("p"), F.col("n")).otherwise(0)).alias("tp"))
    given = counts.groupBy(F.col("p").alias("class")).agg(F.sum("n").alias("given"))
    both = actual.join(given, "class", "full").na.fill(0)
    precision = F.when(F.col("given") > 0, F.col("tp") / F.col("given")).otherwise(0.0)
    recall = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    each = both.select("class", precision.alias("precision"), recall.alias("recall"), "support").withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0, 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0))
    names = ("precision", "recall", "f1")
    macro = each.agg(*[F.avg(n).alias(n) for n in names], F.sum("support").alias("support")).withColumn("class", F.lit("macro"))
    weighted = each.agg(*[(F.sum(F.col(n) * F.col("support")) / F.sum("support")).alias(n) for n in names], F.sum("support").alias("support")).withColumn("class", F.lit("weighted"))
    return each.unionByName(macro).unionByName(weighted).select("class", *names, "support")


def classify(rows: DataFrame, scorer, trusted: DataFrame, source: str = "orig_h") -> DataFrame:
    """Encoded records with label and anomaly_score: scorer adds both; records of trusted sources are 'normal' with score 0.
    Attacks alone are what goes on (filters.attack_only)."""
    ips = trusted.select(F.trim("ip").alias("__ip")).distinct()
    marked = rows.join(ips, F.trim(F.col(source)) == F.col("__ip"), "left")
    held = scorer(marked)
    known = F.col("__ip").isNotNull()
    return held.withColumn("label", F.when(known, "normal").otherwise(F.col("label"))).withColumn("anomaly_score", F.when(known, 0.0).otherwise(F.col("anomaly_score"))).drop("__ip")
