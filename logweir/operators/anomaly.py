"""Scaling, reconstruction scores and thresholds."""

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: History of the adaptive threshold and its bounds.
HISTORY, LEAST, BASE_DEFAULT, LOW, HIGH, LIVE_DEFAULT = 1000, 100, 0.1, 0.001, 1.0, 0.5


def minmax_fit(rows: DataFrame, vector: str = "features") -> DataFrame:
    """i, low, range for each feature: one pass, aggregated before it is shuffled."""
    return rows.select(F.posexplode(vector).alias("i", "x")).groupBy("i").agg(F.min("x").alias("low"), (F.max("x") - F.min("x")).alias("range"))


def _scaler(fit: DataFrame) -> DataFrame:
    """The fit as one row: arrays in order of feature, as many values as a vector has."""
    return fit.agg(F.sort_array(F.collect_list(F.struct("i", "low", "range"))).alias("s")).select(F.col("s.low").alias("__low"), F.col("s.range").alias("__range"))


def _scaled(rows: DataFrame, fit: DataFrame, vector: str, scale: Callable[[Column, Column, Column], Column], width: int | None = None) -> DataFrame:
    held = rows.crossJoin(F.broadcast(_scaler(fit)))  # one row
    if width:  # values of a known number are compiled; a lambda over an array isn't
        values = F.array(*[scale(*(F.get(c, F.lit(i)) for c in (vector, "__low", "__range"))) for i in range(width)])
        return held.withColumn(vector, F.when(F.col(vector).isNotNull(), values)).drop("__low", "__range")
    pairs = F.arrays_zip(F.col(vector).alias("x"), F.col("__low").alias("l"), F.col("__range").alias("r"))
    return held.withColumn(vector, F.transform(pairs, lambda p: scale(p["x"], p["l"], p["r"]))).drop("__low", "__range")


def minmax_apply_fit(rows: DataFrame, fit: DataFrame, vector: str = "features") -> DataFrame:
    """(x - low) / range, a range of 0 as 1, without clipping."""
    return _scaled(rows, fit, vector, lambda x, low, r: (x - low) / F.when(r == 0, 1.0).otherwise(r))


def minmax_apply_live(rows: DataFrame, fit: DataFrame | None, vector: str = "features", width: int | None = None) -> DataFrame:
    """(x - low) / (range + 1e-8), clipped to 0 and 1; without a fit rows stay as they are. width: of all vectors, where it is known."""
    if fit is None:
        return rows
    return _scaled(rows, fit, vector, lambda x, low, r: F.greatest(F.lit(0.0), F.least(F.lit(1.0), (x - low) / (r + 1e-8))), width)


class LinearAutoencoder:
    """Reconstruction by the first principal components of flattened windows: mean + P P'(x - mean)."""

    def __init__(self, mean: np.ndarray, axes: np.ndarray):
        self.mean, self.axes = mean, axes

    @classmethod
    def fit(cls, windows: DataFrame, window: str = "window", k: int = 16) -> "LinearAutoencoder":
        """Sums of x and x x' over all windows, added up per partition; what comes back is bounded by the width of a window."""

        def run(batches):
            added = None
            for pdf in batches:
                if len(pdf):
                    x = np.stack([np.concatenate(w) for w in pdf["w"]])
                    part = np.concatenate([[len(x)], x.sum(0), (x.T @ x).ravel()])
                    added = part if added is None else added + part
            if added is not None:
                yield pd.DataFrame({"v": [added]})

        parts = windows.select(F.col(window).alias("w")).mapInPandas(run, "v array<double>")
        sums = parts.select(F.posexplode("v").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x")).toPandas().sort_values("i")["x"].to_numpy()
        if not len(sums):
            raise ValueError("no windows to fit on")
        d = int(len(sums) ** 0.5)
        while 1 + d + d * d > len(sums):
            d -= 1
        mean = sums[1 : 1 + d] / sums[0]
        cov = sums[1 + d :].reshape(d, d) / sums[0] - np.outer(mean, mean)
        values, vectors = np.linalg.eigh(cov)
        return cls(mean, vectors[:, np.argsort(values)[::-1][:k]])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self.mean + (x - self.mean) @ self.axes @ self.axes.T


def reconstruct(windows: DataFrame, model: Callable[[np.ndarray], np.ndarray], window: str = "window", out: str = "rebuilt") -> DataFrame:
    """Adds the model's reconstruction of each window; model maps a matrix of flattened windows to one of the same shape."""

    @F.pandas_udf("array<double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for w in batches:
            yield pd.Series(list(model(np.stack([np.concatenate(x) for x in w]))) if len(w) else [])

    return windows.withColumn(out, run(window))


def window_error(window: Column, rebuilt: Column) -> tuple[Column, Column]:
    """Mean absolute and mean squared difference over steps and features; rebuilt is flat."""
    gaps = F.zip_with(F.flatten(window), rebuilt, lambda a, b: a - b)
    n = F.size(gaps)
    return F.aggregate(gaps, F.lit(0.0), lambda s, x: s + F.abs(x)) / n, F.aggregate(gaps, F.lit(0.0), lambda s, x: s + x * x) / n


def static_threshold(scores: DataFrame, sigma: float = 3.0, score: str = "mae", split: str = "split") -> DataFrame:
    """One row: threshold (mean + sigma population deviations of held-out scores, of training scores where none are held out), basis."""
    s, v = F.col(score), F.col(split) == "validation"
    held = F.when(v, s)
    has = F.count(held) > 0
    return scores.agg(F.when(has, F.avg(held) + sigma * F.stddev_pop(held)).otherwise(F.avg(s) + sigma * F.stddev_pop(s)).alias("threshold"), F.when(has, "validation").otherwise("training").alias("basis"))


def sigma_sweep(scores: DataFrame, sigmas: tuple[float, ...] = (1.0, 2.0, 3.0), score: str = "mae", attack: str = "attack") -> DataFrame:
    """sigma, threshold, detection, false_positives; thresholds from the scores of rows that aren't attacks. One pass over scores for statistics, one for the rates."""
    s, bad = F.col(score), F.col(attack)
    base = scores.agg(F.avg(F.when(~bad, s)).alias("m"), F.stddev_pop(F.when(~bad, s)).alias("d"))
    at = base.select(F.explode(F.array(*map(F.lit, sigmas))).alias("sigma"), "m", "d").select("sigma", (F.col("m") + F.col("sigma") * F.col("d")).alias("threshold"))
    over = scores.crossJoin(F.broadcast(at)).withColumn("hit", s >= F.col("threshold"))  # as many rows as sigmas
    return over.groupBy("sigma", "threshold").agg(F.try_divide(F.count_if(bad & F.col("hit")), F.count_if(bad)).alias("detection"), F.try_divide(F.count_if(~bad & F.col("hit")), F.count_if(~bad)).alias("false_positives"))


def adaptive_threshold(scores: DataFrame, baseline: float | None, keys: list[str], score: str = "mae", place: str = "place", batch: str = "batch_id", history: int = HISTORY) -> DataFrame:
    """keys, batch_id, threshold, drift_clamped: each batch's threshold from the up to 1000 scores before it.

    Rows need consecutive places within keys. A batch's first row meets its predecessors through numbered blocks of
    `history` rows, its own and the one before, so no frame is kept for the other rows and no key is one task's."""
    blocks = scores.select(*keys, place, F.col(score).alias("s"), F.floor((F.col(place) - 1) / history).alias("__b"))
    first = scores.groupBy(*keys, batch).agg(F.min(place).alias("__at"))
    wanted = first.withColumn("__b", F.explode(F.array(F.floor((F.col("__at") - 1) / history), F.floor((F.col("__at") - 1) / history) - 1)))
    met = wanted.join(blocks, [*keys, "__b"], "left").filter(F.col(place).isNull() | ((F.col(place) < F.col("__at")) & (F.col(place) >= F.col("__at") - history)))
    seen = met.groupBy(*keys, batch).agg(F.count("s").alias("n"), F.percentile("s", 0.95).alias("p95"))
    held = first.join(seen, [*keys, batch], "left").select(*keys, batch, F.coalesce("n", F.lit(0)).alias("n"), "p95")
    few, bounded = F.col("n") < LEAST, lambda x: F.least(F.lit(HIGH), F.greatest(F.lit(LOW), x))
    if baseline is None:
        return held.select(*keys, batch, F.when(few, BASE_DEFAULT).otherwise(bounded(F.col("p95"))).alias("threshold"), F.lit(False).alias("drift_clamped"))
    base, b = F.lit(float(baseline)), F.least(F.col("n") / F.lit(float(history)), F.lit(1.0))
    mixed = (1 - b) * base + b * F.col("p95")
    clamped = F.least(base * 2, F.greatest(base / 2, mixed)) if baseline > 0 else mixed
    return held.select(*keys, batch, bounded(F.when(few, base).otherwise(clamped)).alias("threshold"), (~few & (clamped != mixed)).alias("drift_clamped"))


def flag_anomalies(scores: DataFrame, thresholds: DataFrame, keys: list[str], score: str = "mae") -> DataFrame:
    """scores with the threshold of their batch and is_anomaly."""
    return scores.join(thresholds, [*keys, "batch_id"]).withColumn("is_anomaly", F.col(score) >= F.col("threshold"))


def live_threshold(rows: DataFrame, latest: DataFrame) -> DataFrame:
    """rows with live_threshold: the static threshold of the latest model of their type, 0.5 where there is none."""
    m = latest.select(F.col("log_type").alias("__t"), F.col("anomaly_threshold").alias("__h"))
    return rows.join(m, F.col("log_type") == F.col("__t"), "left").withColumn("live_threshold", F.coalesce("__h", F.lit(LIVE_DEFAULT))).drop("__t", "__h")


def no_model_scores(rows: DataFrame, scores: DataFrame, key: str) -> DataFrame:
    """rows with their score; 0 and not anomalous where none was given."""
    return rows.join(scores, key, "left").withColumn("mae", F.coalesce("mae", F.lit(0.0))).withColumn("is_anomaly", F.coalesce("is_anomaly", F.lit(False)))


def mode_route(rows: DataFrame, status: DataFrame) -> DataFrame:
    """rows with route: store where learning is on for their type, else score."""
    s = status.select(F.col("log_type").alias("__t"), F.col("enabled").alias("__e"))
    return rows.join(s, F.col("log_type") == F.col("__t"), "left").withColumn("route", F.when(F.coalesce("__e", F.lit(False)), "store").otherwise("score")).drop("__t", "__e")

