"""Relational summaries of stores, vectors, classes and scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import frames


def store_summary(store: DataFrame, time: str = "timestamp") -> DataFrame:
    return store.groupBy("log_type").agg(F.count(F.lit(1)).alias("rows"), F.min(time).alias("first"), F.max(time).alias("last")).orderBy("log_type")


def count_by_type(store: DataFrame, log_type: str) -> DataFrame:
    return store.filter(F.col("log_type") == log_type).agg(F.count(F.lit(1)).alias("rows"))


def vector_stats(vector: Column) -> dict[str, Column]:
    """Minimum, maximum, mean, median, population deviation and non-zero count of an array's values."""
    n = F.size(vector)
    mean = F.aggregate(vector, F.lit(0.0), lambda a, x: a + x) / n
    square = F.aggregate(vector, F.lit(0.0), lambda a, x: a + (x - mean) * (x - mean)) / n
    ordered = F.sort_array(vector)
    low, high = F.element_at(ordered, F.floor((n + 1) / 2).cast("int")), F.element_at(ordered, F.floor((n + 2) / 2).cast("int"))
    return {"min": F.array_min(vector), "max": F.array_max(vector), "mean": mean, "median": (low + high) / 2, "std": F.sqrt(square), "non_zero": F.size(F.filter(vector, lambda x: x != 0))}


def class_distribution(rows: DataFrame, label: str) -> DataFrame:
    return rows.groupBy(label).agg(F.count(F.lit(1)).alias("rows"))


def score_stats(scores: DataFrame, score: str = "score", anomaly: str = "is_anomaly") -> DataFrame:
    """One row: count, anomalies, rate, mean, population deviation, extremes and percentiles (linear between ranks, which come
    from counts of values by range: no buffer holds all of them)."""
    s = F.col(score)
    hits = F.count_if(F.col(anomaly))
    p = frames.exact_quantiles(scores, score, [0.5, 0.95, 0.99]) or [None] * 3
    held = scores.agg(F.count(s).alias("count"), hits.alias("anomalies"), F.try_divide(hits, F.count(s)).alias("anomaly_rate"), F.avg(s).alias("mean"), F.stddev_pop(s).alias("std"), F.min(s).alias("min"), F.max(s).alias("max"))
    return held.select("*", *[F.lit(x).cast("double").alias(n) for x, n in zip(p, ("p50", "p95", "p99"), strict=True)])


def entropy_of_texts(texts: DataFrame, key: str, text: str) -> DataFrame:
    """key, entropy (bits over 8) for texts of any length: characters are counted by a grouped aggregate, not within a row."""
    signs = texts.select(key, F.explode(F.filter(F.split(F.coalesce(text, F.lit("")), ""), lambda c: c != "")).alias("c"))
    counts = signs.groupBy(key, "c").agg(F.count(F.lit(1)).alias("n"))
    # -sum(n/N log2(n/N)) = log2(N) - sum(n log2(n)) / N
    sums = counts.groupBy(key).agg(F.sum("n").alias("total"), F.sum(F.col("n") * F.log2(F.col("n").cast("double"))).alias("weighted"))
    return texts.select(key).join(sums, key, "left").select(key, F.coalesce((F.log2(F.col("total").cast("double")) - F.col("weighted") / F.col("total")) / 8.0, F.lit(0.0)).alias("entropy"))
