"""Micro-batches, sliding windows and splits over rows in order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.frames import numbered

BATCH, TIMESTEPS = 50, 10


def score_batches(rows: DataFrame, keys: list[str], order: list[str], size: int = BATCH) -> DataFrame:
    """Adds place (from 1 within keys), batch_id and slot (from 0 within the batch)."""
    return numbered_batches(numbered(rows, keys, order, "place"), size)


def numbered_batches(rows: DataFrame, size: int = BATCH) -> DataFrame:
    """Adds batch_id and slot to rows that have their place (from 1 within keys) already."""
    return rows.withColumn("batch_id", F.floor((F.col("place") - 1) / size)).withColumn("slot", (F.col("place") - 1) % size)


def edge_windows(batches: DataFrame, keys: list[str], vector: str = "features", timesteps: int = TIMESTEPS, out: str = "window") -> DataFrame:
    """Adds for each row the last vectors of its batch up to it, the first repeated in front until there are `timesteps`.

    Batches partition the rows, so no task holds more than some batches."""
    w = Window.partitionBy(*keys, "batch_id").orderBy("place").rowsBetween(-(timesteps - 1), 0)
    held = batches.withColumn("__h", F.collect_list(vector).over(w))
    return held.withColumn(out, F.concat(F.array_repeat(F.col("__h")[0], F.lit(timesteps) - F.size("__h")), "__h")).drop("__h")


def train_windows(rows: DataFrame, keys: list[str], order: list[str], vector: str = "features", timesteps: int = TIMESTEPS, block: int = 4096, out: str = "window") -> DataFrame:
    """One window of consecutive rows for each row from the timesteps-th on: n - timesteps + 1 of them.

    Rows are numbered, cut into blocks, and each block gets the rows just before it, so that a long sequence is many
    tasks' work."""
    held = numbered(rows, keys, order, "place").withColumn("__block", F.floor((F.col("place") - 1) / block))
    tail = held.filter((F.col("place") - 1) % block >= block - (timesteps - 1)).withColumn("__block", F.col("__block") + 1).withColumn("__own", F.lit(False))
    w = Window.partitionBy(*keys, "__block").orderBy("place").rowsBetween(-(timesteps - 1), 0)
    full = held.withColumn("__own", F.lit(True)).unionByName(tail).withColumn(out, F.collect_list(vector).over(w))
    return full.filter(F.col("__own") & (F.size(out) == timesteps)).drop("__block", "__own")


def chrono_split(windows: DataFrame, keys: list[str], place: str = "place", share: float = 0.2, timesteps: int = TIMESTEPS) -> DataFrame:
    """Adds split: train, gap or validation, in order of place (consecutive numbers). The tail validates, after a gap of
    `timesteps`; where either part would be empty all rows train."""
    n = windows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.min(place).alias("__low"))
    held = windows.join(n, keys) if keys else windows.crossJoin(F.broadcast(n))
    val = F.floor(F.col("__n") * share)
    train = F.col("__n") - val - F.when(val > 0, timesteps).otherwise(0)
    at = F.col(place) - F.col("__low") + 1
    split = F.when((val < 1) | (train < 1), "train").when(at <= train, "train").when(at > F.col("__n") - val, "validation").otherwise("gap")
    return held.withColumn("split", split).drop("__n", "__low")


def learning_batches(rows: DataFrame, keys: list[str], order: list[str], size: int = 10_000, keep: int = 3) -> DataFrame:
    """Rows in batches of `size`; of what waits, the newest keep * size rows stay and older ones are dropped."""
    held = numbered(rows, keys, order, "place")
    newest = held.groupBy(*keys).agg(F.max("place").alias("__top"))
    met = held.join(newest, keys).filter(F.col("__top") - F.col("place") < keep * size)
    return met.withColumn("batch_id", F.floor((F.col("place") - 1) / size)).drop("__top")


def latest_n(store: DataFrame, log_type: str, n: int, order: list[str]) -> DataFrame:
    """The newest n rows of a type: each task's best, then the best of those."""
    return store.filter(F.col("log_type") == log_type).orderBy(*[F.col(o).desc() for o in order]).limit(n)


def latest_model(models: DataFrame, order: list[str] = ("created_at", "model_path")) -> DataFrame:
    """The newest model row of each type."""
    rest = [c for c in models.columns if c != "log_type"]
    newest = models.groupBy("log_type").agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r"))
    return newest.select(*["log_type" if c == "log_type" else F.col(f"r.{c}").alias(c) for c in models.columns])
