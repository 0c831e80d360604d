"""Small registry tables as values: an operator gives the table that replaces the old one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_by(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The row of each key with the greatest order, aggregated before it is shuffled."""
    rest = [c for c in rows.columns if c != key]
    newest = rows.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(order)).alias("r"))
    return newest.select(*[key if c == key else F.col(f"r.{c}").alias(c) for c in rows.columns])


def upsert(table: DataFrame, changes: DataFrame, key: str = "log_type", order: str = "last_updated") -> DataFrame:
    """table with each changed key's last change in place of its row."""
    last = latest_by(changes, key, order)
    return table.join(last, key, "left_anti").unionByName(last)


def set_learning(status: DataFrame, changes: DataFrame) -> DataFrame:
    """log_type, enabled, last_updated after the changes."""
    return upsert(status, changes)


def get_learning(status: DataFrame, types: DataFrame) -> DataFrame:
    """log_type, enabled for each type asked for; false where there is none."""
    return types.join(status.select("log_type", "enabled"), "log_type", "left").select("log_type", F.coalesce("enabled", F.lit(False)).alias("enabled"))


def add_total_rows(totals: DataFrame, added: DataFrame) -> DataFrame:
    """log_type, count: the sums of what was there and what is added."""
    return totals.select("log_type", "count").unionByName(added.select("log_type", "count")).groupBy("log_type").agg(F.sum("count").alias("count"))


def save_model_row(models: DataFrame, row: DataFrame) -> DataFrame:
    """models and the new row with the current time where it has none."""
    held = row.withColumn("created_at", F.coalesce("created_at", F.current_timestamp())) if "created_at" in row.columns else row.withColumn("created_at", F.current_timestamp())
    return models.unionByName(held, allowMissingColumns=True)


def clear_type(store: DataFrame, log_type: str) -> DataFrame:
    """store without one type's rows; null types stay."""
    return store.filter(~F.col("log_type").eqNullSafe(log_type))


def zero_totals(totals: DataFrame) -> DataFrame:
    return totals.withColumn("count", F.lit(0).cast("long"))


def set_threshold(models: DataFrame, log_type: str, threshold: float) -> DataFrame:
    """models with the threshold on all rows of a type."""
    if threshold < 0:
        raise ValueError("a threshold can't be negative")
    return models.withColumn("anomaly_threshold", F.when(F.col("log_type") == log_type, F.lit(float(threshold))).otherwise(F.col("anomaly_threshold")))


def buffer_status(status: DataFrame, changes: DataFrame) -> DataFrame:
    """log_type, buffer_size, last_updated after the changes."""
    return upsert(status, changes)


def training_ready(store: DataFrame, timesteps: int = 10, auto: int = 20_000) -> DataFrame:
    """log_type, rows, ready, auto_train, progress (whole percent)."""
    n = store.groupBy("log_type").agg(F.count(F.lit(1)).alias("rows"))
    return n.select("log_type", "rows", (F.col("rows") >= timesteps).alias("ready"), (F.col("rows") >= auto).alias("auto_train"), F.least(F.lit(100), F.floor(F.col("rows") * 100 / auto)).cast("long").alias("progress"))


def fpr_grade(rate):
    return F.when(rate < 0.05, "excellent").when(rate < 0.10, "good").when(rate < 0.20, "warning").otherwise("poor")


def metrics_report(models: DataFrame) -> DataFrame:
    """The latest model's losses, threshold and metrics of each type, with a grade of its false positives."""
    m = latest_by(models, "log_type", "created_at")
    return m.select("log_type", "model_path", "training_loss", "validation_loss", "anomaly_threshold", "accuracy", "precision", "recall", "f1_score", "false_positive_rate", fpr_grade(F.col("false_positive_rate")).alias("grade"))
