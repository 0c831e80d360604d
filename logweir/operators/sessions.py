"""Sessions: records of one uid from raw and malicious streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def session_assemble(raw: DataFrame, malicious: DataFrame, order: str = "arrival", dedup: bool = False) -> DataFrame:
    """One row for each malicious record whose uid has had a conn record by then: uid, arrival, conn, n_dns, n_http, n_ssl.

    Both inputs: uid, arrival, log_type, record. State of a uid in order of arrival (raw before malicious of the same):
    the last conn record; counts of the others. A malicious record is itself part of the state, beside the raw record it
    copies; dedup counts equal records of a uid once. Rows of a uid meet in one shuffle; running values are windows.
    """
    both = raw.select("uid", order, "log_type", "record", F.lit(0).alias("trigger")).unionByName(malicious.select("uid", order, "log_type", "record", F.lit(1).alias("trigger")))
    w = Window.partitionBy("uid").orderBy(order, "trigger", "record").rowsBetween(Window.unboundedPreceding, 0)
    counted = F.lit(1)
    if dedup:
        both = both.withColumn("__copy", F.row_number().over(Window.partitionBy("uid", "log_type", "record").orderBy(order, "trigger")))
        counted = F.when(F.col("__copy") == 1, 1)
    running = both.select(
        "uid",
        order,
        "trigger",
        F.last(F.when(F.col("log_type") == "conn", F.col("record")), ignorenulls=True).over(w).alias("conn"),
        *[F.count(F.when(F.col("log_type") == t, counted)).over(w).alias(f"n_{t}") for t in ("dns", "http", "ssl")],
    )
    return running.filter("trigger = 1 and conn is not null").drop("trigger")


def session_join(malicious: DataFrame, raw: DataFrame, seconds: int = 3600, time: str = "time") -> DataFrame:
    """Each malicious record with the raw records of its uid up to it, at most `seconds` older. Works on streams with
    watermarks, whose state the bound ends, as on tables."""
    m, r = malicious.alias("m"), raw.alias("r")
    bound = (F.col(f"r.{time}") <= F.col(f"m.{time}")) & (F.col(f"r.{time}") >= F.col(f"m.{time}") - F.expr(f"interval {int(seconds)} seconds"))
    return m.join(r, (F.col("m.uid") == F.col("r.uid")) & bound).select(F.col("m.uid").alias("uid"), F.col(f"m.{time}").alias("at"), F.col("m.record").alias("malicious"), F.col(f"r.{time}").alias("raw_at"), F.col("r.record").alias("raw"))


def attach_scores(records: DataFrame, scores: DataFrame, batch: str = "batch_id", place: str = "place") -> DataFrame:
    """records with the score of the same batch and place; batches whose counts differ drop whole."""
    n = records.groupBy(batch).agg(F.count(F.lit(1)).alias("__n"))
    m = scores.groupBy(batch).agg(F.count(F.lit(1)).alias("__m"))
    whole = n.join(m, batch).filter("__n = __m").select(batch)
    return records.join(whole, batch, "left_semi").join(scores, [batch, place])
