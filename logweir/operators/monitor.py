"""Roll-ups of volumes, lag and load over ticks of time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def throughput(ticks: DataFrame, key: str = "topic", tick: str = "tick") -> DataFrame:
    """ticks (key, tick, ingested, stored) with the change since the key's last tick and the change per second."""
    w = Window.partitionBy(key).orderBy(tick)
    seconds = (F.unix_micros(F.col(tick)) - F.unix_micros(F.lag(tick).over(w))) / 1e6
    out = ticks
    for c in ("ingested", "stored"):
        change = F.coalesce(F.col(c) - F.lag(c).over(w), F.lit(0))
        out = out.withColumn(f"{c}_change", change).withColumn(f"{c}_per_s", F.coalesce(change / seconds, F.lit(0.0)))
    return out


def lag_efficiency(ticks: DataFrame, tick: str = "tick") -> DataFrame:
    """tick, totals, efficiency (whole percent), lag, backlog (ingest change less store change since the last tick).

    Totals are a row for each tick; the window over them is small."""
    t = ticks.groupBy(tick).agg(*[F.sum(c).alias(c) for c in ("ingested", "stored", "buffered")])
    w = Window.orderBy(tick)
    change = lambda c: F.coalesce(F.col(c) - F.lag(c).over(w), F.lit(0))
    return t.select(tick, "ingested", "stored", "buffered", F.when(F.col("ingested") > 0, F.floor(F.col("stored") * 100 / F.col("ingested"))).otherwise(0).cast("long").alias("efficiency"), (F.col("ingested") - F.col("stored") - F.col("buffered")).alias("lag"), (change("ingested") - change("stored")).alias("backlog"))


def _level(value: Column, steps: tuple[tuple[float, str], ...], rest: str) -> Column:
    out = F.when(F.lit(False), rest)
    for least, name in steps:
        out = out.when(value > least, name)
    return out.otherwise(rest)


def load_levels(lag: Column, buffered: Column, rate: Column) -> tuple[Column, Column, Column]:
    return _level(lag, ((100, "red"), (10, "amber")), "green"), _level(buffered, ((400, "red"), (200, "amber")), "green"), _level(rate, ((50, "green"), (10, "amber")), "red")


def monitor_log_parse(lines: DataFrame, line: str = "value") -> DataFrame:
    """The metrics of monitor text lines; null where a line has none."""
    def number(pattern):
        return F.regexp_extract(line, pattern, 1).try_cast("double")

    return lines.select(
        number(r"Ingestion Rate: ([0-9.]+)").alias("ingest"),
        number(r"Processing Rate: ([0-9.]+)").alias("processing"),
        number(r"Lag: (-?[0-9.]+)").alias("lag"),
        number(r"Efficiency: ([0-9.]+)").alias("efficiency"),
        F.nullif(F.regexp_extract(line, r"^\s*([A-Za-z0-9_-]+): CPU=", 1), F.lit("")).alias("container"),
        number(r"CPU=([0-9.]+)%").alias("cpu"),
        number(r"MEM=([0-9.]+)").alias("mem"),
    )


def bottleneck_report(parsed: DataFrame) -> DataFrame:
    """One row of means and maxima as whole numbers, the gap between ingest and processing, and whether it is over 1000."""
    whole = lambda c: F.coalesce(c, F.lit(0.0)).cast("long")
    held = parsed.agg(*[whole(f(c)).alias(f"{n}_{c}") for c in ("ingest", "processing", "lag") for n, f in (("avg", F.avg), ("max", F.max))], whole(F.avg("efficiency")).alias("avg_efficiency"))
    return held.withColumn("gap", F.col("avg_ingest") - F.col("avg_processing")).withColumn("bottleneck", F.col("gap") > 1000)


def container_load(parsed: DataFrame) -> DataFrame:
    """container, avg_cpu, peak_cpu, level; kafka's limits count for four cores."""
    c = parsed.filter("container is not null and cpu is not null").groupBy("container").agg(F.avg("cpu").alias("avg_cpu"), F.max("cpu").alias("peak_cpu"))
    share = F.col("avg_cpu") / F.when(F.col("container") == "kafka", 4.0).otherwise(1.0)
    return c.withColumn("level", _level(share, ((80, "bottleneck"), (50, "high")), "normal"))
