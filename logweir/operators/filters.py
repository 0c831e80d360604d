"""Predicates and small projections over log records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOG_TYPES = ("conn", "dns", "http", "ssl")


def source_key(orig_h: Column) -> Column:
    """The source of a record; missing and empty are 'unknown'."""
    return F.coalesce(F.nullif(orig_h, F.lit("")), F.lit("unknown"))


def drop_trusted(records: DataFrame, trusted: DataFrame, source: str = "orig_h", ip: str = "ip") -> DataFrame:
    """records whose source isn't in the list (exact text, trimmed). An empty or null source is never trusted.

    The list joins by hash; Spark broadcasts it while it is small and shuffles by source beyond that."""
    ips = trusted.select(F.trim(F.col(ip)).alias("__ip")).filter("__ip <> ''").distinct()
    return records.join(ips, F.trim(F.col(source)) == F.col("__ip"), "left_anti")


def of_width(df: DataFrame, column: str, width: int) -> DataFrame:
    """Rows whose vector has the declared width; null vectors go."""
    return df.filter(F.size(F.col(column)) == width)


def over_threshold(df: DataFrame, score: str, threshold: Column | float) -> DataFrame:
    """Rows with score at or above the threshold."""
    return df.filter(F.col(score) >= (threshold if isinstance(threshold, Column) else F.lit(threshold)))


def attack_only(df: DataFrame, label: str, known: list[str] | None = None) -> DataFrame:
    """Predictions that name an attack: not null, 'normal' or 'unknown' (any case); with `known`, only those classes."""
    rows = df.filter(~F.lower(F.coalesce(F.col(label), F.lit("normal"))).isin("normal", "unknown"))
    return rows.filter(F.col(label).isin(known)) if known is not None else rows


def unwrapped(value: Column) -> Column:
    """The record inside its zeek-<type> envelope, or the record itself."""
    return F.coalesce(*[F.get_json_object(value, f"$['zeek-{t}']") for t in LOG_TYPES], value)


def extract_uid(value: Column) -> Column:
    """The top-level uid if the key is there, else that of the first child log that has the key; null where it is null, empty or nowhere."""
    has = lambda x: F.coalesce(F.array_contains(F.json_object_keys(x), "uid"), F.lit(False))
    found = F.when(has(value), F.get_json_object(value, "$.uid"))
    for t in LOG_TYPES:
        found = found.when(has(F.get_json_object(value, f"$['zeek-{t}']")), F.get_json_object(value, f"$['zeek-{t}'].uid"))
    return F.nullif(found, F.lit(""))


def infer_log_type(value: Column) -> Column:
    """The type of a record by the keys it has (null values count as there); null if none fits."""
    keys = F.json_object_keys(unwrapped(value))
    both = lambda a, b: F.array_contains(keys, a) & F.array_contains(keys, b)
    return F.when(both("conn_state", "duration"), "conn").when(both("query", "rcode_name"), "dns").when(both("method", "host"), "http").when(both("server_name", "cipher"), "ssl")
