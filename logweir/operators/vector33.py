"""The 33 features of a log record: time, addresses, port, history of its source, flow dynamics, flags."""

from __future__ import annotations

from math import pi

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import frames
from ..functions import scalar as S
from .filters import source_key

# Index of each known port; any other is 9.
PORT_INDEX = {80: 1, 8080: 2, 21: 3, 53: 4, 22: 5, 3306: 6, 443: 7, 445: 8}
OTHER_PORT = 9
#: Flows after which a source's state starts anew, and gaps that its statistics hold.
FLOWS_PER_EPOCH, GAPS = 2000, 100
NAMES = (
    ["hour_sin", "hour_cos", "minute_sin", "minute_cos"]
    + [f"src_octet{i}" for i in range(1, 5)]
    + [f"dst_octet{i}" for i in range(1, 5)]
    + ["src_port_index", "dst_port_index", "flow_count", "distinct_ports", "port_ratio"]
    + ["duration", "iat_mean", "iat_std", "orig_pkts", "resp_pkts", "orig_bytes", "resp_bytes", "byte_rate", "packet_rate", "bytes_per_packet", "size_gap"]
    + ["flag_s", "flag_f", "flag_r", "flag_p", "flag_a"]
)


def time_cyclic(ts: Column) -> list[Column]:
    hour, minute = S.hour_of(S.number(ts)), S.minute_of(S.number(ts))
    return [F.sin(2 * pi * hour / 24), F.cos(2 * pi * hour / 24), F.sin(2 * pi * minute / 60), F.cos(2 * pi * minute / 60)]


def ip_octets4(ip: Column) -> list[Column]:
    """Octets over 255 without a check of their range; zeros unless there are four whole numbers."""
    o = S.octets(ip)
    return [F.coalesce(o[i] / 255.0, S.zero()) for i in range(4)]


def port_index(port: Column) -> Column:
    out = F.when(F.lit(False), 0)
    for p, i in PORT_INDEX.items():
        out = out.when(port == p, i)
    return out.otherwise(OTHER_PORT).cast("double")


def flow_duration(duration: Column, rtt: Column) -> Column:
    d = S.number(duration)
    d = F.when(d <= 0, F.when(S.number(rtt) > 0, S.number(rtt)).otherwise(d)).otherwise(d)
    return F.when(d <= 0, 0.001).otherwise(d)


def interaction(records: DataFrame, order: tuple[str, ...] = ("us", "seq"), place: str | None = None) -> DataFrame:
    """Adds src, epoch, flow_count, distinct_ports, port_ratio: per source, within epochs of 2000 flows. place: the name of a
    column for the flow's number (from 1) within its source, if it is wanted.

    Flows are numbered by range of (source, arrival), so a hot source is spread over tasks; what follows works on
    epochs, which are small."""
    held = frames.numbered(records.withColumn("src", source_key(F.col("orig_h"))), ["src"], list(order), "__rn")
    held = held.withColumn("epoch", F.floor((F.col("__rn") - 1) / FLOWS_PER_EPOCH)).withColumn("flow_count", (F.col("__rn") - 1) % FLOWS_PER_EPOCH + 1)
    held = held.repartition("src", "epoch")  # serves all windows that follow, also those over a port within an epoch
    first = F.row_number().over(Window.partitionBy("src", "epoch", "resp_p").orderBy(*order)) == 1
    so_far = Window.partitionBy("src", "epoch").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return held.withColumn("__first", F.when(first, 1).otherwise(0)).withColumn("distinct_ports", F.sum("__first").over(so_far)).withColumn("port_ratio", F.col("distinct_ports") / F.col("flow_count")).withColumnsRenamed({"__rn": place} if place else {}).drop("__first", "__rn")


def iat_stats(records: DataFrame, order: tuple[str, ...] = ("us", "seq")) -> DataFrame:
    """Adds iat_mean and iat_std, in seconds, of the last 100 valid gaps in the row's epoch. Needs src and epoch.

    An empty source has a count of its flows but no gaps of its own: both are zero."""
    held = frames.last_gaps(records, ["src", "epoch"], list(order), GAPS, "iat")
    named = F.coalesce(F.col("orig_h"), F.lit("")) != ""
    return held.withColumn("iat_mean", F.when(named, F.col("iat_mean")).otherwise(0.0)).withColumn("iat_std", F.when(named, F.col("iat_std")).otherwise(0.0)).drop("iat_gap")


def flow_dynamics(duration: Column, iat_mean: Column, iat_std: Column, orig_pkts: Column, resp_pkts: Column, orig_bytes: Column, resp_bytes: Column) -> list[Column]:
    op, rp, ob, rb = map(S.number, (orig_pkts, resp_pkts, orig_bytes, resp_bytes))
    size, packets = ob + rb, op + rp
    mean = lambda b, p: F.when(p > 0, b / p).otherwise(0.0)
    values = [duration, iat_mean, iat_std, op, rp, ob, rb, size / duration, packets / duration, mean(size, packets), F.abs(mean(ob, op) - mean(rb, rp)) / 2]
    return [S.safe_log(v) for v in values]


def tcp_flags(history: Column, ssl_history: Column | None = None) -> list[Column]:
    """Counts of S, F, R, P, A in the history, or in that of the ssl record where it is empty."""
    h = F.coalesce(F.nullif(history, F.lit("")), ssl_history if ssl_history is not None else F.lit(""), F.lit(""))
    return [S.count_of(h, c) for c in "SFRPA"]


#: Columns that other log types lack, and their kinds.
OPTIONAL = {"rtt": "double", "ssl_history": "string"}


def completed(records: DataFrame) -> DataFrame:
    """records with null columns for those that their log type lacks."""
    return records.withColumns({name: F.lit(None).cast(kind) for name, kind in OPTIONAL.items() if name not in records.columns})


def features() -> Column:
    """The 33 features in the order of NAMES, from a record's columns and its source's flow_count, distinct_ports, iat_mean and iat_std."""
    c = F.col
    duration = flow_duration(c("duration"), c("rtt"))
    return F.array(
        *time_cyclic(c("ts")),
        *ip_octets4(c("orig_h")),
        *ip_octets4(c("resp_h")),
        port_index(c("orig_p")),
        port_index(c("resp_p")),
        c("flow_count").cast("double"),
        c("distinct_ports").cast("double"),
        c("distinct_ports") / c("flow_count"),
        *flow_dynamics(duration, c("iat_mean"), c("iat_std"), c("orig_pkts"), c("resp_pkts"), c("orig_bytes"), c("resp_bytes")),
        *tcp_flags(c("history"), c("ssl_history")),
    )


def vector33(records: DataFrame, order: tuple[str, ...] = ("us", "seq"), out: str = "features", place: str | None = None) -> DataFrame:
    """records with src, epoch and `out`, the 33 features in the order of NAMES; with place, a column of that name with the
    flow's number within its source, which batches then need not work out anew (batches.numbered_batches).

    Needs us (whole microseconds), ts, orig_h, resp_h, orig_p, resp_p and the numbers of a connection; columns that other
    log types lack may be null. The order must be total within a source."""
    held = iat_stats(interaction(completed(records), order, place), order)
    return held.withColumn(out, features()).drop("iat_mean", "iat_std", "flow_count", "distinct_ports", "port_ratio")
