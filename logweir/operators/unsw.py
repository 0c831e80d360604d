"""42 features of connections and sessions for attack classification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import frames
from ..functions import scalar as S

# Codes of services and states; all else is 0 (protocols: null 0, others 3).
PROTO_CODES = {"tcp": 0, "udp": 1, "icmp": 2}
SERVICE_CODES = {"http": 1, "https": 2, "ssl": 2, "dns": 3, "ssh": 4, "ftp": 5}
STATE_CODES = {"SF": 1, "S0": 2, "REJ": 3, "S1": 4, "S2": 5, "S3": 6, "RSTO": 7, "RSTR": 8, "OTH": 13}
GAPS, MOST = 50, 255
#: Names of the counters and what they count beside their scope.
COUNTERS = {
    "ct_srv_src": ["src", "service"],
    "ct_state": ["conn_state"],
    "ct_dst": ["resp_h"],
    "ct_src_dport": ["src", "resp_p"],
    "ct_dst_sport": ["resp_h", "orig_p"],
    "ct_dst_src": ["resp_h", "src"],
    "ct_src": ["src"],
    "ct_src_dst": ["src", "resp_h"],
}


def _coded(value: Column, codes: dict[str, int], other: int = 0) -> Column:
    out = F.when(value.isNull(), 0)
    for name, code in codes.items():
        out = out.when(value == name, code)
    return out.otherwise(other).cast("double")


def unsw_codes(proto: Column, service: Column, state: Column) -> list[Column]:
    return [_coded(F.lower(proto), PROTO_CODES, 3), _coded(F.lower(service), SERVICE_CODES), _coded(F.upper(state), STATE_CODES)]


def history_acks(history: Column) -> list[Column]:
    h = S.text(history)
    return [F.length(F.regexp_replace(h, f"[^{letters}]", "")).cast("double") for letters in ("SA", "AD")]


def _iat50(rows: DataFrame, order: tuple[str, ...], dealt: DataFrame | None = None) -> DataFrame:
    held = frames.hot_gaps(rows, "src", list(order), GAPS, "iat", dealt)
    valid = F.col("iat_gap").isNotNull() & (F.coalesce(F.col("orig_h"), F.lit("")) != "")
    dur = F.greatest(S.number(F.col("duration")), F.lit(0.001))
    return held.withColumn("sinpkt", F.when(valid, F.col("iat_mean")).otherwise(dur)).withColumn("dinpkt", F.when(valid, F.col("iat_std")).otherwise(0.0)).drop("iat_mean", "iat_std", "iat_gap")


def iat50(conns: DataFrame, order: tuple[str, ...] = ("us", "seq")) -> DataFrame:
    """Adds sinpkt and dinpkt: mean and population deviation of the source's last 50 valid gaps where this row's gap is
    valid (the deviation from two gaps on), else the duration and 0. A source may hold most of all rows."""
    return _iat50(frames.ranged(conns, ["src"], list(order)), order).drop("__pid")


def _keys(scope: str) -> dict[str, list[str]]:
    return {name: [scope, *[k for k in keys if k != scope]] for name, keys in COUNTERS.items()}


def ct_counters(conns: DataFrame, scope: str = "src", order: tuple[str, ...] = ("us", "seq")) -> DataFrame:
    """Adds the eight running counts within a scope (the source, or the uid for sessions), at most 255 each. A scope may
    hold most of all rows."""
    return frames.hot_counts(frames.ranged(conns, [scope], list(order)), _keys(scope), list(order), MOST).drop("__pid")


def _features(jitter: Column | None, http: dict[str, Column] | None, ftp: Column | None) -> list[Column]:
    c = F.col
    dur = F.greatest(S.number(c("duration")), F.lit(0.001))
    ob, rb, op, rp = (S.number(c(x)) for x in ("orig_bytes", "resp_bytes", "orig_pkts", "resp_pkts"))
    zero = S.zero()
    mean = lambda b, p: F.when(p > 0, b / p).otherwise(0.0)
    like_ftp = S.flag(F.contains(F.lower(S.text(c("service"))), F.lit("ftp")))
    n = {k: c(k).cast("double") for k in COUNTERS}
    j = jitter if jitter is not None else zero
    h = http or {"depth": zero, "length": zero, "methods": zero, "login": zero}
    is_ftp = S.flag((like_ftp > 0) if ftp is None else (h["login"] > 0) | (ftp > 0))
    return [
        F.log1p(dur),
        *unsw_codes(c("proto"), c("service"), c("conn_state")),
        op,
        rp,
        ob,
        rb,
        (op + rp) / dur,
        F.lit(64.0),
        F.lit(64.0),
        ob / dur,
        rb / dur,
        zero,
        zero,
        F.log1p(F.greatest(c("sinpkt"), zero)),
        F.log1p(F.greatest(c("dinpkt"), zero)),
        j,
        j,
        zero,
        zero,
        zero,
        zero,
        F.log1p(dur),
        *history_acks(c("history")),
        mean(ob, op),
        mean(rb, rp),
        h["depth"],
        h["length"],
        n["ct_srv_src"],
        n["ct_state"],
        n["ct_dst"],
        n["ct_src_dport"],
        n["ct_dst_sport"],
        n["ct_dst_src"],
        is_ftp,
        F.when(like_ftp > 0, n["ct_srv_src"]).otherwise(0.0),
        h["methods"],
        n["ct_src"],
        n["ct_src_dst"],
        S.flag((c("orig_h") == c("resp_h")) & (c("orig_p") == c("resp_p"))),
    ]


#: What the features of a connection are made from.
NEEDED = ("us", "orig_h", "orig_p", "resp_h", "resp_p", "proto", "service", "conn_state", "history", "duration", "orig_bytes", "resp_bytes", "orig_pkts", "resp_pkts")


def unsw_conn42(conns: DataFrame, order: tuple[str, ...] = ("us", "seq"), out: str = "features", keep: list[str] | None = None) -> DataFrame:
    """conns with the 42 features; counters and gaps belong to the source (missing: 'unknown'). keep: the columns of conns that
    are wanted beside them, where not all are; the others are neither stored nor shuffled on the way."""
    if keep is not None:
        return unsw_conn42(conns.select(*dict.fromkeys([*keep, *order, *NEEDED])), order, out).select(*keep, out)
    held = conns.withColumn("src", F.coalesce(F.nullif(F.col("orig_h"), F.lit("")), F.lit("unknown")))
    rows = frames.ranged(held, ["src"], list(order))  # once, for gaps and counters, and dealt once for both
    held = _iat50(rows, order, frames.hot_counts(rows, _keys("src"), list(order), MOST))
    return held.withColumn(out, F.array(*_features(None, None, None))).drop(*COUNTERS, "sinpkt", "dinpkt", "__pid")


def session_http(http: DataFrame, uid: str = "uid") -> DataFrame:
    """uid, depth, length, methods, login over a session's http records."""
    login = F.col("username").isNotNull() | F.col("password").isNotNull()
    return http.groupBy(uid).agg(
        F.coalesce(F.max("trans_depth"), F.lit(0)).cast("double").alias("depth"),
        F.least(F.coalesce(F.sum("response_body_len"), F.lit(0)), F.lit(2147483647)).cast("double").alias("length"),
        F.least(F.count_if(F.upper("method").isin("GET", "POST")), F.lit(MOST)).cast("double").alias("methods"),
        S.flag(F.bool_or(login)).alias("login"),
    )


def session_jitter(dns: DataFrame, uid: str = "uid") -> DataFrame:
    """uid, jitter: population deviation of positive round trips, 0 for fewer than two."""
    rtt = F.when(F.col("rtt") > 0, F.col("rtt"))
    return dns.groupBy(uid).agg(F.when(F.count(rtt) >= 2, F.stddev_pop(rtt)).otherwise(0.0).alias("jitter"))


def session_ftp(ssl: DataFrame, uid: str = "uid") -> DataFrame:
    """uid, ftp: whether any server name has 'ftp'."""
    return ssl.groupBy(uid).agg(S.flag(F.bool_or(F.contains(F.lower(F.coalesce("server_name", F.lit(""))), F.lit("ftp")))).alias("ftp"))


def unsw_session42(conns: DataFrame, http: DataFrame, dns: DataFrame, ssl: DataFrame, order: tuple[str, ...] = ("us", "seq"), out: str = "features") -> DataFrame:
    """One vector for each row of conns (the triggers of sessions) from the session's lists; counters belong to the uid."""
    held = conns.withColumn("src", F.coalesce(F.nullif(F.col("orig_h"), F.lit("")), F.lit("unknown")))
    held = ct_counters(iat50(held, order), "uid", order)
    met = held.join(session_http(http), "uid", "left").join(session_jitter(dns), "uid", "left").join(session_ftp(ssl), "uid", "left")
    filled = lambda name: F.coalesce(F.col(name), S.zero())
    features = _features(filled("jitter"), {k: filled(k) for k in ("depth", "length", "methods", "login")}, filled("ftp"))
    return met.withColumn(out, F.array(*features)).drop(*COUNTERS, "sinpkt", "dinpkt", "depth", "length", "methods", "login", "jitter", "ftp")


def latest_per(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by order."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(o).desc() for o in order])
    return df.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")
