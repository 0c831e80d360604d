"""Fixed-width vectors of each log type, of single records without history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S

c = F.col


def _ends() -> list[Column]:
    return [*S.enc_ip5(c("orig_h")), *S.enc_ip5(c("resp_h")), S.norm_port(c("orig_p")), S.norm_port(c("resp_p"))]


def _filled(values: Column) -> Column:
    return F.coalesce(F.size(values), F.lit(0)) > 0


def _share_of(value: Column, most: float) -> Column:
    return F.least(F.coalesce(value, F.lit(0)), F.lit(int(most))) / most


def vec_conn41() -> Column:
    return F.array(
        *_ends(),
        S.enc_proto(c("proto")),
        *S.enc_service9(c("service")),
        S.enc_conn_state(c("conn_state")),
        *S.enc_time4(S.number(c("ts"))),
        S.norm_duration(c("duration")),
        S.norm_bytes(c("orig_bytes")),
        S.norm_bytes(c("resp_bytes")),
        S.norm_packets(c("orig_pkts")),
        S.norm_packets(c("resp_pkts")),
        *S.derived_conn7(c("duration"), c("orig_bytes"), c("resp_bytes"), c("orig_pkts"), c("resp_pkts")),
        S.bool_num(c("local_orig")),
        S.flag(c("missed_bytes") > 0),
    )


def vec_ssl33() -> Column:
    version = S.text(c("version"))
    level = F.when(F.contains(version, F.lit("TLSv1.3")), 1.0).when(F.contains(version, F.lit("TLSv1.2")), 0.8).when(F.contains(version, F.lit("TLSv1.1")), 0.5).when(F.contains(version, F.lit("TLSv1.0")), 0.3).when(F.contains(version, F.lit("SSLv3")), 0.1).otherwise(0.0)
    name = S.text(c("server_name"))
    foreign = c("subject").isNotNull() & c("issuer").isNotNull() & (c("subject") != c("issuer"))
    return F.array(
        *_ends(),
        *S.enc_time4(S.number(c("ts"))),
        S.enc_ssl_version(c("version")),
        *S.enc_cert3(c("subject"), c("issuer")),
        _share_of(F.length(name), 255.0),
        S.entropy(name),
        S.bool_num(c("established")),
        _share_of(F.length(S.text(c("cipher"))), 100.0),
        S.flag(S.text(c("curve")) != ""),
        S.bool_num(c("resumed")),
        S.bool_num(c("resumed")) * 0.5,
        S.zero(),
        level,
        S.flag(_filled(c("cert_chain_fuids"))),
        S.flag(_filled(c("client_cert_chain_fuids"))),
        S.flag(S.text(c("validation_status")) != ""),
        S.bool_num(c("established")) * 0.5 + S.flag(foreign) * 0.3 + S.flag(level > 0.5) * 0.2,
    )


def vec_dns38() -> Column:
    n = F.greatest(F.coalesce(F.size("answers"), F.lit(0)), F.lit(0))
    half = F.when(n > 0, 0.5).otherwise(0.0)
    length = F.length(S.text(c("query")))
    return F.array(
        *_ends(),
        S.enc_proto(c("proto")),
        *S.enc_time4(S.number(c("ts"))),
        *S.enc_dns_query5(c("query")),
        _share_of(c("qtype"), 100.0),
        S.enc_rcode(c("rcode_name")),
        F.when(c("rtt") > 0, F.log1p(c("rtt")) / F.log1p(F.lit(10.0))).otherwise(0.0),
        *[S.bool_num(c(x)) for x in ("AA", "TC", "RD", "RA")],
        S.flag(c("Z") > 0),
        F.least(n, F.lit(20)) / 20.0,
        half,
        half,
        half,
        S.bool_num(c("rejected")),
        _share_of(c("trans_id"), 65535.0),
        F.when(length > 0, n / length).otherwise(0.0),
        S.flag(F.upper(c("rcode_name")) == "NXDOMAIN"),
    )


def vec_http52() -> Column:
    req, resp = S.number(c("request_body_len")), S.number(c("response_body_len"))
    body = lambda x: F.when(x > 0, F.log1p(x) / F.log1p(F.lit(1e9))).otherwise(0.0)
    agent = S.text(c("user_agent"))
    return F.array(
        *_ends(),
        *S.enc_time4(S.number(c("ts"))),
        *S.enc_method9(c("method")),
        *S.enc_uri6(c("uri")),
        *S.enc_status6(c("status_code")),
        body(req),
        body(resp),
        _share_of(c("trans_depth"), 20.0),
        _share_of(F.length(agent), 500.0),
        S.entropy(agent),
        S.flag(F.contains(F.lower(agent), F.lit("bot"))),
        S.flag(S.text(c("referrer")) != ""),
        S.entropy(c("referrer")),
        S.entropy(c("host")),
        F.when(req + resp > 0, req / (req + resp)).otherwise(0.5),
        S.flag(c("username").isNotNull() | c("password").isNotNull()),
        S.flag(_filled(c("orig_fuids"))),
        S.flag(_filled(c("resp_fuids"))),
        S.flag(_filled(c("proxied"))),
        S.flag(_filled(c("tags"))),
    )


VECTORS = {"conn": (vec_conn41, 41), "ssl": (vec_ssl33, 33), "dns": (vec_dns38, 38), "http": (vec_http52, 52)}


def encode_dispatch(records: DataFrame, log_type: str, out: str = "features") -> DataFrame:
    """records of one type (any case) with its vector; a record whose vector has a null drops. An unknown type gives no rows.

    The vector comes out of a generator, so that it is worked out once: a filter on a plain column would be pushed down with the
    vector's whole expression in it."""
    kind = log_type.strip().lower()
    if kind not in VECTORS:
        return records.withColumn(out, F.lit(None).cast("array<double>")).limit(0)
    return records.withColumn(out, F.explode(F.array(VECTORS[kind][0]()))).filter(~F.exists(out, lambda x: x.isNull()))
