"""Encoders of single values as column expressions. Null and empty give 0.0 unless a docstring says otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The codes that the feature layouts ask for.
PROTOCOLS = {"tcp": 0.25, "udp": 0.5, "icmp": 0.75, "icmp6": 1.0}
SERVICES = (("http",), ("https", "ssl"), ("dns",), ("ssh",), ("ftp", "ftp-data"), ("smtp",), ("pop3",), ("imap",))
CONN_STATES = ("S0", "S1", "SF", "REJ", "S2", "S3", "RSTO", "RSTR", "RSTOS0", "RSTRH", "SH", "SHR", "OTH")
RCODES = {"NOERROR": 0.0, "FORMERR": 0.2, "SERVFAIL": 0.4, "NXDOMAIN": 0.6, "NOTIMP": 0.8, "REFUSED": 1.0}
METHODS = ("GET", "POST", "PUT", "DELETE", "HEAD", "OPTIONS", "PATCH", "CONNECT")
SSL_VERSIONS = (("sslv2", 1), ("sslv3", 2), ("tlsv1.0", 3), ("tlsv10", 3), ("tlsv1.1", 4), ("tlsv11", 4), ("tlsv1.2", 5), ("tlsv12", 5), ("tlsv1.3", 6), ("tlsv13", 6))


def zero() -> Column:
    return F.lit(0.0)


def flag(condition: Column) -> Column:
    """1.0 where the condition holds, else 0.0 (also for null)."""
    return F.when(condition, 1.0).otherwise(0.0)


def number(value: Column) -> Column:
    return F.coalesce(value.cast("double"), zero())


def text(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def _log_share(value: Column, most: float) -> Column:
    return F.when(value > 0, F.log1p(value.cast("double")) / F.log1p(F.lit(most))).otherwise(0.0)


def parts(value: Column, separator: str) -> Column:
    """Number of parts between separators when empty parts at the end don't count: '' has 1, separators alone have 0."""
    sep = "\\" + separator if separator in ".?/&" else separator
    rest = F.regexp_replace(value, f"(?:{sep})+$", "")
    return F.when(value == "", 1).when(rest == "", 0).otherwise(F.size(F.split(rest, sep)))


def octets(ip: Column) -> Column:
    """The four octets as integers, or null unless there are four whole numbers (dots at the end don't count)."""
    held = F.split(F.regexp_replace(text(ip), r"\.+$", ""), r"\.")
    each = F.transform(held, lambda x: x.try_cast("int"))
    return F.when((F.size(held) == 4) & F.forall(each, lambda x: x.isNotNull()), each)


def enc_ip5(ip: Column) -> list[Column]:
    """Octets over 255 and a flag for private ranges; zeros for anything that isn't an address."""
    o = octets(ip)
    fine = F.coalesce(F.forall(o, lambda x: x.between(0, 255)), F.lit(False))
    private = (o[0] == 10) | ((o[0] == 172) & o[1].between(16, 31)) | ((o[0] == 192) & (o[1] == 168))
    return [F.when(fine, o[i] / 255.0).otherwise(0.0) for i in range(4)] + [flag(fine & private)]


def enc_proto(proto: Column) -> Column:
    out = F.when(F.lit(False), 0.0)
    for name, code in PROTOCOLS.items():
        out = out.when(F.lower(proto) == name, code)
    return out.otherwise(0.0)


def enc_service9(service: Column) -> list[Column]:
    """One of nine; null and unknown services are the last."""
    low = F.lower(text(service))
    known = [low.isin(*names) for names in SERVICES]
    other = ~low.isin(*[n for names in SERVICES for n in names])
    return [flag(k) for k in known] + [flag(other)]


def enc_conn_state(state: Column) -> Column:
    """Place among thirteen states over 13, case-sensitive."""
    out = F.when(F.lit(False), 0.0)
    for i, name in enumerate(CONN_STATES):
        out = out.when(state == name, (i + 1) / 13.0)
    return out.otherwise(0.0)


def count_of(value: Column, letter: str) -> Column:
    return (F.length(value) - F.length(F.replace(value, F.lit(letter), F.lit("")))).cast("double")


def enc_history6(history: Column) -> list[Column]:
    h = text(history)
    n = F.greatest(F.length(h), F.lit(1))
    return [F.log1p(F.length(h).cast("double")) / F.log1p(F.lit(100.0))] + [count_of(h, c) / n for c in "SAFRD"]


def norm_port(port: Column) -> Column:
    return F.when(port >= 0, F.least(port, F.lit(65535)) / 65535.0).otherwise(0.0)


def norm_bytes(size: Column) -> Column:
    return _log_share(size, 1e12)


def norm_duration(seconds: Column) -> Column:
    return _log_share(seconds, 86400.0)


def norm_packets(packets: Column) -> Column:
    return _log_share(packets, 1e6)


def hour_of(ts: Column) -> Column:
    return F.pmod(F.floor(F.floor(ts) / 3600), F.lit(24)).cast("double")


def minute_of(ts: Column) -> Column:
    return F.pmod(F.floor(F.floor(ts) / 60), F.lit(60)).cast("double")


def enc_time4(ts: Column) -> list[Column]:
    """Hour, ISO day of week, minute as shares, and a flag for night, all in UTC."""
    day = F.pmod(F.floor(F.floor(ts) / 86400) + 3, F.lit(7)) + 1
    hour = hour_of(ts)
    return [hour / 24.0, day / 7.0, minute_of(ts) / 60.0, flag((hour >= 22) | (hour <= 6))]


def derived_conn7(duration: Column, orig_bytes: Column, resp_bytes: Column, orig_pkts: Column, resp_pkts: Column) -> list[Column]:
    ob, rb, op, rp = map(number, (orig_bytes, resp_bytes, orig_pkts, resp_pkts))
    size, packets = ob + rb, op + rp
    seconds = F.when(number(duration) <= 0, 0.001).otherwise(number(duration))
    mean = lambda b, p: F.log1p(F.when(p > 0, b / p).otherwise(0.0)) / F.log1p(F.lit(65536.0))
    return [
        F.when(size > 0, ob / size).otherwise(0.5),
        F.when(packets > 0, op / packets).otherwise(0.5),
        F.log1p(size / seconds) / F.log1p(F.lit(1e9)),
        F.log1p(packets / seconds) / F.log1p(F.lit(1e5)),
        mean(ob, op),
        mean(rb, rp),
        F.when(packets > 0, F.abs(op - rp) / packets).otherwise(0.0),
    ]


def entropy(value: Column) -> Column:
    """Bits of Shannon entropy over characters, over 8. For texts of a few hundred characters; see entropy_of_texts for long ones."""
    signs = F.filter(F.split(text(value), ""), lambda c: c != "")
    n = F.size(signs)

    def add(total: Column, c: Column) -> Column:
        p = F.size(F.filter(signs, lambda x: x == c)) / n
        return total - p * F.log2(p)

    return F.aggregate(F.array_distinct(signs), zero(), add) / 8.0


def enc_dns_query5(query: Column) -> list[Column]:
    q = text(query)
    found = [F.least(F.length(q), F.lit(255)) / 255.0, F.least(parts(q, "."), F.lit(10)) / 10.0, entropy(q), flag(q.rlike(r"^[0-9.]+$")), F.least(count_of(q, "-"), F.lit(10.0)) / 10.0]
    return [F.when(q == "", 0.0).otherwise(x) for x in found]


def enc_rcode(rcode: Column) -> Column:
    out = F.when(F.lit(False), 0.0)
    for name, code in RCODES.items():
        out = out.when(F.upper(rcode) == name, code)
    return out.otherwise(0.0)


def enc_method9(method: Column) -> list[Column]:
    up = F.upper(text(method))
    return [flag(up == m) for m in METHODS] + [flag(~up.isin(*METHODS))]


def enc_uri6(uri: Column) -> list[Column]:
    """A URI made of question marks alone has no path; its path parts are null, and the record that holds it drops."""
    u = text(uri)
    by_mark = parts(u, "?")
    path = F.split(u, r"\?")[0]
    params = F.when(by_mark > 1, parts(F.split(u, r"\?")[1], "&")).otherwise(0)
    segments = F.when(by_mark == 0, F.lit(None).cast("int")).otherwise(parts(path, "/"))
    found = [F.least(F.length(u), F.lit(500)) / 500.0, F.when(segments.isNull(), F.lit(None).cast("double")).otherwise(F.least(segments, F.lit(20)) / 20.0), flag(by_mark > 1), F.least(params, F.lit(50)) / 50.0, entropy(u), flag(u.rlike("[<>\"'`]"))]
    return [F.when(u == "", 0.0).otherwise(x) for x in found]


def enc_status6(status: Column) -> list[Column]:
    code = F.greatest(F.least(F.coalesce(status.cast("int"), F.lit(0)), F.lit(599)), F.lit(0))
    return [code / 600.0] + [flag(code.between(k * 100, k * 100 + 99)) for k in (2, 3, 4, 5)] + [flag(code.isin(401, 403, 404))]


def enc_ssl_version(version: Column) -> Column:
    out = F.when(F.lit(False), 0.0)
    for name, sixths in SSL_VERSIONS:
        out = out.when(F.contains(F.lower(version), F.lit(name)), sixths / 6.0)
    return out.otherwise(0.0)


def enc_cert3(subject: Column, issuer: Column) -> list[Column]:
    s, i = text(subject), text(issuer)
    return [flag(s != ""), flag(i != ""), flag((s != "") & (s == i))]


def bool_num(value: Column) -> Column:
    return flag(value)


def parse_ts(value: Column) -> Column:
    """Text as a number of seconds; blank or not a number is 0.0."""
    return F.coalesce(F.trim(value).try_cast("double"), zero())


def safe_log(value: Column) -> Column:
    """log1p of the value, negatives as 0; not-a-number, infinite and null are 0."""
    return F.when(value.isNull() | F.isnan(value) | (F.abs(value) == float("inf")), 0.0).otherwise(F.log1p(F.greatest(value, zero())))


def valid_ipv4(ip: Column) -> Column:
    """Four parts of one to three digits, none above 255."""
    return F.coalesce(ip.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$") & F.forall(F.split(ip, r"\."), lambda x: x.try_cast("int") <= 255), F.lit(False))
