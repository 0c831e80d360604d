"""The registered queries as SQL for another engine (DuckDB), on the given tables alone."""

from __future__ import annotations

from types import SimpleNamespace

from .views import FLOWS_SQL, WEB_SQL

# Fixed values, written out once more here, so that a wrong code in the operators shows.
S = SimpleNamespace(
    PROTOCOLS={"tcp": 0.25, "udp": 0.5, "icmp": 0.75, "icmp6": 1.0},
    SERVICES=(("http",), ("https", "ssl"), ("dns",), ("ssh",), ("ftp", "ftp-data"), ("smtp",), ("pop3",), ("imap",)),
    CONN_STATES=("S0", "S1", "SF", "REJ", "S2", "S3", "RSTO", "RSTR", "RSTOS0", "RSTRH", "SH", "SHR", "OTH"),
    RCODES={"NOERROR": 0.0, "FORMERR": 0.2, "SERVFAIL": 0.4, "NXDOMAIN": 0.6, "NOTIMP": 0.8, "REFUSED": 1.0},
    METHODS=("GET", "POST", "PUT", "DELETE", "HEAD", "OPTIONS", "PATCH", "CONNECT"),
    SSL_VERSIONS=(("sslv2", 1), ("sslv3", 2), ("tlsv1.0", 3), ("tlsv10", 3), ("tlsv1.1", 4), ("tlsv11", 4), ("tlsv1.2", 5), ("tlsv12", 5), ("tlsv1.3", 6), ("tlsv13", 6)),
)
PORT_INDEX = {80: 1, 8080: 2, 21: 3, 53: 4, 22: 5, 3306: 6, 443: 7, 445: 8}
PROTO_CODES = {"tcp": 0, "udp": 1, "icmp": 2}
SERVICE_CODES = {"http": 1, "https": 2, "ssl": 2, "dns": 3, "ssh": 4, "ftp": 5}
STATE_CODES = {"SF": 1, "S0": 2, "REJ": 3, "S1": 4, "S2": 5, "S3": 6, "RSTO": 7, "RSTR": 8, "OTH": 13}
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

SQL: dict[str, str] = {}


def _with(views: dict[str, str], body: str) -> str:
    return f"WITH {', '.join(f'{n} AS ({q})' for n, q in views.items())} {body}" if views else body


FLOWS, WEB = {"flows": FLOWS_SQL}, {"web": WEB_SQL}


def _columns(values: list[str], prefix: str = "f", places: int = 6) -> str:
    return ", ".join(f"round(CAST({v} AS DOUBLE), {places}) + 0.0 AS {prefix}{i:02d}" for i, v in enumerate(values, 1))


def _rows(name: str, view: dict[str, str], values: list[str]) -> None:
    SQL[name] = _with(view, f"SELECT seq, {_columns(values)} FROM {list(view)[-1]}")


# ------------------------------------------------------------------ pieces


def flag(x: str) -> str:
    return f"(CASE WHEN {x} THEN 1.0 ELSE 0.0 END)"


def num(x: str) -> str:
    return f"coalesce(CAST({x} AS DOUBLE), 0.0)"


def case(x: str, codes: dict, other) -> str:
    return "(CASE " + " ".join(f"WHEN {x} = '{k}' THEN {v}" for k, v in codes.items()) + f" ELSE {other} END)"


def log_share(x: str, most: float) -> str:
    return f"(CASE WHEN {x} > 0 THEN ln(1 + CAST({x} AS DOUBLE)) / ln(1 + {most}) ELSE 0.0 END)"


def octet(ip: str, i: int) -> str:
    return f"TRY_CAST(split_part(rtrim({ip}, '.'), '.', {i}) AS INTEGER)"


def four(ip: str) -> str:
    return f"(len(string_split(rtrim(coalesce({ip}, ''), '.'), '.')) = 4 AND " + " AND ".join(f"{octet(ip, i)} IS NOT NULL" for i in range(1, 5)) + ")"


def ip5(ip: str) -> list[str]:
    o = [octet(ip, i) for i in range(1, 5)]
    fine = f"({four(ip)} AND " + " AND ".join(f"{x} BETWEEN 0 AND 255" for x in o) + ")"
    private = f"({o[0]} = 10 OR ({o[0]} = 172 AND {o[1]} BETWEEN 16 AND 31) OR ({o[0]} = 192 AND {o[1]} = 168))"
    return [f"(CASE WHEN {fine} THEN {x} / 255.0 ELSE 0.0 END)" for x in o] + [flag(f"{fine} AND {private}")]


def ip4(ip: str) -> list[str]:
    return [f"(CASE WHEN {four(ip)} THEN {octet(ip, i)} / 255.0 ELSE 0.0 END)" for i in range(1, 5)]


def hour(ts: str) -> str:
    return f"CAST(CAST(floor(floor({ts}) / 3600) AS BIGINT) % 24 AS DOUBLE)"


def minute(ts: str) -> str:
    return f"CAST(CAST(floor(floor({ts}) / 60) AS BIGINT) % 60 AS DOUBLE)"


def time4(ts: str) -> list[str]:
    day = f"((CAST(floor(floor({ts}) / 86400) AS BIGINT) + 3) % 7 + 1)"
    return [f"{hour(ts)} / 24.0", f"{day} / 7.0", f"{minute(ts)} / 60.0", flag(f"{hour(ts)} >= 22 OR {hour(ts)} <= 6")]


def entropy(x: str) -> str:
    return f"CASE WHEN {x} = '' THEN 0.0 ELSE coalesce((SELECT -sum(n / m * log2(n / m)) FROM (SELECT CAST(count(*) AS DOUBLE) AS n, CAST(length({x}) AS DOUBLE) AS m FROM (SELECT unnest(string_split({x}, '')) AS ch) GROUP BY ch) z), 0.0) / 8.0 END"


def count_of(x: str, ch: str) -> str:
    return f"CAST(length({x}) - length(replace({x}, '{ch}', '')) AS DOUBLE)"


def parts(x: str, sep: str) -> str:
    return f"(CASE WHEN {x} = '' THEN 1 WHEN rtrim({x}, '{sep}') = '' THEN 0 ELSE len(string_split(rtrim({x}, '{sep}'), '{sep}')) END)"


def port(x: str) -> str:
    return f"(CASE WHEN {x} >= 0 THEN least({x}, 65535) / 65535.0 ELSE 0.0 END)"


def service9(x: str) -> list[str]:
    low = f"lower(coalesce({x}, ''))"
    every = [n for names in S.SERVICES for n in names]
    inside = lambda names: f"{low} IN ({', '.join(repr(n) for n in names)})"
    return [flag(inside(names)) for names in S.SERVICES] + [flag(f"NOT {inside(every)}")]


def conn_state(x: str) -> str:
    return case(x, {n: f"{i + 1} / 13.0" for i, n in enumerate(S.CONN_STATES)}, "0.0")


def derived7(dur: str, ob: str, rb: str, op: str, rp: str) -> list[str]:
    ob, rb, op, rp = map(num, (ob, rb, op, rp))
    d = f"(CASE WHEN {num(dur)} <= 0 THEN 0.001 ELSE {num(dur)} END)"
    mean = lambda b, p: f"ln(1 + (CASE WHEN {p} > 0 THEN {b} / {p} ELSE 0.0 END)) / ln(65537.0)"
    return [
        f"(CASE WHEN {ob} + {rb} > 0 THEN {ob} / ({ob} + {rb}) ELSE 0.5 END)",
        f"(CASE WHEN {op} + {rp} > 0 THEN {op} / ({op} + {rp}) ELSE 0.5 END)",
        f"ln(1 + ({ob} + {rb}) / {d}) / ln(1 + 1e9)",
        f"ln(1 + ({op} + {rp}) / {d}) / ln(1 + 1e5)",
        mean(ob, op),
        mean(rb, rp),
        f"(CASE WHEN {op} + {rp} > 0 THEN abs({op} - {rp}) / ({op} + {rp}) ELSE 0.0 END)",
    ]


def dns5(q: str) -> list[str]:
    return [f"(CASE WHEN {q} = '' THEN 0.0 ELSE {x} END)" for x in (f"least(length({q}), 255) / 255.0", f"least({parts(q, '.')}, 10) / 10.0", entropy(q), flag(f"regexp_matches({q}, '^[0-9.]+$')"), f"least({count_of(q, '-')}, 10.0) / 10.0")]


def method9(m: str) -> list[str]:
    up = f"upper(coalesce({m}, ''))"
    return [flag(f"{up} = '{x}'") for x in S.METHODS] + [flag(f"{up} NOT IN ({', '.join(map(repr, S.METHODS))})")]


def uri6(u: str) -> list[str]:
    by = parts(u, "?")
    params = f"(CASE WHEN {by} > 1 THEN {parts(f"split_part({u}, '?', 2)", '&')} ELSE 0 END)"
    found = [f"least(length({u}), 500) / 500.0", f"(CASE WHEN {by} = 0 THEN NULL ELSE least({parts(f"split_part({u}, '?', 1)", '/')}, 20) / 20.0 END)", flag(f"{by} > 1"), f"least({params}, 50) / 50.0", entropy(u), flag(f"regexp_matches({u}, '[<>\"''`]')")]
    return [f"(CASE WHEN {u} = '' THEN 0.0 ELSE {x} END)" for x in found]


def status6(x: str) -> list[str]:
    code = f"greatest(least(coalesce({x}, 0), 599), 0)"
    return [f"{code} / 600.0"] + [flag(f"{code} BETWEEN {k * 100} AND {k * 100 + 99}") for k in (2, 3, 4, 5)] + [flag(f"{code} IN (401, 403, 404)")]


def ssl_version(v: str) -> str:
    return "(CASE " + " ".join(f"WHEN contains(lower({v}), '{n}') THEN {k} / 6.0" for n, k in S.SSL_VERSIONS) + " ELSE 0.0 END)"


def cert3(s: str, i: str) -> list[str]:
    s, i = f"coalesce({s}, '')", f"coalesce({i}, '')"
    return [flag(f"{s} <> ''"), flag(f"{i} <> ''"), flag(f"{s} <> '' AND {s} = {i}")]


def pick(values: tuple[str, ...], n: str = "seq") -> str:
    return f"([{', '.join(map(repr, values))}])[{n} % {len(values)} + 1]"


def safe_log(x: str) -> str:
    return f"(CASE WHEN {x} IS NULL OR isnan({x}) OR isinf({x}) THEN 0.0 ELSE ln(1 + greatest({x}, 0.0)) END)"


# ------------------------------------------------------------------ sources

SQL["read_multi_topic"] = """SELECT 'orders' AS topic, count(*) AS n, count(DISTINCT o_orderkey) AS n_keys, round(sum(o_totalprice), 2) AS amount FROM orders
UNION ALL SELECT 'lineitem', count(*), count(DISTINCT l_orderkey), NULL FROM lineitem"""
SQL["decode_json"] = "SELECT event_type AS topic, count(*) AS n, CASE WHEN event_id % 10 = 9 THEN 'bad' ELSE 'good' END AS kind FROM events GROUP BY ALL"
SQL["typed_logs"] = _with(FLOWS, "SELECT uid, orig_h, orig_p, resp_h, CAST(resp_p AS INTEGER) AS resp_p, proto, conn_state, round(duration, 6) AS duration, orig_bytes FROM flows WHERE seq % 10 <> 9")
SQL["unwrap_envelope"] = _with(FLOWS, "SELECT seq, orig_h, conn_state FROM flows WHERE seq % 10 <> 9")
SQL["extract_uid"] = _with(FLOWS, "SELECT seq, uid FROM flows WHERE seq % 10 <> 9")
SQL["infer_log_type"] = "SELECT event_type AS topic, 'conn' AS found, count(*) AS n FROM events WHERE event_id % 10 <> 9 GROUP BY ALL"
SQL["supervised_sink"] = _with(FLOWS, """SELECT seq, '["' || uid || '","{\\"h\\":\\"' || orig_h || '\\"}",' || (seq % 3) || ',' || (seq % 4) || ',' || (seq % 5) || ']' AS message FROM flows WHERE conn_state = 'REJ'""")
SQL["topic_counts"] = "SELECT event_type AS topic, count(*) AS records FROM events GROUP BY ALL"
SQL["dedup_keep_first"] = "SELECT min(doc_id) AS offset, arg_min(source, doc_id) AS source, CAST(length(text) AS INTEGER) AS chars FROM documents GROUP BY text"
SQL["feature_store_load"] = "SELECT vec_id AS id, round(CAST(embedding[1] AS DOUBLE), 6) AS first, round(CAST(embedding[33] AS DOUBLE), 6) AS last FROM embeddings WHERE label < 5"
SQL["load_ip_list"] = "SELECT DISTINCT '10.0.' || (c_custkey % 3) || '.' || (c_custkey % 200) AS ip FROM customer WHERE c_custkey % 5 <> 0 AND c_custkey % 7 <> 0"

# ------------------------------------------------------------------ filters

SQL["source_key"] = _with(FLOWS, "SELECT CASE WHEN seq % 10 < 2 THEN 'unknown' ELSE orig_h END AS src, count(*) AS n FROM flows GROUP BY ALL")
SQL["drop_trusted"] = _with(FLOWS, "SELECT orig_h, count(*) AS n FROM flows WHERE orig_h NOT IN ('10.0.0.0', '10.0.0.1') GROUP BY ALL")
SQL["valid_ipv4"] = _with(WEB, "SELECT seq, ip, regexp_matches(ip, '^[0-9]{1,3}(\\.[0-9]{1,3}){3}$') AND len(list_filter(string_split(ip, '.'), lambda x: TRY_CAST(x AS INTEGER) <= 255)) = 4 AS valid FROM (SELECT seq, CASE WHEN seq % 9 = 0 THEN orig_h || '.' WHEN seq % 9 = 1 THEN host ELSE resp_h END AS ip FROM web)")
SQL["vector_width_check"] = "SELECT vec_id FROM embeddings WHERE vec_id % 3 = 1"
SQL["emit_over_threshold"] = "SELECT event_id, value FROM events WHERE value >= 400"
SQL["attack_only"] = "SELECT event_type AS label, count(*) AS n FROM events WHERE event_type NOT IN ('view', 'click', 'signup') GROUP BY ALL"

# ------------------------------------------------------------------ scalar encoders

_rows("enc_ip5", WEB, [*ip5("orig_h"), *ip5("resp_h")])
_rows("enc_proto", FLOWS, [case("proto", S.PROTOCOLS, "0.0")])
_rows("enc_service9", FLOWS, service9("service"))
_rows("enc_conn_state", FLOWS, [conn_state("conn_state")])
_rows("enc_history6", FLOWS, ["ln(1 + length(history)) / ln(101.0)", *[f"{count_of('history', x)} / greatest(1, length(history))" for x in "SAFRD"]])
_rows("norm_port", FLOWS, [port("orig_p"), port("(resp_p - 100)")])
_rows("norm_bytes", FLOWS, [log_share("orig_bytes", 1e12), log_share("(resp_bytes - 1000)", 1e12)])
_rows("norm_duration", FLOWS, [log_share("duration", 86400.0)])
_rows("norm_packets", FLOWS, [log_share("orig_pkts", 1e6), log_share("resp_pkts", 1e6)])
_rows("enc_time4", FLOWS, time4("ts"))
_rows("derived_conn7", FLOWS, derived7("duration", "orig_bytes", "resp_bytes", "orig_pkts", "resp_pkts"))
_rows("entropy_short", WEB, [entropy("host")])
_rows("enc_dns_query5", WEB | {"w": "SELECT seq, CASE WHEN seq % 11 = 0 THEN resp_h ELSE host END AS q FROM web"}, dns5("q"))
_rows("enc_rcode", WEB, [case(f"upper({pick(('noerror', 'FORMERR', 'SERVFAIL', 'NXDOMAIN', 'NOTIMP', 'REFUSED', 'OTHER'))})", S.RCODES, "0.0")])
_rows("enc_method9", WEB | {"w": f"SELECT seq, {pick(('get', 'POST', 'PUT', 'DELETE', 'TRACE', 'CONNECT'))} AS m FROM web"}, method9("m"))
_rows("enc_uri6", WEB, uri6("uri"))
_rows("enc_status6", WEB, status6("(n - 100)"))
_rows("enc_ssl_version", WEB | {"w": f"SELECT seq, {pick(('SSLv2', 'SSLv3', 'TLSv1.0', 'TLSv11', 'TLSv1.2', 'TLSv13', 'x'))} AS v FROM web"}, [ssl_version("v")])
_rows("enc_cert3", WEB, cert3("CASE WHEN seq % 3 = 0 THEN host END", "CASE WHEN seq % 2 = 0 THEN host ELSE 'ca' END"))
_rows("bool_num", FLOWS, [flag("local_orig"), "0.0"])
_rows("parse_ts", WEB, ["CASE WHEN seq % 3 = 0 THEN 12.5 ELSE 0.0 END"])
_rows("safe_log", FLOWS, [safe_log("(duration - 5)"), safe_log("(CASE WHEN seq % 2 = 0 THEN CAST('nan' AS DOUBLE) ELSE duration END)")])
SQL["entropy"] = """WITH ch AS (SELECT doc_id, unnest(string_split(text, '')) AS c FROM documents WHERE text <> ''), n AS (SELECT doc_id, c, CAST(count(*) AS DOUBLE) AS n FROM ch GROUP BY ALL),
s AS (SELECT doc_id, sum(n) AS t, sum(n * log2(n)) AS w FROM n GROUP BY ALL) SELECT d.doc_id, round(coalesce((log2(t) - w / t) / 8, 0), 6) AS entropy FROM documents d LEFT JOIN s USING (doc_id)"""

# ------------------------------------------------------------------ 33 features

_PI = "pi()"


def cyclic(ts: str) -> list[str]:
    return [f"{f}(2 * {_PI} * {x(ts)} / {n})" for x, n in ((hour, 24), (minute, 60)) for f in ("sin", "cos")]


def port_index(x: str) -> str:
    return "(CASE " + " ".join(f"WHEN {x} = {p} THEN {i}" for p, i in PORT_INDEX.items()) + " ELSE 9 END)"


def dynamics(dur: str, m: str, s: str, op: str, rp: str, ob: str, rb: str) -> list[str]:
    mean = lambda b, p: f"(CASE WHEN {p} > 0 THEN ({b}) / CAST({p} AS DOUBLE) ELSE 0.0 END)"
    v = [dur, m, s, op, rp, ob, rb, f"({ob} + {rb}) / {dur}", f"({op} + {rp}) / {dur}", mean(f"{ob} + {rb}", f"({op} + {rp})"), f"abs({mean(ob, op)} - {mean(rb, rp)}) / 2"]
    return [safe_log(f"CAST({x} AS DOUBLE)") for x in v]


_DUR = "(CASE WHEN duration <= 0 THEN 0.001 ELSE duration END)"
_rows("time_cyclic", FLOWS, cyclic("ts"))
_rows("ip_octets4", WEB, [*ip4("orig_h"), *ip4("resp_h")])
_rows("port_index", FLOWS, [port_index("resp_p")])
_rows("flow_duration", FLOWS, ["CASE WHEN duration > 0 THEN duration WHEN seq % 2 = 0 THEN 0.25 ELSE 0.001 END"])
_rows("tcp_flags", FLOWS | {"w": "SELECT seq, CASE WHEN seq % 3 = 0 THEN 'SPA' ELSE history END AS h FROM flows"}, [count_of("h", x) for x in "SFRPA"])
_rows("flow_dynamics", FLOWS, dynamics(_DUR, "seq % 7", "seq % 5", "orig_pkts", "resp_pkts", "orig_bytes", "resp_bytes"))

_NUMBERED = FLOWS | {
    "a": "SELECT *, orig_h AS src, row_number() OVER (PARTITION BY orig_h ORDER BY us, seq) AS rn FROM flows",
    "b": "SELECT *, CAST(floor((rn - 1) / 2000) AS BIGINT) AS epoch, (rn - 1) % 2000 + 1 AS flow_count FROM a",
    "e": """SELECT *, CASE WHEN row_number() OVER (PARTITION BY src, epoch, resp_p ORDER BY us, seq) = 1 THEN 1 ELSE 0 END AS first,
            us - lag(us) OVER (PARTITION BY src, epoch ORDER BY us, seq) AS gap0 FROM b""",
    "g": "SELECT *, CASE WHEN gap0 > 0 AND gap0 < 3600000000 THEN gap0 END AS gap FROM e",
    "h": """SELECT *, CAST(sum(first) OVER (PARTITION BY src, epoch ORDER BY us, seq ROWS UNBOUNDED PRECEDING) AS BIGINT) AS distinct_ports,
            sum(CASE WHEN gap IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY src, epoch ORDER BY us, seq ROWS UNBOUNDED PRECEDING) AS v FROM g""",
    "i": """SELECT *, coalesce(avg(gap) OVER w, 0) / 1e6 AS iat_mean, coalesce(stddev_pop(gap) OVER w, 0) / 1e6 AS iat_std FROM h
            WINDOW w AS (PARTITION BY src, epoch ORDER BY v RANGE BETWEEN 99 PRECEDING AND CURRENT ROW)""",
}
SQL["interaction"] = _with(_NUMBERED, "SELECT seq, flow_count, distinct_ports, round(distinct_ports / flow_count, 6) AS port_ratio FROM i")
SQL["iat_stats"] = _with(_NUMBERED, "SELECT seq, floor(iat_mean * 1e6 + 0.5) / 1e6 AS iat_mean, round(iat_std, 4) AS iat_std FROM i")
_V33 = [*cyclic("ts"), *ip4("orig_h"), *ip4("resp_h"), port_index("orig_p"), port_index("resp_p"), "flow_count", "distinct_ports", "distinct_ports / flow_count", *dynamics(_DUR, "iat_mean", "iat_std", "orig_pkts", "resp_pkts", "orig_bytes", "resp_bytes"), *[count_of("history", x) for x in "SFRPA"]]
SQL["vector33"] = _with(_NUMBERED, f"SELECT seq, {_columns(_V33, places=4)} FROM i")

# ------------------------------------------------------------------ typed vectors

_ENDS = [*ip5("orig_h"), *ip5("resp_h"), port("orig_p"), port("resp_p")]
_CONN41 = [*_ENDS, case("proto", S.PROTOCOLS, "0.0"), *service9("service"), conn_state("conn_state"), *time4("ts"), log_share("duration", 86400.0), log_share("orig_bytes", 1e12), log_share("resp_bytes", 1e12), log_share("orig_pkts", 1e6), log_share("resp_pkts", 1e6), *derived7("duration", "orig_bytes", "resp_bytes", "orig_pkts", "resp_pkts"), flag("local_orig"), flag("missed_bytes > 0")]
_rows("vec_conn41", FLOWS, _CONN41)

_SSL = WEB | {"v": f"SELECT *, {pick(('TLSv1.3', 'TLSv1.2', 'TLSv1.0', 'SSLv3', 'none'))} AS version, CASE WHEN seq % 3 > 0 THEN host END AS subject, CASE WHEN seq % 5 > 0 THEN 'ca' ELSE host END AS issuer FROM web"}
_LEVEL = "(CASE version WHEN 'TLSv1.3' THEN 1.0 WHEN 'TLSv1.2' THEN 0.8 WHEN 'TLSv1.0' THEN 0.3 WHEN 'SSLv3' THEN 0.1 ELSE 0.0 END)"
_rows("vec_ssl33", _SSL, [*_ENDS, *time4("ts"), ssl_version("version"), *cert3("subject", "issuer"), "least(length(host), 255) / 255.0", entropy("host"), flag("seq % 2 = 0"), "11 / 100.0", flag("seq % 3 = 0"), flag("seq % 4 = 0"), f"{flag('seq % 4 = 0')} * 0.5", "0.0", _LEVEL, flag("seq % 2 = 0"), "0.0", flag("seq % 6 = 0"), f"{flag('seq % 2 = 0')} * 0.5 + {flag('subject IS NOT NULL AND subject <> issuer')} * 0.3 + {flag(_LEVEL + ' > 0.5')} * 0.2"])

_rows("vec_dns38", WEB, [*_ENDS, "0.5", *time4("ts"), *dns5("host"), "least(n % 120, 100) / 100.0", case(pick(("NOERROR", "NXDOMAIN", "SERVFAIL")), S.RCODES, "0.0"), "CASE WHEN n > 0 THEN ln(1 + n / 500.0) / ln(11.0) ELSE 0.0 END", flag("seq % 2 = 0"), "0.0", "1.0", "0.0", flag("n % 2 > 0"), "(seq % 4) / 20.0", *["CASE WHEN seq % 4 > 0 THEN 0.5 ELSE 0.0 END"] * 3, flag("seq % 5 = 0"), "least(n * 50, 65535) / 65535.0", "CASE WHEN length(host) > 0 THEN (seq % 4) / CAST(length(host) AS DOUBLE) ELSE 0.0 END", flag("seq % 3 = 1")])

_HTTP = WEB | {"v": f"SELECT *, {pick(('GET', 'POST', 'TRACE'))} AS method, coalesce(CASE WHEN seq % 2 = 0 THEN 'Mozilla/5.0' WHEN seq % 3 = 0 THEN 'GoogleBot' END, '') AS agent, coalesce(CASE WHEN seq % 4 = 0 THEN url END, '') AS referrer FROM web"}
_rows("vec_http52", _HTTP, [*_ENDS, *time4("ts"), *method9("method"), *uri6("uri"), *status6("(n % 600)"), "CASE WHEN n > 0 THEN ln(1 + n * 10.0) / ln(1 + 1e9) ELSE 0.0 END", "CASE WHEN n > 0 THEN ln(1 + n * 33.0) / ln(1 + 1e9) ELSE 0.0 END", "least(n % 30, 20) / 20.0", "length(agent) / 500.0", entropy("agent"), flag("contains(lower(agent), 'bot')"), flag("referrer <> ''"), entropy("referrer"), entropy("host"), "CASE WHEN n > 0 THEN n * 10 / (n * 43.0) ELSE 0.5 END", flag("seq % 9 = 0"), flag("seq % 2 = 0"), "1.0", "0.0", "0.0"])
SQL["encode_dispatch"] = " UNION ALL ".join(
    f"SELECT '{t}' AS log_type, count(*) AS rows, {n} AS width, round(avg({' + '.join(f'f{i + 1:02d}' for i in range(n))}), 2) AS mean FROM ({SQL[f'vec_{t}{n}']})" for t, n in (("conn", 41), ("ssl", 33), ("dns", 38), ("http", 52))
)

# ------------------------------------------------------------------ 42 features


def codes(proto: str, service: str, state: str) -> list[str]:
    return [case(f"lower({proto})", PROTO_CODES, 3), case(f"lower({service})", SERVICE_CODES, 0), case(f"upper({state})", STATE_CODES, 0)]


def acks(h: str) -> list[str]:
    return [f"length(regexp_replace({h}, '[^{x}]', '', 'g'))" for x in ("SA", "AD")]


_rows("unsw_codes", FLOWS, codes("proto", "service", "conn_state"))
_rows("history_acks", FLOWS, acks("history"))


def _iat50(source: str, scope: str) -> dict[str, str]:
    counters = ", ".join(f"least(count(*) OVER (PARTITION BY {', '.join([scope, *[k for k in keys if k != scope]])} ORDER BY us, seq ROWS UNBOUNDED PRECEDING), 255) AS {n}" for n, keys in COUNTERS.items())
    return {
        "a": f"SELECT *, orig_h AS src, us - lag(us) OVER (PARTITION BY orig_h ORDER BY us, seq) AS gap0 FROM {source}",
        "b": "SELECT *, CASE WHEN gap0 > 0 AND gap0 < 3600000000 THEN gap0 END AS gap FROM a",
        "e": "SELECT *, sum(CASE WHEN gap IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY src ORDER BY us, seq ROWS UNBOUNDED PRECEDING) AS v FROM b",
        "g": f"""SELECT *, {counters}, CASE WHEN gap IS NOT NULL THEN avg(gap) OVER w / 1e6 ELSE greatest(duration, 0.001) END AS sinpkt, CASE WHEN gap IS NOT NULL THEN stddev_pop(gap) OVER w / 1e6 ELSE 0.0 END AS dinpkt FROM e
            WINDOW w AS (PARTITION BY src ORDER BY v RANGE BETWEEN 49 PRECEDING AND CURRENT ROW)""",
    }


_F42 = FLOWS | _iat50("flows", "src")
SQL["iat50"] = _with(_F42, "SELECT seq, floor(sinpkt * 1e6 + 0.5) / 1e6 AS sinpkt, round(dinpkt, 4) AS dinpkt FROM g")
SQL["ct_counters"] = _with(_F42, f"SELECT seq, {', '.join(COUNTERS)} FROM g")


def features42(jitter="0.0", depth="0.0", length="0.0", methods="0.0", ftp=None) -> list[str]:
    d, ob, rb, op, rp = "greatest(duration, 0.001)", *(f"CAST({x} AS DOUBLE)" for x in ("orig_bytes", "resp_bytes", "orig_pkts", "resp_pkts"))
    is_ftp = flag("contains(lower(service), 'ftp')")
    n = list(COUNTERS)
    return [f"ln(1 + {d})", *codes("proto", "service", "conn_state"), op, rp, ob, rb, f"({op} + {rp}) / {d}", "64", "64", f"{ob} / {d}", f"{rb} / {d}", "0", "0", "ln(1 + sinpkt)", "ln(1 + dinpkt)", jitter, jitter, "0", "0", "0", "0", f"ln(1 + {d})", *acks("history"), f"CASE WHEN {op} > 0 THEN {ob} / {op} ELSE 0.0 END", f"CASE WHEN {rp} > 0 THEN {rb} / {rp} ELSE 0.0 END", depth, length, *n[:6], ftp or is_ftp, f"{is_ftp} * ct_srv_src", methods, n[6], n[7], flag("orig_h = resp_h AND orig_p = resp_p")]


SQL["unsw_conn42"] = _with(_F42, f"SELECT seq, {_columns(features42(), places=4)} FROM g")

_TALK = {"talk": "SELECT 'V' || conv_id AS uid, turn AS arrival, CASE role WHEN 'user' THEN 'conn' WHEN 'assistant' THEN 'http' ELSE 'dns' END AS log_type, text AS record FROM conversations"}
_SESSION = _TALK | {
    "http": "SELECT uid, CAST(max(arrival % 5) AS DOUBLE) AS depth, CAST(least(sum(length(record)), 2147483647) AS DOUBLE) AS length, CAST(least(count(*), 255) AS DOUBLE) AS methods, CASE WHEN bool_or(arrival > 6) THEN 1.0 ELSE 0.0 END AS login FROM talk WHERE log_type = 'http' GROUP BY uid",
    "dns": "SELECT uid, CASE WHEN count(r) >= 2 THEN stddev_pop(r) ELSE 0.0 END AS jitter FROM (SELECT uid, CASE WHEN log_type <> 'http' AND length(record) % 100 > 0 THEN length(record) % 100 / 10.0 END AS r FROM talk) GROUP BY uid",
    "ssl": "SELECT uid, CASE WHEN bool_or(arrival % 4 = 1) THEN 1.0 ELSE 0.0 END AS ftp FROM talk WHERE log_type = 'conn' GROUP BY uid",
}
SQL["session_http"] = _with(_SESSION, "SELECT uid, depth, length, methods, CAST(login AS DOUBLE) AS login FROM http")
SQL["session_jitter"] = _with(_SESSION, "SELECT uid, round(CAST(jitter AS DOUBLE), 6) AS jitter FROM dns")
SQL["session_ftp"] = _with(_SESSION, "SELECT uid, CAST(ftp AS DOUBLE) AS ftp FROM ssl")
_CONNS = "SELECT uid, arrival AS seq, arrival * 1000000 + 5 + CAST(substr(uid, 2) AS BIGINT) AS us, '10.0.0.' || (n % 4) AS orig_h, '8.8.8.8' AS resp_h, n % 3 + 1024 AS orig_p, n % 2 + 80 AS resp_p, 'tcp' AS proto, CASE WHEN n % 2 = 0 THEN 'ftp' ELSE 'http' END AS service, 'SF' AS conn_state, 'ShAD' AS history, n % 50 / 10.0 AS duration, n AS orig_bytes, n * 2 AS resp_bytes, n % 9 AS orig_pkts, n % 5 AS resp_pkts FROM (SELECT *, length(record) AS n FROM talk WHERE log_type = 'conn')"
_WANTED = range(42)
_F9 = features42("coalesce(jitter, 0)", "coalesce(depth, 0)", "coalesce(length, 0)", "coalesce(methods, 0)", flag("login > 0 OR ftp > 0"))
SQL["unsw_session42"] = _with(_SESSION | {"conns": _CONNS} | _iat50("conns", "uid"), "SELECT g.uid, seq, " + ", ".join(f"round(CAST({_F9[i]} AS DOUBLE), 4) AS f{i + 1:02d}" for i in _WANTED) + " FROM g LEFT JOIN http USING (uid) LEFT JOIN dns USING (uid) LEFT JOIN ssl USING (uid)")

# ------------------------------------------------------------------ sessions


def _assemble(counted: str) -> str:
    views = _TALK | {
        "tagged": "SELECT *, 0 AS trig FROM talk UNION ALL SELECT *, 1 FROM talk WHERE log_type = 'http' AND arrival >= 3",
        "c": "SELECT *, row_number() OVER (PARTITION BY uid, log_type, record ORDER BY arrival, trig) AS k FROM tagged",
        "r": f"""SELECT *, last_value(CASE WHEN log_type = 'conn' THEN record END IGNORE NULLS) OVER w AS conn, count(CASE WHEN log_type = 'dns' AND {counted} THEN 1 END) OVER w AS n_dns,
             count(CASE WHEN log_type = 'http' AND {counted} THEN 1 END) OVER w AS n_http, count(CASE WHEN log_type = 'ssl' AND {counted} THEN 1 END) OVER w AS n_ssl FROM c
             WINDOW w AS (PARTITION BY uid ORDER BY arrival, trig, record ROWS UNBOUNDED PRECEDING)""",
    }
    return _with(views, "SELECT uid, arrival, CAST(length(conn) AS INTEGER) AS conn_chars, n_dns, n_http, n_ssl FROM r WHERE trig = 1 AND conn IS NOT NULL")


SQL["session_assemble"], SQL["session_assemble_dedup"] = _assemble("true"), _assemble("k = 1")
SQL["session_join"] = _with(_TALK, "SELECT m.uid, m.arrival * 60 AS at, count(*) AS n, min(r.arrival) * 60 AS first FROM talk m JOIN talk r ON m.uid = r.uid AND r.arrival <= m.arrival AND r.arrival >= m.arrival - 2 WHERE m.log_type = 'http' AND m.arrival >= 3 GROUP BY m.uid, m.arrival")
SQL["attach_scores"] = "SELECT event_id, event_id // 50 AS batch_id, event_id % 50 AS place, round(value / 10, 6) AS score FROM events WHERE (event_id // 50) % 4 <> 0"

# ------------------------------------------------------------------ summaries

SQL["store_summary"] = "SELECT event_type AS log_type, count(*) AS rows, min(ts) AS first, max(ts) AS last FROM events GROUP BY ALL"
SQL["count_by_type"] = "SELECT count(*) AS rows FROM events WHERE event_type = 'click'"
SQL["vector_stats"] = """SELECT vec_id, round(list_min(v), 6) AS v_min, round(list_max(v), 6) AS v_max, round(list_avg(v), 6) AS v_mean, round(list_median(v), 6) AS v_median, round(list_stddev_pop(v), 6) AS v_std,
CAST(len(list_filter(v, lambda x: x <> 0)) AS BIGINT) AS v_non_zero FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"""
SQL["class_distribution"] = "SELECT lang, count(*) AS rows FROM documents GROUP BY ALL"
SQL["score_stats"] = """SELECT count(*) AS count, count(*) FILTER (value > 450) AS anomalies, round(count(*) FILTER (value > 450) / count(*), 5) AS anomaly_rate, round(avg(value), 5) AS mean, round(stddev_pop(value), 5) AS std,
round(min(value), 5) AS min, round(max(value), 5) AS max, round(quantile_cont(value, 0.5), 5) AS p50, round(quantile_cont(value, 0.95), 5) AS p95, round(quantile_cont(value, 0.99), 5) AS p99 FROM events"""

# ------------------------------------------------------------------ batches

_SCORED = {"scored": "SELECT event_type AS log_type, event_id, value / 500 AS mae, value > 400 AS attack, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS place FROM events"}
_VECS = {"vecs": "SELECT CASE WHEN label < 5 THEN 'conn' ELSE 'dns' END AS log_type, vec_id, CAST(embedding AS DOUBLE[]) AS f, row_number() OVER (PARTITION BY CASE WHEN label < 5 THEN 'conn' ELSE 'dns' END ORDER BY vec_id) AS place FROM embeddings"}
SQL["score_batches"] = _with(_SCORED, "SELECT log_type, (place - 1) // 50 AS batch_id, count(*) AS n, min(event_id) AS first FROM scored GROUP BY ALL")
_EDGE = _VECS | {"w": "SELECT *, list(f) OVER (PARTITION BY log_type, (place - 1) // 50 ORDER BY place ROWS 9 PRECEDING) AS h FROM vecs"}
SQL["edge_windows"] = _with(_EDGE, "SELECT vec_id, 10 AS steps, round(h[1][1], 6) AS first, round(h[greatest(len(h) - 1, 1)][1], 6) AS before, round(f[1], 6) AS last FROM w")
SQL["train_windows"] = _with(_VECS | {"w": "SELECT *, list(f) OVER (PARTITION BY log_type ORDER BY place ROWS 9 PRECEDING) AS h FROM vecs"}, "SELECT vec_id, 10 AS steps, round(h[1][1], 6) AS first, round(f[1], 6) AS last FROM w WHERE place >= 10")
SQL["chrono_split"] = _with(_VECS | {"n": "SELECT *, count(*) OVER (PARTITION BY log_type) AS n FROM vecs", "s": "SELECT *, CAST(floor(n * 0.2) AS BIGINT) AS v FROM n", "t": "SELECT *, n - v - CASE WHEN v > 0 THEN 10 ELSE 0 END AS t FROM s"}, "SELECT log_type, CASE WHEN v < 1 OR t < 1 OR place <= t THEN 'train' WHEN place > n - v THEN 'validation' ELSE 'gap' END AS split, count(*) AS n, min(vec_id) AS first FROM t GROUP BY ALL")
SQL["learning_batches"] = _with(_SCORED | {"n": "SELECT *, max(place) OVER (PARTITION BY log_type) AS top FROM scored"}, "SELECT log_type, (place - 1) // 500 AS batch_id, count(*) AS n, min(event_id) AS first FROM n WHERE top - place < 1500 GROUP BY ALL")
SQL["latest_n"] = "SELECT event_id AS id, value FROM events WHERE event_type = 'click' ORDER BY ts DESC, event_id DESC LIMIT 25"
_MODELS = {"models": "SELECT 't' || (o_custkey % 5) AS log_type, CAST(o_orderkey AS VARCHAR) AS model_path, o_orderdate AS created_at, o_totalprice / 1e6 AS anomaly_threshold, (o_custkey % 30) / 100.0 AS fpr FROM orders"}
_LATEST = _MODELS | {"latest": "SELECT * FROM models QUALIFY row_number() OVER (PARTITION BY log_type ORDER BY created_at DESC, model_path DESC) = 1"}
SQL["latest_model"] = _with(_LATEST, "SELECT log_type, model_path, round(anomaly_threshold, 6) AS anomaly_threshold FROM latest")

# ------------------------------------------------------------------ thresholds

_FIT = _VECS | {"fit": "SELECT i, min(f[i]) AS low, max(f[i]) - min(f[i]) AS r FROM vecs, (SELECT unnest(range(1, 65)) AS i) WHERE vec_id % 5 <> 0 GROUP BY i"}
SQL["minmax_fit"] = _with(_FIT, "SELECT i - 1 AS i, round(low, 6) AS low, round(r, 6) AS range FROM fit")


def _scaled(x: str) -> str:
    return _with(_FIT, "SELECT vec_id, " + ", ".join(f"round(max({x}) FILTER (i = {k}), 6) AS f{k:02d}" for k in range(1, 9)) + " FROM vecs, fit WHERE i <= 8 GROUP BY vec_id")


SQL["minmax_apply_fit"] = _scaled("(f[i] - low) / CASE WHEN r = 0 THEN 1 ELSE r END")
SQL["minmax_apply_live"] = _scaled("greatest(0.0, least(1.0, (f[i] - low) / (r + 1e-8)))")
SQL["window_error"] = _with(
    _EDGE | {"d": "SELECT vec_id, CASE WHEN k = 1 THEN 10 - len(h) + 1 ELSE 1 END AS times, list_sum(list_transform(range(1, len(f) + 1), lambda j: abs(h[k][j] - f[j]))) / len(f) AS a, list_sum(list_transform(range(1, len(f) + 1), lambda j: (h[k][j] - f[j]) * (h[k][j] - f[j]))) / len(f) AS s FROM (SELECT *, unnest(range(1, len(h) + 1)) AS k FROM w)"},
    "SELECT vec_id, round(sum(times * a) / 10, 6) AS mae, round(sum(times * s) / 10, 6) AS mse FROM d GROUP BY vec_id",
)
SQL["static_threshold"] = _with(_SCORED, "SELECT round(avg(mae) + 3 * stddev_pop(mae), 6) AS threshold, 'validation' AS basis FROM scored WHERE event_id % 5 = 0")
SQL["sigma_sweep"] = _with(
    _SCORED | {"b": "SELECT avg(mae) AS m, stddev_pop(mae) AS d FROM scored WHERE NOT attack", "t": "SELECT CAST(sigma AS DOUBLE) AS sigma, m + sigma * d AS threshold FROM b, (SELECT unnest([1.0, 2.0, 3.0]) AS sigma)"},
    "SELECT sigma, round(threshold, 6) AS threshold, round(count(*) FILTER (attack AND mae >= threshold) / count(*) FILTER (attack), 6) AS detection, round(count(*) FILTER (NOT attack AND mae >= threshold) / count(*) FILTER (NOT attack), 6) AS false_positives FROM scored, t GROUP BY sigma, threshold",
)
_ADAPT = _SCORED | {
    "q": "SELECT *, count(*) OVER w AS n, quantile_cont(mae, 0.95) OVER w AS p FROM scored WINDOW w AS (PARTITION BY log_type ORDER BY place ROWS BETWEEN 1000 PRECEDING AND 1 PRECEDING)",
    "m": "SELECT log_type, (place - 1) // 50 AS batch_id, n, (1 - least(n / 1000, 1.0)) * 0.6 + least(n / 1000, 1.0) * p AS x FROM q WHERE (place - 1) % 50 = 0",
    "t": "SELECT log_type, batch_id, least(1.0, greatest(0.001, CASE WHEN n < 100 THEN 0.6 ELSE least(1.2, greatest(0.3, x)) END)) AS threshold, n >= 100 AND least(1.2, greatest(0.3, x)) <> x AS drift_clamped FROM m",
}
SQL["adaptive_threshold"] = _with(_ADAPT, "SELECT log_type, batch_id, floor(threshold * 1e4 + 0.5) / 1e4 AS threshold, drift_clamped FROM t")
SQL["flag_anomalies"] = _with(_ADAPT, "SELECT s.log_type, count(*) AS n, count(*) FILTER (mae >= threshold) AS anomalies FROM scored s JOIN t ON s.log_type = t.log_type AND (s.place - 1) // 50 = t.batch_id GROUP BY ALL")
SQL["live_threshold"] = _with(_LATEST, "SELECT c.log_type, count(*) AS n, round(coalesce(max(anomaly_threshold), 0.5), 6) AS live_threshold FROM (SELECT 't' || (c_custkey % 7) AS log_type FROM customer) c LEFT JOIN latest USING (log_type) GROUP BY ALL")
SQL["no_model_scores"] = _with(_SCORED, "SELECT log_type, event_id % 3 = 0 AND mae > 0.5 AS is_anomaly, count(*) AS n, round(sum(CASE WHEN event_id % 3 = 0 THEN mae ELSE 0.0 END), 3) AS mae FROM scored GROUP BY ALL")
_STATUS = {"status": "SELECT event_type AS log_type, max(event_id) % 2 = 0 AS enabled, max(ts) AS last_updated FROM events WHERE event_type <> 'view' GROUP BY ALL"}
SQL["mode_route"] = _with(_STATUS, "SELECT e.event_type AS log_type, CASE WHEN coalesce(enabled, false) THEN 'store' ELSE 'score' END AS route, count(*) AS n FROM events e LEFT JOIN status s ON e.event_type = s.log_type GROUP BY ALL")

# ------------------------------------------------------------------ attacks

_ITEMS = {"items": "SELECT l_orderkey * 10 + l_linenumber AS id, l_quantity AS spkts, CAST(l_linenumber AS DOUBLE) AS dpkts, l_extendedprice AS sbytes, l_suppkey * 3.0e0 AS dbytes, l_extendedprice * 8 AS sload, l_quantity * 7 AS dload, l_discount * 10 AS dur, l_tax * 100 AS sinpkt, l_discount AS dinpkt, 64.0e0 AS sttl, l_linenumber * 9.0e0 AS dttl, l_extendedprice / l_quantity AS smean, l_quantity AS dmean, l_returnflag AS proto, l_linestatus AS service, l_returnflag || l_linestatus AS state, CASE l_returnflag WHEN 'A' THEN 'Other' WHEN 'R' THEN 'Fuzzer' ELSE 'Normal' END AS label FROM lineitem"}
SQL["clean_labels"] = _with(_ITEMS, "SELECT label, count(*) AS n FROM items GROUP BY ALL")
_MADE = {
    "spkts": "spkts", "dpkts": "dpkts", "sttl": "sttl", "dttl": "dttl", "smean": "smean", "dmean": "dmean",
    **{x: f"ln(1 + greatest({x}, 0))" for x in ("sbytes", "dbytes", "sload", "dload", "dur", "sinpkt", "dinpkt")},
    "pkt_diff": "spkts - dpkts", "byte_ratio": "sbytes / (dbytes + 1)", "load_ratio": "sload / (dload + 1)", "pkt_rate": "spkts / (dur + 0.001)", "byte_per_pkt": "sbytes / (spkts + 1)", "load_x_pkt": "sload * spkts", "dur_x_bytes": "dur * sbytes", "spkt_dpkt_ratio": "spkts / (dpkts + 1)", "sbyte_dbyte_diff": "sbytes - dbytes",
    "pkt_intensity": "(spkts + dpkts) / (dur + 0.001)", "mean_pkt_size": "(sbytes + dbytes) / (spkts + dpkts + 1)", "ttl_delta": "abs(sttl - dttl)", "ttl_ratio": "sttl / (dttl + 1)", "slow_scan": "sinpkt * ln(1 + dpkts)", "timing_ratio": "sinpkt / (dinpkt + 0.001)", "mean_pkt_asymmetry": "smean / (dmean + 1)", "total_mean_pkt": "smean + dmean",
}
SQL["engineer_features"] = _with(_ITEMS, "SELECT id, " + ", ".join(f"floor(({x}) * 1000 + 0.5) / 1000 AS {n}" for n, x in _MADE.items()) + " FROM items")
SQL["label_encode"] = _with(_ITEMS | {"k": "SELECT " + ", ".join(f"(SELECT CAST(count(DISTINCT b.{x}) AS DOUBLE) FROM items b WHERE b.{x} < a.{x}) AS {x}" for x in ("proto", "service", "state")) + ", n FROM (SELECT proto, service, state, count(*) AS n FROM items GROUP BY ALL) a"}, "SELECT * FROM k")
_MI = _ITEMS | {
    "long": " UNION ALL ".join(f"SELECT '{x}' AS feature, {x} AS x, proto AS y FROM items" for x in ("spkts", "dpkts", "dur", "sinpkt", "dttl", "dmean")),
    "r": "SELECT *, CAST(floor(32 * (rank() OVER (PARTITION BY feature ORDER BY x) - 1) / (SELECT count(*) FROM items)) AS BIGINT) AS bin FROM long",
    "n": "SELECT feature, bin, y, CAST(count(*) AS DOUBLE) AS n FROM r GROUP BY ALL",
    "p": "SELECT *, sum(n) OVER (PARTITION BY feature, bin) AS nx, sum(n) OVER (PARTITION BY feature, y) AS ny, sum(n) OVER (PARTITION BY feature) AS t FROM n",
    "mi": "SELECT feature, sum(n / t * ln(n * t / (nx * ny))) AS mi FROM p GROUP BY ALL",
    "o": "SELECT *, row_number() OVER (ORDER BY round(mi, 9) DESC, feature) AS k FROM mi",
}
SQL["mi_select"] = _with(_MI, "SELECT feature, round(mi, 6) AS mi FROM o WHERE k <= 3 OR feature = 'dmean'")
SQL["standardize"] = _with(_ITEMS, "SELECT id, " + ", ".join(f"round(({x} - avg({x}) OVER ()) / CASE WHEN stddev_pop({x}) OVER () = 0 THEN 1 ELSE stddev_pop({x}) OVER () END, 5) AS {x}" for x in ("spkts", "sbytes", "sttl")) + " FROM items")
SQL["class_weights"] = _with(_ITEMS | {"n": "SELECT label AS y, count(*) AS n FROM items GROUP BY ALL"}, "SELECT y, round(least((SELECT sum(n) FROM n) / ((SELECT count(*) FROM n) * n), 30.0), 6) AS weight FROM n")
SQL["stratified_split"] = "SELECT doc_id, CASE WHEN row_number() OVER (PARTITION BY lang ORDER BY md5(doc_id || '-42'), doc_id) <= floor(count(*) OVER (PARTITION BY lang) * 0.15) THEN 'validation' ELSE 'train' END AS split FROM (SELECT DISTINCT doc_id, lang FROM documents)"
_PR = {
    "s": "SELECT floor(value / 5) / 100 AS score, CASE WHEN value + event_id % 60 > 400 THEN 1 ELSE 0 END AS y FROM events",
    "p": "SELECT DISTINCT score, sum(y) OVER w AS tp, count(*) OVER w AS n, sum(y) OVER () AS pos FROM s WINDOW w AS (ORDER BY score DESC RANGE UNBOUNDED PRECEDING)",
    "f": "SELECT score, tp / n AS pr, tp / pos AS rc FROM p",
    "g": "SELECT *, 2 * pr * rc / (pr + rc + 1e-10) AS f1, CASE WHEN pr >= 0.5 THEN 0 WHEN pr >= 0.3 THEN 1 ELSE 2 END AS lvl FROM f",
}
SQL["pr_threshold"] = _with(_PR, "SELECT round(greatest(score, 0.1), 6) AS threshold FROM g WHERE (SELECT sum(y) FROM s) > 0 ORDER BY lvl, round(f1, 12) DESC, score LIMIT 1")
_CLASSES = ("Fuzzer", "Generic", "Other", "Shellcode", "Worms")
_PROBS = {
    "raw": "SELECT event_id, " + ", ".join(f"CAST(floor(value * 100 / {m}) AS BIGINT) % 11 + 1 AS r{i}" for i, m in enumerate((1, 7, 49, 343, 2401))) + " FROM events",
    "pr": "SELECT event_id, " + ", ".join(f"r{i} / (r0 + r1 + r2 + r3 + r4) AS p{i}" for i in range(5)) + " FROM raw",
    "am": "SELECT *, greatest(p0, p1, p2, p3, p4) AS top, CASE " + " ".join(f"WHEN p{i} = greatest(p0, p1, p2, p3, p4) THEN '{n}'" for i, n in enumerate(_CLASSES)) + " END AS arg FROM pr",
    "wm": "SELECT *, p4 >= 0.2 AND p4 >= 0.7 * top AS worm FROM am",
    "dec": "SELECT *, CASE WHEN p3 >= 0.25 AND p3 >= 0.65 * CASE WHEN worm THEN p4 ELSE top END THEN 'Shellcode' WHEN worm THEN 'Worms' ELSE arg END AS label FROM wm",
}
SQL["override_decision"] = _with(_PROBS, "SELECT event_id, label FROM dec")
_CONF = "CASE label " + " ".join(f"WHEN '{n}' THEN p{i}" for i, n in enumerate(_CLASSES)) + " END"
SQL["confidence"] = _with(_PROBS, f"SELECT event_id, round({_CONF}, 6) AS confidence, round(1 - {_CONF}, 6) AS anomaly_score FROM dec")
SQL["features42_to_row"] = _with(
    _F42,
    "SELECT seq, floor(100 * (ln(1 + greatest(duration, 0.001))) + 0.5) / 100 AS dur, floor(100 * (CAST(orig_pkts AS DOUBLE)) + 0.5) / 100 AS spkts, floor(100 * (ln(1 + CAST(orig_bytes AS DOUBLE))) + 0.5) / 100 AS sbytes, floor(100 * (CAST(orig_pkts - resp_pkts AS DOUBLE)) + 0.5) / 100 AS pkt_diff, floor(100 * (orig_bytes / (resp_bytes + 1.0)) + 0.5) / 100 AS byte_ratio, floor(1000 * ln(1 + orig_pkts / (greatest(duration, 0.001) + 0.001)) + 0.5) / 1000 AS pkt_rate, floor(100 * (CASE WHEN orig_pkts > 0 THEN orig_bytes / orig_pkts ELSE 0.0 END + CASE WHEN resp_pkts > 0 THEN resp_bytes / resp_pkts ELSE 0.0 END) + 0.5) / 100 AS total_mean_pkt, floor(100 * (CAST(ct_srv_src AS DOUBLE)) + 0.5) / 100 AS ct_srv_src, floor(100 * (CAST(" + flag("service = 'ftp'") + " AS DOUBLE)) + 0.5) / 100 AS is_ftp_login FROM g",
)
SQL["evaluate"] = _with(
    _PROBS
    | {
        "e": f"SELECT n AS class, count(*) FILTER (arg = n) AS support, count(*) FILTER (label = n) AS given, count(*) FILTER (arg = n AND label = n) AS tp FROM dec, (SELECT unnest({list(_CLASSES)}) AS n) GROUP BY n",
        "s": "SELECT class, support, CASE WHEN given > 0 THEN tp / given ELSE 0.0 END AS precision, CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall FROM e WHERE support > 0 OR given > 0",
        "f": "SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM s",
        "u": "SELECT class, precision, recall, f1, support FROM f UNION ALL SELECT 'macro', avg(precision), avg(recall), avg(f1), sum(support) FROM f UNION ALL SELECT 'weighted', sum(precision * support) / sum(support), sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support) FROM f",
    },
    "SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM u",
)
SQL["classify_stream"] = _with(FLOWS, "SELECT orig_h, CASE WHEN orig_pkts - resp_pkts > 25 THEN 'Generic' ELSE 'Fuzzer' END AS label, count(*) AS n FROM flows WHERE orig_h NOT IN ('10.0.0.0', '10.0.0.1') AND (orig_pkts - resp_pkts > 25 OR floor(orig_pkts / (greatest(duration, 0.001) + 0.001) * 1e6 + 0.5) / 1e6 > 4) GROUP BY ALL")

# ------------------------------------------------------------------ registry

SQL["set_learning"] = """WITH c AS (SELECT event_type AS log_type, arg_max(event_id % 2 = 0, ts) AS enabled, max(ts) AS last_updated FROM events WHERE event_id % 3 = 0 GROUP BY ALL),
s AS (SELECT event_type AS log_type, max(event_id) % 2 = 0 AS enabled, max(ts) AS last_updated FROM events WHERE event_type <> 'view' GROUP BY ALL)
SELECT * FROM c UNION ALL SELECT * FROM s WHERE log_type NOT IN (SELECT log_type FROM c)"""
SQL["get_learning"] = _with(_STATUS, "SELECT e.log_type, coalesce(enabled, false) AS enabled FROM (SELECT DISTINCT event_type AS log_type FROM events) e LEFT JOIN status USING (log_type)")
SQL["add_total_rows"] = "SELECT event_type AS log_type, count(*) + count(*) FILTER (value > 300) AS count FROM events GROUP BY ALL"
SQL["clear_type"] = "SELECT event_type AS log_type, count(*) AS n FROM events WHERE event_type <> 'click' GROUP BY ALL"
SQL["set_threshold"] = _with(_MODELS, "SELECT log_type, round(sum(CASE WHEN log_type = 't2' THEN 0.25 ELSE anomaly_threshold END), 3) AS s FROM models GROUP BY ALL")
SQL["buffer_status"] = """WITH c AS (SELECT event_type AS log_type, arg_max(event_id, ts) AS buffer_size, max(ts) AS last_updated FROM events WHERE event_id % 7 = 1 GROUP BY ALL)
SELECT * FROM c UNION ALL SELECT event_type, event_id, ts FROM events WHERE event_id = 0 AND event_type NOT IN (SELECT log_type FROM c)"""
SQL["training_ready"] = "SELECT event_type AS log_type, count(*) AS rows, count(*) >= 10 AS ready, count(*) >= 2500 AS auto_train, least(100, count(*) * 100 // 2500) AS progress FROM events GROUP BY ALL"
_GRADE = "CASE WHEN fpr < 0.05 THEN 'excellent' WHEN fpr < 0.1 THEN 'good' WHEN fpr < 0.2 THEN 'warning' ELSE 'poor' END"
SQL["fpr_grade"] = _with(_MODELS, f"SELECT {_GRADE} AS grade, count(*) AS n FROM models GROUP BY ALL")
SQL["metrics_report"] = _with(_LATEST, f"SELECT log_type, model_path, round(anomaly_threshold, 6) AS anomaly_threshold, {_GRADE} AS grade FROM latest")

# ------------------------------------------------------------------ monitoring

_TICKS = {"ticks": "SELECT event_type AS topic, date_trunc('hour', ts) AS tick, count(*) AS ingested, count(*) FILTER (value < 400) AS stored, count(*) FILTER (value >= 400 AND value < 430) AS buffered FROM events GROUP BY ALL"}
SQL["throughput"] = _with(_TICKS, "SELECT topic, epoch_us(tick) // 1000000 AS tick, ingested, stored, coalesce(ingested - lag(ingested) OVER w, 0) AS ingested_change, coalesce(stored - lag(stored) OVER w, 0) AS stored_change, round(coalesce((ingested - lag(ingested) OVER w) / ((epoch_us(tick) - lag(epoch_us(tick)) OVER w) / 1e6), 0), 6) AS ingested_per_s FROM ticks WINDOW w AS (PARTITION BY topic ORDER BY tick)")
_TOTALS = _TICKS | {
    "t": "SELECT tick, CAST(sum(ingested) AS BIGINT) AS ingested, CAST(sum(stored) AS BIGINT) AS stored, CAST(sum(buffered) AS BIGINT) AS buffered FROM ticks GROUP BY ALL",
    "u": "SELECT epoch_us(tick) // 1000000 AS tick, ingested, stored, buffered, CASE WHEN ingested > 0 THEN stored * 100 // ingested ELSE 0 END AS efficiency, ingested - stored - buffered AS lag, coalesce(ingested - lag(ingested) OVER w, 0) - coalesce(stored - lag(stored) OVER w, 0) AS backlog FROM t WINDOW w AS (ORDER BY tick)",
}
SQL["lag_efficiency"] = _with(_TOTALS, "SELECT tick, efficiency, lag, backlog FROM u")
SQL["load_levels"] = _with(_TOTALS, "SELECT tick, CASE WHEN lag * 10 > 100 THEN 'red' WHEN lag * 10 > 10 THEN 'amber' ELSE 'green' END AS lag_level, CASE WHEN buffered * 20 > 400 THEN 'red' WHEN buffered * 20 > 200 THEN 'amber' ELSE 'green' END AS buffer_level, CASE WHEN ingested > 50 THEN 'green' WHEN ingested > 10 THEN 'amber' ELSE 'red' END AS rate_level FROM u")
SQL["monitor_log_parse"] = _with(_TICKS, """SELECT NULL AS container, count(*) AS n, round(CAST(sum(ingested) AS DOUBLE), 6) AS ingest, round(CAST(sum(stored) AS DOUBLE), 6) AS processing, round(CAST(sum(buffered) AS DOUBLE), 6) AS lag, round(CAST(sum(stored * 2) AS DOUBLE), 6) AS efficiency, CAST(NULL AS DOUBLE) AS cpu, CAST(NULL AS DOUBLE) AS mem FROM ticks
UNION ALL SELECT topic, count(*), NULL, NULL, NULL, NULL, round(CAST(sum(ingested * 3.5) AS DOUBLE), 6), round(CAST(sum(stored) AS DOUBLE), 6) FROM ticks GROUP BY topic""")
SQL["bottleneck_report"] = _with(_TICKS | {"r": "SELECT CAST(trunc(avg(ingested)) AS BIGINT) AS avg_ingest, max(ingested) AS max_ingest, CAST(trunc(avg(stored)) AS BIGINT) AS avg_processing, max(stored) AS max_processing, CAST(trunc(avg(buffered)) AS BIGINT) AS avg_lag, max(buffered) AS max_lag, CAST(trunc(avg(stored * 2)) AS BIGINT) AS avg_efficiency FROM ticks"}, "SELECT *, avg_ingest - avg_processing AS gap, avg_ingest - avg_processing > 1000 AS bottleneck FROM r")
SQL["container_load"] = _with(_TICKS, "SELECT topic AS container, round(avg(ingested * 3.5), 6) AS avg_cpu, CAST(max(ingested * 3.5) AS DOUBLE) AS peak_cpu, CASE WHEN avg(ingested * 3.5) > 80 THEN 'bottleneck' WHEN avg(ingested * 3.5) > 50 THEN 'high' ELSE 'normal' END AS level FROM ticks GROUP BY ALL")

# ------------------------------------------------------------------ written and read back

_RAW = FLOWS | {"raw": "SELECT *, seq % 10 = 9 AS broken FROM flows"}
SQL["read_logs"] = _with(_RAW, "SELECT uid, orig_h, orig_p, round(duration, 6) AS duration FROM raw WHERE NOT broken AND log_type = 'click'")
SQL["replay"] = _with(FLOWS, """SELECT log_type, CASE WHEN log_type IN ('view', 'error') THEN true ELSE max(seq) % 2 = 0 END AS enabled,
  CASE WHEN log_type IN ('view', 'error') THEN count(*) ELSE 0 END AS records FROM flows GROUP BY log_type""")
SQL["malicious_sink"] = _with(FLOWS, "SELECT 'malicious-' || log_type AS topic, log_type, seq, uid, orig_bytes FROM flows WHERE orig_bytes > 30000")
SQL["export_topics"] = _with(FLOWS, """SELECT topic, value FROM (SELECT topic, value, row_number() OVER (PARTITION BY topic ORDER BY seq) AS n FROM
  (SELECT arg_min(log_type, seq) AS topic, min(seq) AS seq, value FROM (SELECT log_type, seq, concat_ws('|', conn_state, resp_p, seq % 40) AS value FROM flows) GROUP BY value)) WHERE n <= 25""")
SQL["decode_packed"] = """SELECT vec_id, CASE WHEN vec_id % 7 <> 0 THEN len(embedding) ELSE -1 END AS width, CASE WHEN vec_id % 7 <> 0 THEN round(CAST(embedding[1] AS DOUBLE), 6) END AS first,
  CASE WHEN vec_id % 7 <> 0 THEN round(CAST(embedding[64] AS DOUBLE), 6) END AS last FROM embeddings"""
SQL["feature_store_append"] = """SELECT CASE WHEN vec_id % 3 = 1 THEN 'dns' ELSE 'conn' END AS log_type, count(*) AS rows, round(sum(CAST(embedding[1] AS DOUBLE)), 4) AS first,
  round(sum(CAST(embedding[33] AS DOUBLE)), 4) AS last FROM embeddings WHERE vec_id % 7 <> 0 GROUP BY 1"""
SQL["read_labelled"] = "SELECT CASE WHEN doc_id % 3 = 0 THEN 'test' ELSE 'train' END AS split, CAST(doc_id AS BIGINT) AS doc_id, CAST(quality AS BIGINT) AS quality, CAST(toxic AS BIGINT) AS toxic FROM labels"
SQL["write_predictions"] = _with(_PROBS, "SELECT label AS predicted_attack_type, count(*) AS rows, count(*) AS read_back FROM dec GROUP BY ALL")
SQL["save_model_row"] = _with(_MODELS, """SELECT log_type, count(*) + 1 AS n, arg_max(model_path, struct_pack(a := created_at, b := model_path)) || '-new' AS newest,
  round(sum(anomaly_threshold) + 2 * arg_max(anomaly_threshold, struct_pack(a := created_at, b := model_path)), 3) AS s, count(*) AS with_loss FROM models GROUP BY log_type""")
SQL["trusted_reload"] = _with(FLOWS, """SELECT orig_h, seq % 2 AS part, count(*) AS n FROM flows WHERE NOT (seq % 2 = 0 AND orig_h = '10.0.0.1') AND NOT (seq % 2 = 1 AND orig_h = '10.0.0.3') GROUP BY ALL""")

# ------------------------------------------------------------------ streams give what tables give

SQL["stateful_vector33"] = SQL["vector33"]
SQL["stateful_session"] = SQL["session_assemble"]
SQL["classify_stream_with_models"] = "SELECT 0 AS differ, 0 AS out_of_range, 0 AS lacking"

# ------------------------------------------------------------------ properties of models

_LABELS = "SELECT l_orderkey * 10 + l_linenumber AS id, CASE WHEN l_returnflag = 'A' THEN 'Other' WHEN l_returnflag = 'R' THEN 'Fuzzer' ELSE 'Normal' END AS label FROM lineitem"
_HELD_OUT = f"SELECT label, CAST(floor(count(*) * 0.15) AS BIGINT) AS rows FROM ({_LABELS}) GROUP BY label"
SQL["attack_model_quality"] = f"SELECT CAST(sum(rows) AS BIGINT) AS rows, true AS better_than_majority, true AS every_class FROM ({_HELD_OUT})"
SQL["predict_attack_saved"] = f"""WITH a AS (SELECT l_orderkey * 10 + l_linenumber AS id, l_returnflag AS proto, l_linestatus AS service, l_returnflag || l_linestatus AS state FROM lineitem)
SELECT id, {", ".join(f"dense_rank() OVER (ORDER BY {x}) - 1 AS {x}" for x in ("proto", "service", "state"))}, 3 AS classes, 1.0 AS whole, true AS same FROM a"""
SQL["predict_attack"] = f"SELECT id, 3 AS classes, 1.0 AS whole, true AS fine FROM ({_LABELS})"
SQL["shellcode_model_quality"] = f"SELECT CAST(sum(rows) AS BIGINT) AS rows, CAST(sum(rows) FILTER (label = 'Other') AS BIGINT) AS positives, true AS better_than_majority, true AS apart FROM ({_HELD_OUT})"
SQL["quantile_ranks"] = f"""WITH q AS (SELECT unnest(range(100)) AS i, unnest(quantile_cont(l_extendedprice, {[i / 99 for i in range(100)]})) AS v FROM lineitem),
x AS (SELECT DISTINCT l_extendedprice AS x FROM lineitem),
b AS (SELECT x, max(i) FILTER (v <= x) AS j, min(i) FILTER (v >= x) AS k, max(v) FILTER (v <= x) AS low, min(v) FILTER (v >= x) AS high FROM x, q GROUP BY x)
SELECT x AS sbytes, round(CASE WHEN low = high THEN (j + k) / 2 ELSE j + (x - low) / (high - low) END / 99, 5) AS rank FROM b"""
SQL["quantile_fit"] = f"SELECT unnest(range(100)) AS i, round(unnest(quantile_cont(l_extendedprice, {[i / 99 for i in range(100)]})), 4) AS value FROM lineitem"
_W = """WITH v AS (SELECT row_number() OVER (ORDER BY vec_id) AS n, list_transform(embedding[1:8], lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
w AS (SELECT a.n, list_concat(list_concat(a.e, b.e), c.e) AS x FROM v a JOIN v b ON b.n = a.n + 1 JOIN v c ON c.n = a.n + 2), u AS (SELECT n, unnest(x) AS x, generate_subscripts(x, 1) AS i FROM w)"""
SQL["reconstruct"] = f"{_W} SELECT (SELECT count(*) FROM w) AS windows, round(sum(s) / 24, 6) AS by_mean, true AS closer, true AS whole_with_all FROM (SELECT i, var_pop(x) AS s FROM u GROUP BY i)"
SQL["train_job"] = _with(_MODELS, """SELECT 'conn' AS log_type, 1 AS models, 'conn-new' AS newest, true AS fine, 2 * count(*) AS count, 0 AS "left", 'validation' AS basis FROM embeddings WHERE label < 5
  UNION ALL SELECT 'dns', (SELECT count(*) FROM models WHERE log_type = 't1'), NULL, true, count(*), count(*), 'validation' FROM embeddings WHERE label >= 5""")

# ------------------------------------------------------------------ streams by the clock

SQL["score_batches_stream"] = SQL["score_batches"]
SQL["adaptive_threshold_stream"] = SQL["adaptive_threshold"]
SQL["session_join_stream"] = SQL["session_join"]
SQL["learning_batches_stream"] = _with(_SCORED | {"n": "SELECT *, count(*) OVER (PARTITION BY log_type) AS all_rows FROM scored"}, "SELECT log_type, (place - 1) // 500 AS batch_id, count(*) AS n, min(event_id) AS first, max(all_rows) > 500 AS failed_once, 0 AS dropped FROM n GROUP BY ALL")
SQL["dedup_stream"] = "SELECT md5(text) AS digest, 1 AS n FROM documents GROUP BY text"
SQL["seeded_vector33"] = _with(_NUMBERED, f"SELECT seq, {_columns(_V33, places=4)} FROM i WHERE us > (SELECT (min(us) + max(us)) // 2 FROM flows)")
SQL["trusted_clock"] = _with(FLOWS, "SELECT orig_h, seq % 3 AS part, count(*) AS n FROM flows WHERE CASE WHEN seq % 3 < 2 THEN orig_h <> '10.0.0.1' ELSE orig_h NOT IN ('10.0.0.0', '10.0.0.3') END GROUP BY ALL")
SQL["mode_route_stream"] = _with(_STATUS, "SELECT log_type, route, part, count(*) AS n, count(*) FILTER (route = 'score' AND value / 500 > 0.9) AS hot FROM (SELECT e.event_type AS log_type, e.event_id % 2 AS part, e.value, CASE WHEN coalesce(CASE WHEN e.event_id % 2 = 0 THEN enabled ELSE NOT enabled END, false) THEN 'store' ELSE 'score' END AS route FROM events e LEFT JOIN status s ON e.event_type = s.log_type) GROUP BY ALL")
SQL["train_job_reloaded"] = _with(_VECS, "SELECT vec_id AS id, true AS same_score, true AS same_verdict, true AS same_limit FROM vecs WHERE log_type = 'conn' AND place >= 10")
_GIVEN = FLOWS | {
    "raw": "SELECT seq, (seq % 13) / 13 AS shell, " + ", ".join(f"CAST(floor(seq * 37 / {m}) AS BIGINT) % 11 + 1 AS r{i}" for i, m in enumerate((1, 7, 49, 343, 2401))) + " FROM flows WHERE orig_h NOT IN ('10.0.0.0', '10.0.0.1')",
    "pr": _PROBS["pr"].replace("event_id", "seq, shell"),
    "am": _PROBS["am"],
    "wm": _PROBS["wm"],
    "dec": _PROBS["dec"].replace("p3 >=", "shell >="),
}
SQL["classify_stream_overrides"] = _with(_GIVEN, f"SELECT seq, label, floor((1 - {_CONF}) * 1e6 + 0.5) / 1e6 AS anomaly_score FROM dec")

# ------------------------------------------------------------------ the flagship

_KEPT = _NUMBERED | {"flows": f"SELECT * FROM ({FLOWS_SQL}) WHERE orig_h NOT IN ('10.0.0.0', '10.0.0.1')"}
_KEPT = _KEPT | {
    "v": f"SELECT seq, src, us, [{', '.join(f'CAST({x} AS DOUBLE)' for x in _V33)}] AS f FROM i",
    "e33": "SELECT seq, src, us, unnest(f) AS x, generate_subscripts(f, 1) AS k FROM v",
    "mm": "SELECT k, min(x) AS low, max(x) - min(x) AS r FROM e33 GROUP BY k",
    "z33": "SELECT seq, src, us, k, greatest(0.0, least(1.0, (x - low) / (r + 1e-8))) AS z FROM e33 JOIN mm USING (k)",
    "m33": "SELECT k, avg(z) AS mean FROM z33 GROUP BY k",
    "d33": "SELECT seq, src, us, sum(abs(z - mean)) / 33 AS a FROM z33 JOIN m33 USING (k) GROUP BY seq, src, us",
    "n33": "SELECT *, row_number() OVER (PARTITION BY src ORDER BY us, seq) - 1 AS p FROM d33",
    "b33": "SELECT *, p // 50 AS batch FROM n33",
    "w33": """SELECT seq, src, (sum(a) OVER q + (10 - count(*) OVER q) * first_value(a) OVER q) / 10 AS mae FROM b33
              WINDOW q AS (PARTITION BY src, batch ORDER BY p ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)""",
    "t33": "SELECT avg(mae) + 2 * stddev_pop(mae) AS at_least FROM w33",
}
SQL["anomalous_flows"] = _with(_KEPT, "SELECT seq, src, round(mae, 6) AS mae FROM w33, t33 WHERE mae >= at_least")
