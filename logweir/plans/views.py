"""Log-shaped views over the given tables: what the network-log operators read in the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

FLOWS = """
SELECT event_id AS seq, concat('C', cast(event_id AS {STR})) AS uid, {US} AS us, {US} / 1000000.0E0 AS ts,
  concat('10.0.0.', cast(user_id % 4 AS {STR})) AS orig_h, cast(40000 + event_id % 20000 AS INT) AS orig_p,
  concat('192.168.', cast(user_id % 3 AS {STR}), '.', cast(K.k % 256 AS {STR})) AS resp_h,
  CASE K.k % 6 WHEN 0 THEN 80 WHEN 1 THEN 443 WHEN 2 THEN 53 WHEN 3 THEN 22 WHEN 4 THEN 8080 ELSE 10000 + K.k END AS resp_p,
  CASE event_type WHEN 'view' THEN 'tcp' WHEN 'click' THEN 'udp' WHEN 'error' THEN 'icmp' ELSE 'tcp' END AS proto,
  CASE event_type WHEN 'view' THEN 'http' WHEN 'click' THEN 'dns' WHEN 'purchase' THEN 'ssl' WHEN 'signup' THEN 'ftp' ELSE '' END AS service,
  CASE event_type WHEN 'error' THEN 'REJ' WHEN 'signup' THEN 'S0' ELSE 'SF' END AS conn_state,
  CASE event_type WHEN 'error' THEN 'Sr' WHEN 'signup' THEN 'S' WHEN 'click' THEN 'Dd' ELSE 'ShADadFf' END AS history,
  CASE WHEN K.k % 10 = 0 THEN 0.0E0 ELSE value / 10.0E0 END AS duration,
  cast(floor(value * 100) AS BIGINT) AS orig_bytes, cast(floor(value * 37) AS BIGINT) AS resp_bytes,
  cast(K.k % 50 AS BIGINT) AS orig_pkts, cast(event_id % 40 AS BIGINT) AS resp_pkts,
  event_id % 2 = 0 AS local_orig, cast(event_id % 3 AS INT) AS missed_bytes, event_type AS log_type
FROM (SELECT *, cast({JK} AS INT) AS k FROM {EVENTS}) K
"""

#: url parts of pages as dns, http and ssl records; everything else is a function of page_id.
PAGES = """
SELECT page_id AS seq, concat('P', cast(page_id AS {STR})) AS uid, 1700000000.5E0 + page_id * 97 AS ts,
  concat('172.16.', cast(page_id % 7 AS {STR}), '.', cast(page_id % 251 AS {STR})) AS orig_h, cast(1024 + page_id % 60000 AS INT) AS orig_p,
  concat('8.8.', cast(page_id % 5 AS {STR}), '.', cast(page_id % 300 AS {STR})) AS resp_h, cast(CASE WHEN page_id % 2 = 0 THEN 443 ELSE 80 END AS INT) AS resp_p,
  regexp_extract(url, '://([^/?#]*)', 1) AS host, regexp_extract(url, '://[^/?#]*(.*)$', 1) AS uri,
  cast(page_id % 1000 AS INT) AS n, url
FROM {PAGES}
"""


def _fill(sql: str, spark_side: bool) -> str:
    if spark_side:
        return sql.format(STR="STRING", US="unix_micros(cast(ts AS TIMESTAMP))", JK="get_json_object(props,'$.k')", EVENTS="{events}", PAGES="{pages}")
    return sql.format(STR="VARCHAR", US="epoch_us(ts)", JK="json_extract_string(props,'$.k')", EVENTS="events", PAGES="pages")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Connection records made from events."""
    return spark.sql(_fill(FLOWS, True), events=table(spark, sf_dir, "events"))


def web(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hosts and paths of pages, with addresses and ports."""
    return spark.sql(_fill(PAGES, True), pages=table(spark, sf_dir, "pages"))


FLOWS_SQL = _fill(FLOWS, False)
WEB_SQL = _fill(PAGES, False)
