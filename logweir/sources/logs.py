"""Reading and writing log records: topics, files, the feature store, labelled sets."""

from __future__ import annotations

import json
import uuid

import numpy as np
import pandas as pd
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import frames
from ..operators import registry
from ..operators.filters import unwrapped

# The fields of the four record types.
_COMMON = "ts STRING, uid STRING, `id.orig_h` STRING, `id.orig_p` INT, `id.resp_h` STRING, `id.resp_p` INT, "
SCHEMAS = {
    "conn": _COMMON + "proto STRING, service STRING, duration DOUBLE, orig_bytes BIGINT, resp_bytes BIGINT, conn_state STRING, local_orig BOOLEAN, local_resp BOOLEAN, missed_bytes INT, history STRING, orig_pkts BIGINT, orig_ip_bytes BIGINT, resp_pkts BIGINT, resp_ip_bytes BIGINT, tunnel_parents ARRAY<STRING>",
    "dns": _COMMON + "proto STRING, trans_id INT, rtt DOUBLE, query STRING, qclass INT, qclass_name STRING, qtype INT, qtype_name STRING, rcode INT, rcode_name STRING, AA BOOLEAN, TC BOOLEAN, RD BOOLEAN, RA BOOLEAN, Z INT, answers ARRAY<STRING>, TTLs ARRAY<DOUBLE>, rejected BOOLEAN",
    "http": _COMMON + "trans_depth INT, method STRING, host STRING, uri STRING, referrer STRING, version STRING, user_agent STRING, request_body_len BIGINT, response_body_len BIGINT, status_code INT, status_msg STRING, info_code INT, info_msg STRING, filename STRING, tags ARRAY<STRING>, username STRING, password STRING, proxied ARRAY<STRING>, orig_fuids ARRAY<STRING>, orig_filenames ARRAY<STRING>, orig_mime_types ARRAY<STRING>, resp_fuids ARRAY<STRING>, resp_filenames ARRAY<STRING>, resp_mime_types ARRAY<STRING>",
    "ssl": _COMMON + "version STRING, cipher STRING, curve STRING, server_name STRING, resumed BOOLEAN, established BOOLEAN, cert_chain_fuids ARRAY<STRING>, subject STRING, issuer STRING, session_id STRING, last_alert STRING, client_cert_chain_fuids ARRAY<STRING>, client_subject STRING, client_issuer STRING, validation_status STRING",
}


def topic_of(log_type: str) -> str:
    return f"zeek-{log_type.strip()}"


def kafka_options(servers: str, topics: list[str], starting: str = "earliest") -> dict[str, str]:
    """Options of Spark's kafka source. Names are trimmed."""
    return {"kafka.bootstrap.servers": servers.strip(), "subscribe": ",".join(t.strip() for t in topics), "startingOffsets": starting}


def read_logs(spark: SparkSession, log_type: str, servers: str | None = None, folder: str | None = None, stream: bool = True) -> DataFrame:
    """One topic from its beginning, as a column `value` of text; from kafka, or from text files in a folder of the topic's name."""
    return read_topics(spark, [log_type], servers, folder, stream).select("value")


def read_topics(spark: SparkSession, log_types: list[str], servers: str | None = None, folder: str | None = None, stream: bool = True) -> DataFrame:
    """Several topics as one stream (or table): topic, value."""
    topics = [topic_of(t) for t in log_types]
    reader = spark.readStream if stream else spark.read
    if servers:
        return reader.format("kafka").options(**kafka_options(servers, topics)).load().select("topic", F.col("value").cast("string").alias("value"))
    out = None
    for t in topics:
        one = reader.text(f"{folder}/{t}").select(F.lit(t).alias("topic"), "value")
        out = one if out is None else out.unionByName(one)
    return out


def replay(spark: SparkSession, log_types: list[str], status: DataFrame, servers: str | None = None, folder: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(records, status): the topics of the types from their beginning once more, and the learning status with learning on
    for them, so that what is read again is stored."""
    on = spark.createDataFrame([(t.strip(), True) for t in log_types], "log_type string, enabled boolean").withColumn("last_updated", F.current_timestamp())
    return read_topics(spark, log_types, servers, folder, stream=False), registry.set_learning(status, on)


def decode_json(records: DataFrame, column: str = "value") -> DataFrame:
    """Rows whose value is a JSON object; see bad_records() for the others."""
    return records.filter(F.json_object_keys(F.col(column)).isNotNull())


def bad_records(records: DataFrame, column: str = "value") -> DataFrame:
    return records.filter(F.json_object_keys(F.col(column)).isNull())


def typed(value: Column, log_type: str) -> Column:
    """The record as a struct of its type's fields; unknown fields are ignored, an envelope is taken off. Null for a value that isn't of the type."""
    return F.from_json(unwrapped(value), SCHEMAS[log_type], {"mode": "PERMISSIVE"})


def typed_logs(records: DataFrame, log_type: str, column: str = "value") -> DataFrame:
    """The fields as columns, dotted names as orig_h, orig_p, resp_h, resp_p. A record with a field that can't be coerced drops.
    Records come out of a generator, so that each is parsed once and not anew in the filter."""
    schema = f"{SCHEMAS[log_type]}, __bad STRING"
    held = records.select(F.explode(F.array(F.from_json(unwrapped(F.col(column)), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__bad"}))).alias("r")).filter("r is not null and r.__bad is null")
    names = held.select("r.*").drop("__bad").columns
    return held.select(*[F.col(f"r.`{n}`").alias(n.removeprefix("id.") if n.startswith("id.") else n) for n in names])


def write_malicious(records: DataFrame, folder: str, log_type_col: str = "log_type") -> None:
    """Appends records by type; a stream does the same in foreachBatch, with a folder for each batch (see streaming)."""
    records.withColumn("topic", F.concat(F.lit("malicious-"), F.col(log_type_col))).write.mode("append").partitionBy("topic").parquet(folder)


def supervised_message(uid: Column, conn: Column, n_dns: Column, n_http: Column, n_ssl: Column) -> Column:
    """The text [uid, conn as JSON text, counts] that goes out for an attack."""
    quoted = lambda c: F.regexp_extract(F.to_json(F.array(c)), r"^\[(.*)\]$", 1)
    return F.concat(F.lit("["), quoted(uid), F.lit(","), quoted(conn), F.lit(","), F.concat_ws(",", n_dns.cast("string"), n_http.cast("string"), n_ssl.cast("string")), F.lit("]"))


def topic_counts(records: DataFrame, topic: str = "topic") -> DataFrame:
    return records.groupBy(topic).agg(F.count(F.lit(1)).alias("records"))


def dedup_keep_first(records: DataFrame, value: str = "value", order: str = "offset") -> DataFrame:
    """The first row of each value by order (a least number for each value, so copies shrink before they are shuffled)."""
    rest = [c for c in records.columns if c != value]
    least = records.groupBy(value).agg(F.min_by(F.struct(*rest), F.col(order)).alias("r"))
    return least.select(*[F.col(value) if c == value else F.col(f"r.{c}").alias(c) for c in records.columns])


def export_topics(records: DataFrame, folder: str, most: int | None = None, dedup: bool = False, order: str = "offset") -> None:
    """Writes each topic's values as text lines in a folder of its name, in order; at most `most` of each."""
    rows = dedup_keep_first(records.select("topic", "value", order)) if dedup else records
    if most is not None:
        rows = frames.numbered(rows.select("topic", "value", order), ["topic"], [order], "__n").filter(F.col("__n") <= most)
    frames.by_range(rows, [F.col("topic"), F.col(order)]).sortWithinPartitions("topic", order).select("topic", "value").write.mode("overwrite").partitionBy("topic").text(folder)


class BatchFiles:
    """A store for streaming.timed.collected: each batch is a file of JSON lines named by key and number, with both in each
    line. A file is written under a draft name first, so that a batch is there whole or not at all, and replaced by a
    repetition. fails_first: a batch number whose first attempt for each key raises, to see what is done about it."""

    def __init__(self, folder: str, key_col: str = "log_type", fails_first: int | None = None):
        self.folder, self.key_col, self.fails_first = folder, key_col, fails_first

    def __call__(self, key: tuple, number: int, rows: list[str]) -> None:
        system, root = pafs.FileSystem.from_uri(self.folder)
        system.create_dir(root, recursive=True)
        name = f"{root}/{'-'.join(map(str, key))}-{number}.json"
        if number == self.fails_first:
            tried = name.rpartition("/")[0] + "/_tried-" + name.rpartition("/")[2]
            if system.get_file_info(tried).type == pafs.FileType.NotFound:
                system.open_output_stream(tried).close()
                raise OSError("the store is away")
        head = json.dumps({self.key_col: key[0], "number": number})[:-1]
        draft = f"{root}/_draft-{uuid.uuid4().hex}"
        with system.open_output_stream(draft) as out:
            out.write("".join(f"{head}, {r[1:]}\n" if r != "{}" else f"{head}}}\n" for r in rows).encode())
        system.move(draft, name)


def feature_rows(features: DataFrame, log_type: str, width: int = 33, column: str = "features") -> DataFrame:
    """log_type, features for the vectors of the right width."""
    return features.filter(F.size(column) == width).select(F.lit(log_type).alias("log_type"), F.col(column).alias("features"))


def append_features(features: DataFrame, folder: str, log_type: str, width: int = 33, ids: str = "id") -> None:
    """Appends vectors of the right width to the store, by type; others go."""
    features.filter(F.size("features") == width).withColumn("log_type", F.lit(log_type)).select(ids, "features", "timestamp", "log_type").write.mode("append").partitionBy("log_type").parquet(folder)


def load_features(store: DataFrame, log_type: str, width: int = 33) -> DataFrame:
    """One type's rows of the right width in order of id. The filter on log_type prunes folders."""
    return store.filter((F.col("log_type") == log_type) & (F.size("features") == width)).orderBy("id")


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def decode_packed(packed: pd.Series) -> pd.Series:
    """Packed little-endian doubles as an array; null for null and for bytes that aren't a multiple of eight."""
    return packed.map(lambda b: None if b is None or len(b) % 8 else np.frombuffer(b, "<f8"))


def read_labelled(spark: SparkSession, train: str, test: str, schema: str | None = None) -> DataFrame:
    """Two CSV files with a header as one table with a column `split`."""
    def read(path):
        reader = spark.read.option("header", True)
        return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)

    return read(train).withColumn("split", F.lit("train")).unionByName(read(test).withColumn("split", F.lit("test")), allowMissingColumns=True)


def write_predictions(rows: DataFrame, folder: str, label: str = "predicted_attack_type") -> DataFrame:
    """Writes rows as CSV; the count of each class."""
    rows.write.mode("overwrite").option("header", True).csv(folder)
    return rows.groupBy(label).agg(F.count(F.lit(1)).alias("rows"))


def load_ip_list(spark: SparkSession, path: str | None) -> DataFrame:
    """ip: one a line, trimmed, without blank lines and # comments. No path, or none there: an empty list."""
    if path is None:
        return spark.createDataFrame([], "ip string")
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], "ip string")
    return ip_lines(spark.read.text(path))


def ip_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    return lines.select(F.trim(column).alias("ip")).filter("ip <> '' and ip not like '#%'").distinct()


