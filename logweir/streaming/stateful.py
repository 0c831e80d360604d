"""Long-running streams: features with state for each source, sessions with state for each uid, sinks by batch."""

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions import frames
from ..operators import attack, filters, vector33
from ..operators.vector33 import FLOWS_PER_EPOCH, GAPS

HOUR_US = 3_600_000_000
#: What a record needs beside its history for the 33 features.
CARRIED = {
    "ts": "string", "orig_h": "string", "resp_h": "string", "orig_p": "long", "resp_p": "long", "duration": "double", "rtt": "double", "orig_pkts": "long",
    "resp_pkts": "long", "orig_bytes": "long", "resp_bytes": "long", "history": "string", "ssl_history": "string",
}
HISTORY = {"flow_count": "long", "distinct_ports": "long", "iat_mean": "double", "iat_std": "double"}
HISTORY_SCHEMA = ", ".join(f"{k} {v}" for k, v in {"seq": "long", "src": "string", "us": "long", **CARRIED, **HISTORY}.items())
#: Rows whose windows of gaps are laid out at a time.
ROWS = 4096


def last_gaps(gaps: np.ndarray, before: np.ndarray, upto: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and population deviation of the last GAPS gaps for each row: of before and the first upto[i] of gaps."""
    line = np.concatenate([np.full(GAPS, np.nan), before, gaps])
    ends = GAPS + len(before) + upto
    mean, std = np.zeros(len(upto)), np.zeros(len(upto))
    for i in range(0, len(upto), ROWS):
        held = np.lib.stride_tricks.sliding_window_view(line, GAPS)[ends[i : i + ROWS] - GAPS]
        some = ~np.isnan(held[:, -1])  # the last of the window is there if any is
        mean[i : i + ROWS][some], std[i : i + ROWS][some] = np.nanmean(held[some], axis=1), np.nanstd(held[some], axis=1)
    return mean, std


class SourceHistory(StatefulProcessor):
    """Per source: flows and distinct ports of the epoch, the last time, the last 100 valid gaps. State is bounded by the epoch;
    with a time to live it ends for sources that have been quiet so long. A micro-batch's rows are worked on in arrays, an
    epoch's part at a time."""

    def __init__(self, ttl_ms: int | None = None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        ttl = {"ttlDurationMs": self.ttl_ms} if self.ttl_ms else {}
        self.flows = handle.getValueState("flows", "n long, last_us long", **ttl)
        self.ports = handle.getMapState("ports", "port long", "n long", **ttl)
        self.gaps = handle.getListState("gaps", "us long", **ttl)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        """Takes up what source_state() found for a source in a table of history."""
        (held,) = initialState.itertuples(index=False)
        self.flows.update((int(held.n), int(held.last_us)))
        self.gaps.put([(int(g),) for g in held.gaps])
        for port in held.ports:
            self.ports.updateValue((int(port),), (1,))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        (src,) = key
        held = pd.concat(list(rows)).sort_values(["us", "seq"], kind="stable")
        n, last = self.flows.get() if self.flows.exists() else (0, 0)
        gaps = np.array([g for (g,) in self.gaps.get()], float)
        ports = {k for ((k,), _) in self.ports.iterator()}
        at = 0
        while at < len(held):
            if n == FLOWS_PER_EPOCH:
                n, last, gaps, ports = 0, 0, gaps[:0], set()
                self.ports.clear()
            part = held.iloc[at : at + FLOWS_PER_EPOCH - n]
            us = part["us"].to_numpy(np.int64)
            before = np.concatenate(([last], us[:-1]))
            gap = us - before
            valid = (before > 0) & (gap > 0) & (gap < HOUR_US)
            mean, std = last_gaps(gap[valid].astype(float), gaps, np.cumsum(valid))
            seen = part["resp_p"].to_numpy()
            fresh = ~pd.Series(seen).duplicated().to_numpy() & ~np.isin(seen, list(ports))
            named = (part["orig_h"].fillna("") != "").to_numpy()
            out = part.assign(src=src, flow_count=n + 1 + np.arange(len(part)), distinct_ports=len(ports) + np.cumsum(fresh), iat_mean=np.where(named, mean, 0) / 1e6, iat_std=np.where(named, std, 0) / 1e6)
            for port in seen[fresh].tolist():
                ports.add(port)
                self.ports.updateValue((int(port),), (1,))
            n, last, at = n + len(part), int(us[-1]), at + len(part)
            gaps = np.concatenate([gaps, gap[valid]])[-GAPS:]
            yield out[["seq", "src", "us", *CARRIED, *HISTORY]]
        self.flows.update((n, last))
        self.gaps.put([(int(g),) for g in gaps])

    def close(self) -> None:
        pass


def source_state(records: DataFrame) -> DataFrame:
    """src, n, last_us, ports, gaps: what SourceHistory would hold of each source after these records, from a table. Only a
    source's last epoch counts, so no list is longer than an epoch; sources are numbered by range, a hot one in many tasks."""
    held = vector33.interaction(vector33.completed(records).withColumn("resp_p", F.coalesce(F.col("resp_p").cast("long"), F.lit(-1))))
    last = held.groupBy("src").agg(F.max("epoch").alias("epoch"))
    rows = held.join(last, ["src", "epoch"]).select("src", "us", "seq", "resp_p")
    gap = frames.valid_gap(F.col("us"), F.lag("us").over(Window.partitionBy("src").orderBy("us", "seq")))
    rows = rows.withColumn("gap", gap)
    valid = F.collect_list(F.when(F.col("gap").isNotNull(), F.struct("us", "seq", "gap")))
    found = rows.groupBy("src").agg(F.count(F.lit(1)).alias("n"), F.max("us").alias("last_us"), F.collect_set("resp_p").alias("ports"), F.sort_array(valid).alias("gaps"))
    return found.withColumn("gaps", F.transform(F.slice("gaps", F.greatest(F.lit(1), F.size("gaps") - GAPS + 1), F.lit(GAPS)), lambda g: g["gap"]))


def stateful_history(records: DataFrame, ttl_seconds: int | None = None, history: DataFrame | None = None) -> DataFrame:
    """Records of a stream of connections with the history columns of vector33. Within a micro-batch a source's rows go in
    order of (us, seq); across batches, in order of arrival. On a table in that order it gives what the windows of vector33
    give. A missing port counts as port -1. ttl_seconds: a source's state ends so long after its last record; by default it
    stays. history: a table of earlier records (or of source_state()), which the stream goes on from; it is read once, when a
    query starts with a new checkpoint. A source's rows of one micro-batch are held by one task, so bound micro-batches where
    the stream is read (maxFilesPerTrigger, maxOffsetsPerTrigger)."""
    held = vector33.completed(records).withColumn("src", filters.source_key(F.col("orig_h")))
    there = {c: F.col(c) if c in held.columns else F.lit(None) for c in CARRIED}  # what a log type lacks is null
    there["resp_p"] = F.coalesce(there["resp_p"], F.lit(-1))
    keyed = held.select("src", "seq", "us", *[there[c].cast(kind).alias(c) for c, kind in CARRIED.items()])
    processor = SourceHistory(ttl_seconds * 1000 if ttl_seconds else None)
    seed = None
    if history is not None:
        seed = (history if {"n", "last_us", "ports", "gaps"} <= set(history.columns) else source_state(history)).groupBy("src")
    return keyed.groupBy("src").transformWithStateInPandas(processor, HISTORY_SCHEMA, "Append", "ProcessingTime" if ttl_seconds else "None", seed)


def stateful_vector33(records: DataFrame, ttl_seconds: int | None = None, history: DataFrame | None = None) -> DataFrame:
    """seq, src, us and features: the 33 values for each record of a stream, with the history of its source (see stateful_history)."""
    return stateful_history(records, ttl_seconds, history).select("seq", "src", "us", vector33.features().alias("features"))


class SessionState(StatefulProcessor):
    """Per uid: the last conn record and how many dns, http and ssl records there were; a malicious record gives a row once there is a conn."""

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("session", "conn string, dns long, http long, ssl long", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        (uid,) = key
        held = pd.concat(list(rows)).sort_values(["arrival", "trigger", "record"], kind="stable")
        conn, *n = self.state.get() if self.state.exists() else (None, 0, 0, 0)
        count = dict(zip(("dns", "http", "ssl"), n, strict=True))
        out = []
        for arrival, log_type, record, trigger in held[["arrival", "log_type", "record", "trigger"]].itertuples(index=False):
            if log_type == "conn":
                conn = record
            elif log_type in count:
                count[log_type] += 1
            if trigger and conn is not None:
                out.append((uid, int(arrival), conn, count["dns"], count["http"], count["ssl"]))
        self.state.update((conn, count["dns"], count["http"], count["ssl"]))
        yield pd.DataFrame(out, columns=["uid", "arrival", "conn", "n_dns", "n_http", "n_ssl"])

    def close(self) -> None:
        pass


def stateful_session(tagged: DataFrame, ttl_seconds: int = 3600) -> DataFrame:
    """Sessions over one stream of (uid, arrival, log_type, record, trigger); state ends ttl_seconds after its last change."""
    return tagged.groupBy("uid").transformWithStateInPandas(SessionState(ttl_seconds * 1000), "uid string, arrival long, conn string, n_dns long, n_http long, n_ssl long", "Append", "ProcessingTime")


#: State in columns, lists and timers needs this store.
STATE_STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


def _start(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, once: bool, every: str | None = None):
    """Starts the query; with once it ends when what is there is read. Batches without data would then never end for state
    that has a time to live, so there are none. every: the time between micro-batches otherwise. The session's settings
    stay as they were: a query takes those of the moment it starts."""
    conf, wanted = stream.sparkSession.conf, dict(STATE_STORE)
    if once:
        wanted["spark.sql.streaming.noDataMicroBatches.enabled"] = "false"
    before = {key: conf.get(key) for key in wanted}
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    try:
        for key, value in wanted.items():
            conf.set(key, value)
        return writer.start()
    finally:
        for key, value in before.items():
            conf.set(key, value)


def write_batches(stream: DataFrame, folder: str, checkpoint: str, partition: str | None = None, once: bool = True, every: str | None = None):
    """Starts a query that writes each micro-batch to a folder of its number, over what an earlier attempt left there."""

    def write(batch: DataFrame, number: int) -> None:
        writer = batch.write.mode("overwrite")
        (writer.partitionBy(partition) if partition else writer).parquet(f"{folder}/batch={number}")

    return _start(stream, write, checkpoint, once, every)


def score_stream(records: DataFrame, trusted: Callable[[], DataFrame], score: Callable[[DataFrame], DataFrame], folder: str, checkpoint: str, once: bool = True):
    """Starts a query that drops trusted sources, scores each micro-batch and keeps what `score` returns. `trusted` is
    called for each batch, so a changed list counts from the next one."""

    def write(batch: DataFrame, number: int) -> None:
        score(filters.drop_trusted(batch, trusted())).write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return _start(records, write, checkpoint, once)


def classified_stream(records: DataFrame, trusted: Callable[[], DataFrame], scorer: Callable[[DataFrame], DataFrame], encode: Callable[[DataFrame], DataFrame], folder: str, checkpoint: str, once: bool = True):
    """Starts a query that encodes each micro-batch, labels it with `scorer` (attack.attack_scorer) and keeps the attacks. Trusted
    sources are normal; the list is read anew for each batch."""

    def write(batch: DataFrame, number: int) -> None:
        found = attack.classify(encode(batch), scorer, trusted())
        filters.attack_only(found, "label").write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return _start(records, write, checkpoint, once)
