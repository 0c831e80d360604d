"""Small tables that streams read anew by the clock, routing by a switch, joins and duplicates bounded by watermarks."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import anomaly, sessions
from ..sources.scratch import stored
from . import stateful

#: Seconds after which a list's file is looked at again, and after which a threshold is read again.
LIST_SECONDS, THRESHOLD_SECONDS = 10, 300


def file_time(spark: SparkSession, path: str) -> int | None:
    """When a file, or the newest file of a folder, was last written, in milliseconds; None where there is none."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(at):
        return None
    parts = [*system.listStatus(at), system.getFileStatus(at)]
    return max(p.getModificationTime() for p in parts)


class Reloaded:
    """A small table for micro-batches: calling it gives the copy at hand, read again once `seconds` have passed since it was
    last looked at and, where `version` is given, only if that has changed since. A read that fails keeps the copy at hand;
    without one it raises. Copies are stored in the session's shared folder, so that a micro-batch sees one state whatever
    happens to the file."""

    def __init__(self, read: Callable[[], DataFrame], seconds: float, version: Callable[[], object] | None = None, clock: Callable[[], float] = time.monotonic):
        self.read, self.seconds, self.version, self.clock = read, seconds, version, clock
        self.held, self.looked, self.seen, self.reads = None, None, None, 0

    def __call__(self) -> DataFrame:
        now = self.clock()
        if self.held is not None and now - self.looked < self.seconds:
            return self.held
        self.looked = now
        seen = self.version() if self.version else None
        if self.held is not None and self.version and seen == self.seen:
            return self.held
        try:
            self.held, self.seen = stored(self.read(), "reloaded"), seen
            self.reads += 1
        except Exception:
            if self.held is None:
                raise
        return self.held


def reloaded_list(spark: SparkSession, path: str, read: Callable[[], DataFrame], clock: Callable[[], float] = time.monotonic) -> Reloaded:
    """A list of addresses that is looked at every ten seconds and read again if its file has changed."""
    return Reloaded(read, LIST_SECONDS, lambda: file_time(spark, path), clock)


def reloaded_threshold(read: Callable[[], DataFrame], clock: Callable[[], float] = time.monotonic) -> Reloaded:
    """The latest models (log_type, anomaly_threshold), read again every five minutes."""
    return Reloaded(read, THRESHOLD_SECONDS, None, clock)


def routed_stream(records: DataFrame, status: Callable[[], DataFrame], score: Callable[[DataFrame], DataFrame], stored_in: str, scored_in: str, checkpoint: str, once: bool = True):
    """Starts a query that sends each micro-batch where the switch of its log type points (anomaly.mode_route): rows to be
    learned from go to one folder as they are, the others through `score` to another. `status` is called for each batch.

    Both writes go to folders of the batch's number and replace what an attempt left there, so a batch that runs again loses
    and doubles nothing; if the switch was turned between two attempts, the last one counts for both folders."""

    def write(batch: DataFrame, number: int) -> None:
        routed = stored(anomaly.mode_route(batch, status()), "routed")  # both sinks see one route for each row
        routed.filter("route = 'store'").drop("route").write.mode("overwrite").parquet(f"{stored_in}/batch={number}")
        score(routed.filter("route = 'score'").drop("route")).write.mode("overwrite").parquet(f"{scored_in}/batch={number}")

    return stateful._start(records, write, checkpoint, once)


def session_join_stream(malicious: DataFrame, raw: DataFrame, seconds: int = 3600, late: str = "60 seconds", column: str = "time") -> DataFrame:
    """sessions.session_join for streams: records may come `late` out of order; state of either side ends once the watermark
    has passed the time by which a partner could still come."""
    return sessions.session_join(malicious.withWatermark(column, late), raw.withWatermark(column, late), seconds, column)


def dedup_stream(lines: DataFrame, columns: list[str], within: str = "1 hour", column: str = "time") -> DataFrame:
    """Rows of a stream whose columns are new: the first to come of equal ones within `within` by the time column, whose
    watermark ends the state. Which of equal rows of one micro-batch comes first is open."""
    return lines.withWatermark(column, within).dropDuplicatesWithinWatermark(columns)
