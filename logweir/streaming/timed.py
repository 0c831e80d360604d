"""Streams with timers: batches that fill or time out, adaptive thresholds over the last scores, collection that survives a failing store."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import DoubleType, LongType, StructType

from ..operators.anomaly import BASE_DEFAULT, HIGH, HISTORY, LEAST, LOW
from ..operators.batches import BATCH

#: After the first of a batch's rows it waits so long for more; collected rows wait longer.
WAIT_MS, COLLECT_MS = 200, 5_000
_TIME = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def _carried(rows: DataFrame, keys: list[str], order: list[str], *more: str) -> DataFrame:
    """rows as keys, order columns and a payload of everything else as text, so that state keeps nulls and kinds as they are."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.select(*keys, *more, *[F.col(c).alias(f"order_{i}") for i, c in enumerate(order)], F.to_json(F.struct(*rest), _TIME).alias("payload"))


def _restored(rows: DataFrame, like: DataFrame, keys: list[str], *made: str) -> DataFrame:
    rest = StructType([f for f in like.schema.fields if f.name not in keys])
    return rows.withColumn("payload", F.from_json("payload", rest, _TIME)).select(*keys, "payload.*", *made)


def _in_order(rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
    held = pd.concat(list(rows))
    return held.sort_values([c for c in held.columns if c.startswith("order_")], kind="stable")


def _key_fields(rows: DataFrame, keys: list[str]) -> StructType:
    return StructType([rows.schema[k] for k in keys])


class Batcher(StatefulProcessor):
    """Per key: rows that wait, at most size - 1; how many batches and rows went before; when the timer is due (0: none)."""

    def __init__(self, keys: list[str], size: int, wait_ms: int):
        self.keys, self.size, self.wait_ms = keys, size, wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "payload string")
        self.counts = handle.getValueState("counts", "batches long, rows long, due long")

    def _frame(self, key, batch: int, before: int, payloads: list[str]) -> pd.DataFrame:
        slots = np.arange(len(payloads))
        return pd.DataFrame({**dict(zip(self.keys, key, strict=True)), "payload": payloads, "place": before + 1 + slots, "batch_id": batch, "slot": slots})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        batches, before, due = self.counts.get() if self.counts.exists() else (0, 0, 0)
        old = [p for (p,) in self.waiting.get()]
        line = [*old, *_in_order(rows)["payload"].tolist()]
        whole = len(line) - len(line) % self.size
        for i in range(0, whole, self.size):
            yield self._frame(key, batches, before, line[i : i + self.size])
            batches, before = batches + 1, before + self.size
        rest = line[whole:]
        if due and (whole or not rest):
            self.handle.deleteTimer(due)
            due = 0
        if rest and not due:
            due = timer_values.getCurrentProcessingTimeInMs() + self.wait_ms
            self.handle.registerTimer(due)
        self._keep(rest)
        self.counts.update((batches, before, due))

    def _keep(self, rest: list[str]) -> None:
        if rest:
            self.waiting.put([(p,) for p in rest])
        else:
            self.waiting.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        batches, before, _ = self.counts.get()
        rest = [p for (p,) in self.waiting.get()]
        self._keep([])
        self.counts.update((batches + bool(rest), before + len(rest), 0))
        if rest:
            yield self._frame(key, batches, before, rest)

    def close(self) -> None:
        pass


def batches_by_time(rows: DataFrame, keys: list[str], order: list[str], size: int = BATCH, wait_ms: int = WAIT_MS) -> DataFrame:
    """A stream's rows with place, batch_id and slot, as score_batches gives them for a table, once their batch is full or
    wait_ms after its first row came, whichever is sooner.

    Rows of one micro-batch go in order of `order` (no nulls), after those that wait. A batch that timed out is short and the
    next one starts anew. Keys are a task each: where one log type is most of a stream, let a shard (a hash of the source) be
    one of the keys. Null keys are keys. Timers fire with micro-batches, also those without rows, so let the query run with a
    trigger of about wait_ms rather than once."""
    carried = _carried(rows, keys, order)
    made = StructType([*_key_fields(rows, keys).fields]).add("payload", "string").add("place", LongType()).add("batch_id", LongType()).add("slot", LongType())
    found = carried.groupBy(*keys).transformWithStateInPandas(Batcher(keys, size, wait_ms), made, "Append", "ProcessingTime")
    return _restored(found, rows, keys, "place", "batch_id", "slot")


class LastScores:
    """The last `most` scores in order of arrival and in order of size: a score comes and goes by bisection, and a quantile is
    read off. Missing scores (NaN) take a place but have no size."""

    def __init__(self, line: np.ndarray | list[float], most: int = HISTORY):
        self.line, self.most = deque(line, most), most
        self.sizes = sorted(x for x in self.line if x == x)

    def add(self, score: float) -> None:
        if len(self.line) == self.most:
            old = self.line[0]
            if old == old:
                del self.sizes[bisect_left(self.sizes, old)]
        self.line.append(score)
        if score == score:
            insort(self.sizes, score)

    def quantile(self, share: float) -> float:
        place = (len(self.sizes) - 1) * share
        low = self.sizes[int(place)]
        return low + (self.sizes[min(int(place) + 1, len(self.sizes) - 1)] - low) * (place - int(place))


def bounded_threshold(seen: LastScores, baseline: float | None) -> tuple[float, bool]:
    """The threshold after these scores, and whether drift was held back: the 95th percentile, mixed with the baseline by how
    full the history is, within half and twice the baseline; the baseline (or 0.1) while there are fewer than 100."""
    n = len(seen.sizes)
    bound = lambda x: min(HIGH, max(LOW, x))
    if n < LEAST:
        return (BASE_DEFAULT if baseline is None else bound(baseline)), False
    if baseline is None:
        return bound(seen.quantile(0.95)), False
    share = min(n / seen.most, 1.0)
    mixed = (1 - share) * baseline + share * seen.quantile(0.95)
    held = min(baseline * 2, max(baseline / 2, mixed)) if baseline > 0 else mixed
    return bound(held), held != mixed


class Thresholds(StatefulProcessor):
    """Per key: the last scores as packed numbers (8 bytes each, so bounded), and the batch that is open with its threshold."""

    def __init__(self, keys: list[str], baseline: float | None, history: int):
        self.keys, self.baseline, self.history = keys, baseline, history

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("thresholds", "scores binary, batch long, threshold double, clamped boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        packed, batch, threshold, clamped = self.state.get() if self.state.exists() else (b"", None, 0.0, False)
        seen = LastScores(np.frombuffer(packed, "<f8").tolist(), self.history)
        held = _in_order(rows)
        limits, held_back = [], []
        for at, score in zip(held["batch"].tolist(), held["score"].tolist(), strict=True):
            if at != batch:
                batch, (threshold, clamped) = at, bounded_threshold(seen, self.baseline)
            limits.append(threshold)
            held_back.append(clamped)
            seen.add(float("nan") if score is None else score)
        self.state.update((np.array(seen.line, "<f8").tobytes(), int(batch), float(threshold), bool(clamped)))
        yield held.assign(threshold=limits, drift_clamped=held_back)[[*self.keys, "payload", "threshold", "drift_clamped"]]

    def close(self) -> None:
        pass


def adaptive_stream(scores: DataFrame, baseline: float | None, keys: list[str], score: str = "mae", place: str = "place", batch: str = "batch_id", history: int = HISTORY) -> DataFrame:
    """A stream's scored rows with threshold, drift_clamped and is_anomaly: each batch's threshold from the up to `history`
    scores of its key before it, as adaptive_threshold gives it for a table. Rows of a key come in order of place, batches
    one after another; a batch may be spread over micro-batches. Null scores take a place and are no anomaly. State is
    `history` scores for each key."""
    carried = _carried(scores.withColumns({"__batch": F.col(batch), "__score": F.col(score)}), keys, [place], F.col("__batch").cast("long").alias("batch"), F.col("__score").cast("double").alias("score"))
    made = StructType([*_key_fields(scores, keys).fields]).add("payload", "string").add("threshold", DoubleType()).add("drift_clamped", "boolean")
    found = carried.groupBy(*keys).transformWithStateInPandas(Thresholds(keys, baseline, history), made, "Append", "None")
    return _restored(found, scores, keys, "threshold", "drift_clamped").withColumn("is_anomaly", F.coalesce(F.col(score) >= F.col("threshold"), F.lit(False)))


class Collector(StatefulProcessor):
    """Per key: rows that wait to be stored, at most keep * size; how many batches are stored; when the timer is due."""

    def __init__(self, keys: list[str], store: Callable[[tuple, int, list[str]], None], size: int, keep: int, wait_ms: int):
        self.keys, self.store, self.size, self.keep, self.wait_ms = keys, store, size, keep, wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "payload string")
        self.counts = handle.getValueState("counts", "stored long, due long")

    def _flushed(self, key, number: int, line: list[str], whole: bool) -> tuple[int, list[str], list[tuple]]:
        """Stores full batches, and what is left too if `whole`, until one fails; what happened. Of what then waits the newest stay."""
        told = []
        while len(line) >= self.size or (whole and line):
            part = line[: self.size]
            try:
                self.store(key, number, part)
            except Exception as e:  # whatever the store's failure is, the rows are worth keeping
                told.append((number, len(part), False, type(e).__name__, max(0, len(line) - self.keep * self.size)))
                line = line[-self.keep * self.size :]
                break
            told.append((number, len(part), True, None, 0))
            number, line = number + 1, line[len(part) :]
        return number, line, told

    def _settled(self, key, timer_values, number: int, line: list[str], due: int, told: list[tuple]) -> Iterator[pd.DataFrame]:
        if due and not line:
            self.handle.deleteTimer(due)
            due = 0
        if line and not due:
            due = timer_values.getCurrentProcessingTimeInMs() + self.wait_ms
            self.handle.registerTimer(due)
        if line:
            self.waiting.put([(p,) for p in line])
        else:
            self.waiting.clear()
        self.counts.update((number, due))
        if told:
            yield pd.DataFrame([(*key, *t, len(line)) for t in told], columns=[*self.keys, "number", "rows", "stored", "failure", "dropped", "waiting"])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        number, due = self.counts.get() if self.counts.exists() else (0, 0)
        held = _in_order(rows)
        line, on = [p for (p,) in self.waiting.get()], held["on"].to_numpy(bool)
        line += held["payload"][on].tolist()
        number, line, told = self._flushed(key, number, line, not on[-1])
        yield from self._settled(key, timer_values, number, line, due, told)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        number, _ = self.counts.get()
        number, line, told = self._flushed(key, number, [p for (p,) in self.waiting.get()], True)
        yield from self._settled(key, timerValues, number, line, 0, told)

    def close(self) -> None:
        pass


def collected(rows: DataFrame, keys: list[str], order: list[str], store: Callable[[tuple, int, list[str]], None], learning: str | None = None, size: int = 10_000, keep: int = 3, wait_ms: int = COLLECT_MS) -> DataFrame:
    """A stream's rows stored in batches of `size`: keys, number, rows, stored, failure, dropped, waiting for each attempt.

    `store` is called on an executor with the key, the number of the batch and its rows as JSON text. A task that runs again
    repeats the number, so a store must replace what it has under it. What is left wait_ms after the first row is stored as
    it is. If the store raises, rows stay in state, the newest keep * size of them, and are tried again with the next rows or
    when a timer comes due. learning: a column that is true while rows are collected; other rows aren't, and when a
    micro-batch ends with one, all that waits is stored."""
    on = F.coalesce(F.col(learning), F.lit(False)) if learning else F.lit(True)
    carried = _carried(rows, keys, order, on.alias("on"))
    made = StructType([*_key_fields(rows, keys).fields]).add("number", LongType()).add("rows", LongType()).add("stored", "boolean").add("failure", "string").add("dropped", LongType()).add("waiting", LongType())
    return carried.groupBy(*keys).transformWithStateInPandas(Collector(keys, store, size, keep, wait_ms), made, "Append", "ProcessingTime")
