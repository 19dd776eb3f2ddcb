"""Stateful processors: per-key state, timers and expiry on streams.

Each keeps a few values per key. Rows of a micro-batch are taken in order of time (or arrival), so the
result does not depend on how a batch was read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

LONG = T.StructType([T.StructField("v", T.LongType())])
TEXT = T.StructType([T.StructField("v", T.StringType())])
PENDING = T.StructType([T.StructField(n, T.ArrayType(T.LongType())) for n in ("begins", "ends")])


def _joined(batches: Iterator[pd.DataFrame], order: str) -> pd.DataFrame:
    """A key's rows of one micro-batch in order.

    The trigger's limits must keep them few enough for a task; ``jobs.look_back_batches`` has no such
    need where a bounded look back will do.
    """
    return pd.concat(list(batches)).sort_values(order, kind="stable")


class PeriodicTotals(StatefulProcessor):
    """A key's row count, reported ``period_ms`` after the row that asks for it; never reset."""

    def __init__(self, key: str, millis: str, period_ms: int) -> None:
        self.key, self.millis, self.period = key, millis, period_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.count = handle.getValueState("count", LONG)
        self.pending = handle.getValueState("pending", LONG)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        # Rows of a time are counted as they are read; only distinct times are held.
        counts = pd.concat([batch.groupby(self.millis).size() for batch in rows])
        counts = counts.groupby(level=0).sum().sort_index()
        at, upto = counts.index.to_numpy(), np.concatenate(([0], np.cumsum(counts.to_numpy())))
        seen = self.count.get()[0] if self.count.exists() else 0
        due = self.pending.get()[0] if self.pending.exists() else None
        reports, low = [], 0
        while low < len(at):
            if due is None:
                due = int(at[low]) + self.period
            high = low + int(np.searchsorted(at[low:], due, side="right"))
            seen += int(upto[high] - upto[low])
            low = high
            if low < len(at):
                reports.append((key[0], due, seen))
                due = None
        self.count.update((seen,))
        previous = self.pending.get()[0] if self.pending.exists() else None
        if due != previous:
            if previous is not None:
                self.handle.deleteTimer(previous)
            self.pending.update((due,))
            self.handle.registerTimer(due)
        yield pd.DataFrame(reports, columns=[self.key, "fire_at", "total"])

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        due = expiredTimerInfo.getExpiryTimeInMs()
        self.pending.clear()
        yield pd.DataFrame([(key[0], due, self.count.get()[0])], columns=[self.key, "fire_at", "total"])

    def close(self) -> None:
        pass


class EventTimers(StatefulProcessor):
    """A timer ``delay_ms`` after each row; equal timers of a key fire once."""

    def __init__(self, key: str, millis: str, delay_ms: int) -> None:
        self.key, self.millis, self.delay = key, millis, delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        out = []
        for batch in rows:
            for at in batch[self.millis]:
                self.handle.registerTimer(int(at) + self.delay)
                out.append((key[0], "row", int(at)))
        yield pd.DataFrame(out, columns=[self.key, "kind", "at"])

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        due = expiredTimerInfo.getExpiryTimeInMs()
        yield pd.DataFrame([(key[0], "timer", due)], columns=[self.key, "kind", "at"])

    def close(self) -> None:
        pass


class WindowCounts(StatefulProcessor):
    """Tumbling counts kept in a map from window start; a window is freed when its timer fires."""

    def __init__(self, key: str, millis: str, size_ms: int) -> None:
        self.key, self.millis, self.size = key, millis, size_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getMapState("counts", LONG, LONG)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        for batch in rows:
            starts = batch[self.millis] // self.size * self.size
            for start, more in starts.value_counts().items():
                at = (int(start),)
                known = self.counts.getValue(at)[0] if self.counts.containsKey(at) else 0
                self.counts.updateValue(at, (known + int(more),))
                self.handle.registerTimer(int(start) + self.size - 1)
        yield pd.DataFrame([], columns=[self.key, "window_start", "cnt"])

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        start = expiredTimerInfo.getExpiryTimeInMs() + 1 - self.size
        count = self.counts.getValue((start,))[0]
        self.counts.removeKey((start,))
        yield pd.DataFrame([(key[0], start, count)], columns=[self.key, "window_start", "cnt"])

    def close(self) -> None:
        pass


class ExpiringCount(StatefulProcessor):
    """A key's row count that is forgotten ``ttl_ms`` (processing time) after its last update."""

    def __init__(self, key: str, ttl_ms: int) -> None:
        self.key, self.ttl = key, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", LONG, self.ttl)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        seen = self.count.get()[0] if self.count.exists() else 0
        seen += sum(len(batch) for batch in rows)
        self.count.update((seen,))
        yield pd.DataFrame([(key[0], seen)], columns=[self.key, "cnt"])

    def close(self) -> None:
        pass


class TableMachine(StatefulProcessor):
    """A machine driven by a table (state, input) -> (next state, whether to alert), in arrival order.

    An input without an entry sets the machine back to ``start``.
    """

    def __init__(
        self, key: str, arrival: str, symbol: str, start: str, table: dict[tuple[str, str], tuple[str, bool]]
    ) -> None:
        self.key, self.arrival, self.symbol = key, arrival, symbol
        self.start, self.table = start, table

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("state", TEXT)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        current = self.state.get()[0] if self.state.exists() else self.start
        alerts = []
        batch = _joined(rows, self.arrival)
        for at, symbol in zip(batch[self.arrival], batch[self.symbol]):
            current, alert = self.table.get((current, symbol), (self.start, False))
            if alert:
                alerts.append((key[0], int(at)))
        self.state.update((current,))
        yield pd.DataFrame(alerts, columns=[self.key, self.arrival])

    def close(self) -> None:
        pass


class PreviousValue(StatefulProcessor):
    """Each row's value with the one before it of the same key, in arrival order.

    Join the pairs with a rule table to detect two-step sequences on a stream.
    """

    def __init__(self, key: str, arrival: str, value: str) -> None:
        self.key, self.arrival, self.value = key, arrival, value

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", TEXT)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        batch = _joined(rows, self.arrival)
        values = batch[self.value].tolist()
        before = [self.last.get()[0] if self.last.exists() else None, *values[:-1]]
        self.last.update((values[-1],))
        pairs = pd.DataFrame({self.arrival: batch[self.arrival].to_numpy(), "action1": before, "action2": values})
        pairs.insert(0, self.key, key[0])
        yield pairs.dropna(subset=["action1"])

    def close(self) -> None:
        pass


class FollowedBy(StatefulProcessor):
    """Each ``begin`` row with the key's next ``end`` row, if that comes less than ``within_ms`` later.

    Rows wait until the watermark reaches them, so they are matched in event-time order even if they
    came out of order; rows of one time stand in the order of ``arrival``. A begin row whose time runs out is
    reported as a timeout, before the rows of that time are looked at.
    """

    def __init__(self, key: str, millis: str, arrival: str, kind: str, begin: str, end: str, within_ms: int) -> None:
        self.key, self.millis, self.arrival, self.kind = key, millis, arrival, kind
        self.begin, self.end, self.within = begin, end, within_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        #: Of each time not reached yet: arrivals of begin rows, and of end rows.
        self.pending = handle.getMapState("pending", LONG, PENDING)
        self.waiting = handle.getMapState("waiting", LONG, LONG)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        for batch in rows:
            known = batch[batch[self.kind].isin([self.begin, self.end])]
            for at, same in known.groupby(self.millis):
                begins, ends = self._pending((int(at),))
                begins += same.loc[same[self.kind] == self.begin, self.arrival].tolist()
                ends += same.loc[same[self.kind] == self.end, self.arrival].tolist()
                self.pending.updateValue((int(at),), (begins, ends))
                self.handle.registerTimer(int(at))
        yield self._out(key, [])

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        out = []
        if self.waiting.containsKey((now - self.within,)):
            out += [(now - self.within, None, "timeout")] * self.waiting.getValue((now - self.within,))[0]
            self.waiting.removeKey((now - self.within,))
        begins, ends = self._pending((now,))
        if begins or ends:
            self.pending.removeKey((now,))
        if ends:
            # Begin rows of this very time are ended by a later arrival of the same time only.
            for at, number in sorted((k[0], v[0]) for k, v in self.waiting.iterator()):
                out += [(at, now, "matched")] * number
                self.waiting.removeKey((at,))
        ended = sum(arrival < max(ends) for arrival in begins) if ends else 0
        out += [(now, now, "matched")] * ended
        if len(begins) > ended:
            self.waiting.updateValue((now,), (len(begins) - ended,))
            self.handle.registerTimer(now + self.within)
        yield self._out(key, out)

    def _pending(self, at: tuple[int]) -> tuple[list[int], list[int]]:
        if not self.pending.containsKey(at):
            return [], []
        begins, ends = self.pending.getValue(at)
        return list(begins), list(ends)

    def _out(self, key: Any, found: list[tuple]) -> pd.DataFrame:
        frame = pd.DataFrame(found, columns=["begin_ms", "end_ms", "status"])
        frame["end_ms"] = frame["end_ms"].astype("Int64")
        frame.insert(0, self.key, key[0])
        return frame

    def close(self) -> None:
        pass


# Three failures in a row alert, and so does every further one; a success starts over.
FAILURE_TABLE = {
    ("initial", "fail"): ("s1", False),
    ("s1", "fail"): ("s2", False),
    ("s2", "fail"): ("s2", True),
}


def with_state(
    stream: DataFrame,
    key: str,
    processor: StatefulProcessor,
    schema: str,
    time_mode: str = "None",
    mode: str = "append",
) -> DataFrame:
    """Run a processor per key. The session must use the RocksDB state store."""
    return stream.groupBy(key).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=schema, outputMode=mode, timeMode=time_mode
    )
