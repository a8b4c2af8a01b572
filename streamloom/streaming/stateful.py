"""Keyed state and timers on a stream."""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from streamloom.shipping import ship_by_value

ship_by_value(__name__)

TIMER_OUT = "user string, at bigint, kind string, wm bigint"
COUNT_OUT = "key string, fire bigint, rows bigint, total bigint"


class _Timers(StatefulProcessor):
    def __init__(self, after_ms: int):
        self.after_ms = after_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        at = int(expiredTimerInfo.getExpiryTimeInMs())
        return iter([Row(user=key[0], at=at, kind="timer", wm=int(timerValues.getCurrentWatermarkInMs()))])

    def close(self) -> None:
        pass


class EventTimers(_Timers):
    """Per arrival: report it and set a timer ``after_ms`` later in event time.

    A user's due times are kept in lists of ``BLOCK``, and only the first of them is a timer of the store: when it expires, all that are due fire
    with it. Timers of one user for the same time are one.
    """

    BLOCK = 4096

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.due = handle.getListState("due", "times array<bigint>")
        self.first = handle.getValueState("first", "at bigint")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        wm = int(timerValues.getCurrentWatermarkInMs())
        times = array("q")
        for row in rows:
            at = int(row["timestamp"])
            times.append(at + self.after_ms)
            yield Row(user=key[0], at=at, kind="arrival", wm=wm)
        if times:
            first = int(self.first.get()[0]) if self.first.exists() else None
            self.due.appendList(self._blocks(times))
            if first is None or min(times) < first:
                if first is not None:
                    self.handle.deleteTimer(first)
                self._set(min(times))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        wm, expired = int(timerValues.getCurrentWatermarkInMs()), int(expiredTimerInfo.getExpiryTimeInMs())
        times = array("q")
        for (block,) in self.due.get():
            times.extend(block)
        later = array("q")
        last = None
        for at in sorted(times):
            if at > wm and at > expired:
                later.append(at)
            elif at != last:
                last = at
                yield Row(user=key[0], at=at, kind="timer", wm=wm)
        if later:
            self.due.put(self._blocks(later))
            self._set(later[0])
        else:
            self.due.clear()
            self.first.clear()

    def _set(self, at: int) -> None:
        self.first.update((at,))
        self.handle.registerTimer(at)

    def _blocks(self, times: array) -> list[tuple[list[int]]]:
        return [(times[i:i + self.BLOCK].tolist(),) for i in range(0, len(times), self.BLOCK)]


class ClockTimers(_Timers):
    """Per arrival: report it and set a timer ``after_ms`` later by the clock."""

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        now = int(timerValues.getCurrentProcessingTimeInMs())
        for _ in rows:
            yield Row(user=key[0], at=now, kind="arrival", wm=-1)
        self.handle.registerTimer(now + self.after_ms)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        at = int(expiredTimerInfo.getExpiryTimeInMs())
        return iter([Row(user=key[0], at=at, kind="timer", wm=-1)])


def timer_event(clicks: DataFrame, after_ms: int, delay: str) -> DataFrame:
    """Arrivals and event-time timers per user."""
    return (
        clicks.select("user", "timestamp", "ts").withWatermark("ts", delay).groupBy("user")
        .transformWithState(EventTimers(after_ms), TIMER_OUT, outputMode="Append", timeMode="EventTime")
    )


def timer_processing(clicks: DataFrame, after_ms: int) -> DataFrame:
    """Arrivals and processing-time timers per user."""
    return clicks.groupBy("user").transformWithState(
        ClockTimers(after_ms), TIMER_OUT, outputMode="Append", timeMode="ProcessingTime"
    )


class CountWindow(StatefulProcessor):
    """Sum of the last ``size`` values of a key at every ``every``-th row."""

    def __init__(self, size: int, every: int):
        self.size, self.every = size, every

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "n bigint, values array<bigint>")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        n, values = (self.last.get() if self.last.exists() else (0, []))
        values = list(values)
        for row in rows:
            n, values = n + 1, [*values, int(row["value"])][-self.size:]
            if n % self.every == 0:
                yield Row(key=key[0], fire=n // self.every, rows=len(values), total=sum(values))
        self.last.update((n, values))

    def close(self) -> None:
        pass


def count_window(rows: DataFrame, size: int, every: int) -> DataFrame:
    """``rows(key, value)``, counted as they arrive; the state of a key is its last ``size`` values.

    A key is counted by one task, as its order demands. ``operators.running.count_window`` does the same over
    recorded arrivals and spreads a hot key.
    """
    return rows.groupBy("key").transformWithState(
        CountWindow(size, every), COUNT_OUT, outputMode="Append", timeMode="None"
    )
