"""Operators that keep their own state per key: late counts that fire again, running results per record, a join that caches both sides, a list with a timer.

State lies in the state store, is checkpointed with the stream and comes back after a restart. Rows of one key inside a micro-batch are taken in the order of
``seq``; across micro-batches the order is that of the feed (``run.feed_in_order``). A key is the work of one task, as its order demands; what is held
in memory is one key's rows of one micro-batch. ``connect_by_key`` has no state store: what it keeps are tables, and no key is bound to one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from streamloom.functions.clock import window_floor
from streamloom.shipping import ship_by_value
from streamloom.streaming.run import worked_by_batch, write_batches
from streamloom.streaming.versions import finished

ship_by_value(__name__)

LATE_OUT = "url string, win_start bigint, win_end bigint, seq bigint, count bigint, kind string, user string, timestamp bigint"
FIRST, REFIRE, LATER = "first", "refire", "later"


class LateCounts(StatefulProcessor):
    """Count of a (url, window): emitted when the watermark passes the window, again for each row that is late, while rows later than allowed go aside."""

    def __init__(self, size_ms: int, lateness_ms: int):
        self.size, self.lateness = size_ms, lateness_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("window", "n bigint, fired boolean")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        url, start = key
        end = int(start) + self.size
        # Spark's watermark is the largest time less the delay, and 0 before there is one; the operator's own is a millisecond less.
        mark = int(timerValues.getCurrentWatermarkInMs())
        n, fired = self.state.get() if self.state.exists() else (0, False)
        passed = mark > 0 and end <= mark
        if passed and n and not fired:  # due before these rows came
            fired = True
            yield self._out(url, start, n, FIRST)
        kept = False
        for row in sorted(rows, key=lambda r: r["seq"]):
            if mark > 0 and end + self.lateness <= mark:
                yield self._out(url, start, None, LATER, row)
                continue
            n, kept = n + 1, True
            if passed:
                fired = True
                yield self._out(url, start, n, REFIRE, row)
        if kept or n:
            self.state.update((n, fired))
            self.handle.registerTimer(end + self.lateness if fired else end)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        url, start = key
        at, end = int(expiredTimerInfo.getExpiryTimeInMs()), int(start) + self.size
        if self.state.exists():
            n, fired = self.state.get()
            if not fired:
                yield self._out(url, start, n, FIRST)
            if at >= end + self.lateness:
                self.state.clear()
            else:
                self.state.update((n, True))
                self.handle.registerTimer(end + self.lateness)

    def _out(self, url, start, n, kind: str, row: Row | None = None) -> Row:
        return Row(
            url=url, win_start=int(start), win_end=int(start) + self.size, seq=int(row["seq"]) if row else None, count=n, kind=kind,
            user=row["user"] if kind == LATER else None, timestamp=int(row["timestamp"]) if kind == LATER else None,
        )

    def close(self) -> None:
        pass


def late_counts(clicks: DataFrame, size_ms: int, delay_ms: int, lateness_ms: int) -> DataFrame:
    """``kind`` first, refire or later for windows of ``size_ms`` per url of ``clicks(user, url, timestamp, ts, seq)``.

    The watermark a row meets is that at the start of its micro-batch, as Spark keeps it; with one arrival per micro-batch it is exact per record.
    """
    marked = clicks.withWatermark("ts", f"{delay_ms} milliseconds")
    # Without its time column Spark has nothing to drop late rows by: the processor judges every row.
    rows = marked.select("user", "url", "timestamp", "seq", window_floor(F.col("timestamp"), size_ms).alias("win_start"))
    return rows.groupBy("url", "win_start").transformWithState(LateCounts(size_ms, lateness_ms), LATE_OUT, outputMode="Append", timeMode="EventTime")


RUNNING_OUT = "key string, seq bigint, first_other string, other string, n bigint, total bigint, largest bigint"


class Running(StatefulProcessor):
    """One result per record: count, sum and maximum so far, and the other field of the key's first record."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("running", "first string, n bigint, total bigint, largest bigint")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        first, n, total, largest = self.state.get() if self.state.exists() else (None, 0, None, None)
        for row in sorted(rows, key=lambda r: r["seq"]):
            value, other = row["value"], row["other"]
            first, n = other if not n else first, n + 1
            if value is not None:
                total, largest = int(value) + (total or 0), int(value) if largest is None else max(largest, int(value))
            yield Row(key=key[0], seq=int(row["seq"]), first_other=first, other=other, n=n, total=total, largest=largest)
        self.state.update((first, n, total, largest))

    def close(self) -> None:
        pass


def running_changelog(rows: DataFrame, key: str, value: str, other: str, seq: str = "seq") -> DataFrame:
    """Every record's running results: ``key``, ``seq``, ``first_other`` (the key's first ``other``), ``other``, ``n``, ``total`` and ``largest`` of ``value``.

    Sum, maximum, pair sum and reduce are choices of its columns. NULL values count in ``n`` only.
    """
    named = rows.select(F.col(key).cast("string").alias("key"), F.col(seq).alias("seq"), F.col(value).cast("bigint").alias("value"), F.col(other).cast("string").alias("other"))
    return named.groupBy("key").transformWithState(Running(), RUNNING_OUT, outputMode="Append", timeMode="None")


PAIR_OUT = "id bigint, left string, right string, later_side string"


def connect_by_key(left: DataFrame, right: DataFrame, key: str, left_seq: str, right_seq: str) -> DataFrame:
    """Inner join of two streams without any bound on time: ``id``, ``left`` and ``right`` (the other columns of a row as JSON) and ``later_side``, the side that completed the pair.

    All rows of both sides are kept, as a join without a bound must: a table for each micro-batch, to which nothing is written again. A micro-batch joins its
    left rows with all right ones and its right rows with the earlier left ones, so its work is two joins, which Spark spills and whose hot keys it splits,
    and no row costs look-ups of its own; each micro-batch reads what is kept once. A pair comes out once, whichever micro-batches its rows are in. The
    numbers are those of arrival, by which both streams are fed; of equal ones the left row was first. The joins are ``worked_by_batch``.
    """
    spark = left.sparkSession

    def side(df: DataFrame, is_left: bool, seq: str) -> DataFrame:
        rest = [c for c in df.columns if c not in (key, seq)]
        known = df.where(F.col(key).isNotNull())
        return known.select(F.lit(is_left).alias("is_left"), F.col(key).cast("bigint").alias("key"), F.col(seq).cast("bigint").alias("seq"), F.to_json(F.struct(*rest)).alias("row"))

    both = side(left, True, left_seq).unionByName(side(right, False, right_seq))

    def meet(batch: DataFrame, batch_id: int, folder: str) -> DataFrame:
        write_batches(batch, batch_id, folder)

        def rows(batches: list[int], is_left: bool, name: str) -> DataFrame:
            kept = spark.read.schema(both.schema).parquet(*[f"{folder}/batch_id={n}" for n in batches])
            return kept.where(F.col("is_left") == is_left).select("key", F.col("seq").alias(f"{name}_seq"), F.col("row").alias(name))

        upto = [n for n in finished(spark, folder, "batch_id") if n <= batch_id]
        pairs = rows([batch_id], True, "left").join(rows(upto, False, "right"), "key")
        if earlier := upto[:-1]:
            pairs = pairs.unionByName(rows(earlier, True, "left").join(rows([batch_id], False, "right"), "key"))
        return pairs.select(F.col("key").alias("id"), "left", "right", F.when(F.col("left_seq") > F.col("right_seq"), "left").otherwise("right").alias("later_side"))

    return worked_by_batch(both, meet, StructType.fromDDL(PAIR_OUT))


TOP_OUT = "win_start bigint, win_end bigint, url string, count bigint, rank int"


class TopOfWindow(StatefulProcessor):
    """The counts of a window end are kept in a list; a timer one millisecond after the end ranks them and clears the list."""

    def __init__(self, size_ms: int, n: int):
        self.size, self.n = size_ms, n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getListState("counts", "url string, n bigint")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        self.counts.appendList([(row["url"], int(row["count"])) for row in rows])
        self.handle.registerTimer(int(key[0]) + 1)
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        end = int(key[0])
        # A url of NULL ranks first among equal counts, as in SQL's ascending order of this engine.
        ranked = sorted(self.counts.get(), key=lambda c: (-c[1], c[0] is not None, c[0] or ""))
        self.counts.clear()
        for rank, (url, count) in enumerate(ranked[: self.n], 1):
            yield Row(win_start=end - self.size, win_end=end, url=url, count=int(count), rank=rank)

    def close(self) -> None:
        pass


def top_of_windows(counts: DataFrame, size_ms: int, n: int) -> DataFrame:
    """The ``n`` most frequent urls per window of ``counts(url, win_end, count, at)``, a windowed count whose ``at`` is its window's time. Equal counts rank by url."""
    return counts.groupBy("win_end").transformWithState(TopOfWindow(size_ms, n), TOP_OUT, outputMode="Append", timeMode="EventTime")
