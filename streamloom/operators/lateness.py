"""Watermarks and late rows over a recorded arrival order.

``seq`` numbers the arrivals. The watermark a row meets is the largest event time among earlier arrivals,
less the allowed delay, less one millisecond; it is NULL before the first arrival.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from streamloom.functions.clock import window_floor
from streamloom.operators.running import Cuts, running

ON_TIME, REFIRE, DROPPED = "on_time", "late_refire", "late_dropped"


def with_watermark(df: DataFrame, delay_ms: int, seq: str = "seq", time: str = "timestamp", chunk: int | Cuts | None = None) -> DataFrame:
    """Add ``wm``, the watermark each row meets on arrival."""
    seen = running(df, [], seq, {"__seen": ("max", F.col(time))}, chunk, earlier_only=True)
    return seen.withColumn("wm", F.col("__seen") - delay_ms - 1).drop("__seen")


def with_merged_watermark(
    df: DataFrame, side: Column, delays_ms: dict[str, int], seq: str = "seq", time: str = "timestamp", chunk: int | Cuts | None = None,
) -> DataFrame:
    """Add ``wm`` for a union of streams: the least of the inputs' watermarks, NULL until all have one."""
    seen = {f"__wm_{name}": ("max", F.when(side == name, F.col(time) - delay - 1)) for name, delay in delays_ms.items()}
    out = running(df, [], seq, seen, chunk, earlier_only=True)
    marks = [F.col(name) for name in seen]
    known = marks[0].isNotNull()
    for mark in marks[1:]:
        known = known & mark.isNotNull()
    return out.withColumn("wm", F.when(known, F.least(*marks))).drop(*seen)


def without_watermark(df: DataFrame) -> DataFrame:
    return df.withColumn("wm", F.lit(None).cast("bigint"))


def split_late(
    df: DataFrame, size_ms: int, delay_ms: int, lateness_ms: int, seq: str = "seq", time: str = "timestamp", chunk: int | Cuts | None = None,
) -> DataFrame:
    """Add the tumbling window of each row, the watermark it meets, and ``status``.

    ``late_dropped`` rows go to the side output, ``late_refire`` rows update a window that has fired.
    """
    start = window_floor(F.col(time), size_ms)
    framed = with_watermark(df, delay_ms, seq, time, chunk).withColumns(
        {"win_start": start, "win_end": start + size_ms}
    )
    last = F.col("win_end") - 1
    return framed.withColumn(
        "status",
        F.when(last + lateness_ms <= F.col("wm"), DROPPED).when(last <= F.col("wm"), REFIRE).otherwise(ON_TIME),
    )


def on_time_counts(split: DataFrame, keys: list[str]) -> DataFrame:
    """What each window emits when no lateness is allowed: the count of its rows in time."""
    kept = split.filter(F.col("status") == ON_TIME)
    return kept.groupBy(*keys, "win_start", "win_end").agg(F.count(F.lit(1)).alias("count"))


def emissions(split: DataFrame, keys: list[str], seq: str = "seq", chunk: int | Cuts | None = None) -> DataFrame:
    """Everything the windows emit: the first firing, then one updated count per re-firing row.

    ``seq`` is NULL for first firings. Give the ``chunk`` of the recorded arrivals (``running.cuts_for``); finding
    it here would run the whole split once more.
    """
    group = [*keys, "win_start", "win_end"]
    first = on_time_counts(split, keys).select(
        *group, F.lit(None).cast("bigint").alias(seq), F.col("count"), F.lit("first").alias("kind")
    )
    kept = split.filter(F.col("status") != DROPPED).select(*group, seq, "status")
    counted = running(kept, group, seq, {"count": ("count", F.lit(1))}, chunk)
    again = counted.filter(F.col("status") == REFIRE).select(*group, seq, "count", F.lit("refire").alias("kind"))
    return first.unionByName(again)


def late_side_output(split: DataFrame) -> DataFrame:
    """Rows too late for their window."""
    return split.filter(F.col("status") == DROPPED)


def arrivals_and_timers(df: DataFrame, key: str, after_ms: int, time: str = "timestamp") -> DataFrame:
    """One row per arrival and one per timer set ``after_ms`` later; a key has one timer per time."""
    arrivals = df.select(key, F.col(time).alias("at"), F.lit("arrival").alias("kind"))
    timers = df.select(key, (F.col(time) + after_ms).alias("at")).distinct().withColumn("kind", F.lit("timer"))
    return arrivals.unionByName(timers)
