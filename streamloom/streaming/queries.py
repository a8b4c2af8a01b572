"""Streaming forms that need more than the batch transform."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from streamloom.operators.project import split_words
from streamloom.operators.ranking import topn_per_window
from streamloom.operators.windows import slide_count_stream
from streamloom.streaming.run import EndMark, feed_in_order, start_to_table


def word_count(lines: DataFrame, line: str = "value") -> DataFrame:
    """Running count per word; in update mode every batch reports the words it changed."""
    return split_words(lines, line).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def union_watermarked(first: DataFrame, first_delay: str, second: DataFrame, second_delay: str, ts: str = "ts") -> DataFrame:
    """Two streams with delays of their own; the union follows the slower watermark."""
    return first.withWatermark(ts, first_delay).unionByName(second.withWatermark(ts, second_delay))


def sliding_counts(clicks: DataFrame, size_ms: int, slide_ms: int, delay: str) -> DataFrame:
    """Count per url and sliding window; in append mode each window comes once, when it closes."""
    return slide_count_stream(clicks.withWatermark("ts", delay), ["url"], size_ms, slide_ms)


def start_topn(
    clicks: DataFrame, size_ms: int, slide_ms: int, n: int, delay: str, path: str, checkpoint: str, **trigger,
) -> StreamingQuery:
    """Two stages: count per window and url, then the first ``n`` urls of every window that closes.

    All urls of a window close in the same micro-batch, so the ranking is a batch rank over closed windows
    and needs no list state.
    """
    counts = sliding_counts(clicks, size_ms, slide_ms, delay)
    return start_to_table(counts, path, checkpoint, finish=lambda closed: topn_per_window(closed, n), **trigger)


def topn_in_order(spark: SparkSession, clicks: DataFrame, size_ms: int, slide_ms: int, n: int, delay: str, parts: int, end: int) -> DataFrame:
    """The two stages over a table fed in the order of ``timestamp``, with a mark at ``end`` that closes the last windows; with ``batch_id``."""
    def start(stream: DataFrame, path: str, checkpoint: str, _mode: str) -> StreamingQuery:
        return start_topn(stream, size_ms, slide_ms, n, delay, path, checkpoint)

    schema = "win_start bigint, win_end bigint, url string, count bigint, rank int"
    return feed_in_order(spark, [(clicks, "timestamp")], parts, lambda rows: rows, marks=[{"ts": EndMark.AT, "timestamp": end}], start=start, schema=schema)


def keyed_join(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, delay: str, within: str, how: str = "inner") -> DataFrame:
    """Stream-stream join; rows of a key wait for a partner at most ``within`` apart in event time."""
    left = left.withWatermark(left_ts, delay).withColumnRenamed(key, "__key")
    right = right.withWatermark(right_ts, delay)
    near = F.expr(
        f"__key = {key} AND {right_ts} BETWEEN {left_ts} - INTERVAL {within} AND {left_ts} + INTERVAL {within}"
    )
    return left.join(right, near, how)
