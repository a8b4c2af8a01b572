"""Event-time windows over clicks (``user, url, timestamp`` in ms, ``ts`` as timestamp).

Window bounds are reported as epoch milliseconds, the end exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from streamloom.functions.clock import window_floor
from streamloom.operators.aggregate import pv_uv_ratio


def _span(ms: int) -> str:
    return f"{ms} milliseconds"


def bounds(df: DataFrame, window: str = "window") -> DataFrame:
    """Replace a window column by ``win_start`` and ``win_end``."""
    return df.withColumns(
        {"win_start": F.unix_millis(f"{window}.start"), "win_end": F.unix_millis(f"{window}.end")}
    ).drop(window)


def tumble_count(df: DataFrame, keys: list[str], size_ms: int, ts: str = "ts") -> DataFrame:
    """Rows per key and tumbling window. Batch or streaming."""
    counted = df.groupBy(F.window(ts, _span(size_ms)), *keys).agg(F.count(F.lit(1)).alias("count"))
    return bounds(counted)


def tumble_sum(df: DataFrame, keys: list[str], value: str, size_ms: int, ts: str) -> DataFrame:
    """Sum per key and tumbling window; ``ts`` may be an arrival-time column. Batch or streaming."""
    return bounds(df.groupBy(F.window(ts, _span(size_ms)), *keys).agg(F.sum(value).alias(value)))


def tumble_sum_arrival(df: DataFrame, keys: list[str], value: str, size_ms: int) -> DataFrame:
    """Streaming sum per key and processing-time window."""
    return tumble_sum(df.withColumn("arrived", F.current_timestamp()), keys, value, size_ms, "arrived")


def slide_count(df: DataFrame, keys: list[str], size_ms: int, slide_ms: int) -> DataFrame:
    """Rows per key and sliding window, in batch.

    Rows are first counted per pane of one slide. Time is cut into blocks as long as a window, so a window is the tail of
    one block and the head of the next: running sums inside a block give all of them, and a window is made of two rows at most
    however many panes it has. A block has ``size / slide`` panes at most, so no key is too large.
    """
    if size_ms % slide_ms:
        return bounds(
            df.groupBy(F.window("ts", _span(size_ms), _span(slide_ms)), *keys).agg(F.count(F.lit(1)).alias("count"))
        )
    panes = (
        df.groupBy(window_floor(F.col("timestamp"), slide_ms).alias("__pane"), *keys)
        .agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__block", window_floor(F.col("__pane"), size_ms))
    )
    block = Window.partitionBy("__block", *keys).orderBy("__pane")
    step, last = F.lit(slide_ms).cast("bigint"), F.col("__block") + (size_ms - slide_ms)
    summed = panes.withColumns({
        "__tail": F.sum("__n").over(block.rowsBetween(0, Window.unboundedFollowing)),
        "__head": F.sum("__n").over(block.rowsBetween(Window.unboundedPreceding, 0)),
        "__from": F.coalesce(F.lag("__pane").over(block) + slide_ms, F.col("__block")),
        "__to": F.coalesce(F.lead("__pane").over(block), last),
    })

    def starts(first: Column, to: Column, count: str) -> Column:
        found = F.transform(F.sequence(first, to, step), lambda s: F.struct(s.alias("win_start"), F.col(count).alias("n")))
        return F.when(first <= to, found).otherwise(F.array().cast("array<struct<win_start:bigint,n:bigint>>"))

    in_block = starts(F.col("__from"), F.col("__pane"), "__tail")
    before = starts(F.col("__pane") + (slide_ms - size_ms), F.col("__to") - size_ms, "__head")
    return (
        summed.select(*keys, F.explode(F.concat(in_block, before)).alias("__w"))
        .groupBy(F.col("__w.win_start").alias("win_start"), *keys)
        .agg(F.sum("__w.n").alias("count"))
        .withColumn("win_end", F.col("win_start") + size_ms)
    )


def slide_count_stream(df: DataFrame, keys: list[str], size_ms: int, slide_ms: int) -> DataFrame:
    """Rows per key and sliding window, for a stream."""
    window = F.window("ts", _span(size_ms), _span(slide_ms))
    return bounds(df.groupBy(window, *keys).agg(F.count(F.lit(1)).alias("count")))


def session_count(df: DataFrame, keys: list[str], gap_ms: int) -> DataFrame:
    """Rows per key and session, in batch; events exactly one gap apart share a session.

    Events of one gap-long cell always share a session, so rows are hashed down to cells first. What is
    left per key is bounded by its time span over the gap, however many rows a key has.
    """
    cells = (
        df.groupBy(*keys, window_floor(F.col("timestamp"), gap_ms).alias("__cell"))
        .agg(F.min("timestamp").alias("__from"), F.max("timestamp").alias("__to"), F.count(F.lit(1)).alias("__n"))
    )
    ordered = Window.partitionBy(*keys).orderBy("__cell")
    opens = F.col("__from") - F.lag("__to").over(ordered) > gap_ms
    return (
        cells.withColumn("__opens", F.coalesce(opens, F.lit(True)).cast("int"))
        .withColumn("__session", F.sum("__opens").over(ordered))
        .groupBy(*keys, "__session")
        .agg(
            F.sum("__n").alias("count"),
            F.min("__from").alias("win_start"),
            (F.max("__to") + gap_ms).alias("win_end"),
        )
        .drop("__session")
    )


def session_count_stream(df: DataFrame, keys: list[str], gap_ms: int) -> DataFrame:
    """Rows per key and session, for a stream; at least one key is needed."""
    if not keys:
        raise ValueError("a streaming session needs a key")
    return bounds(
        df.groupBy(F.session_window("ts", _span(gap_ms)).alias("window"), *keys).agg(F.count(F.lit(1)).alias("count"))
    )


def _in_window(df: DataFrame, size_ms: int) -> DataFrame:
    start = window_floor(F.col("timestamp"), size_ms)
    return df.withColumns({"win_start": start, "win_end": start + size_ms})


def window_pv_uv(df: DataFrame, user: str, size_ms: int) -> DataFrame:
    """Views, distinct users and their ratio per tumbling window over all rows."""
    return pv_uv_ratio(_in_window(df, size_ms), user, "win_start", "win_end")


def window_uv_incremental(df: DataFrame, user: str, size_ms: int) -> DataFrame:
    """Distinct users per tumbling window, with its bounds."""
    return window_pv_uv(df, user, size_ms).select("win_start", "win_end", "uv")


def window_uv_full(df: DataFrame, user: str, size_ms: int) -> DataFrame:
    """Distinct users per tumbling window, written as a plain distinct count."""
    return _in_window(df, size_ms).groupBy("win_start", "win_end").agg(F.count_distinct(user).alias("uv"))


def window_uv_stream(df: DataFrame, user: str, size_ms: int, error: float = 0.02) -> DataFrame:
    """Distinct users per tumbling window of a stream, by sketch, so state does not grow with users."""
    return bounds(df.groupBy(F.window("ts", _span(size_ms))).agg(F.approx_count_distinct(user, error).alias("uv")))


def window_uv_exact_stream(df: DataFrame, user: str, size_ms: int) -> DataFrame:
    """Distinct users per tumbling window of a stream, exactly: one state row per window and user, forgotten when the window closes; NULL is no user."""
    users = df.select(F.window("ts", _span(size_ms)).alias("window"), F.col(user).alias("user")).dropDuplicates(["window", "user"])
    return bounds(users.groupBy("window").agg(F.count("user").alias("uv")))


def window_all(df: DataFrame, size_ms: int, slide_ms: int) -> DataFrame:
    """Rows per window over all keys, counted in two phases."""
    return slide_count(df, [], size_ms, slide_ms)


def mean_timestamp(df: DataFrame, keys: list[str], size_ms: int) -> DataFrame:
    """Mean event time (ms, rounded down) per key and tumbling window.

    Offsets into the window are summed, which keeps the sum far from overflow.
    """
    framed = _in_window(df, size_ms)
    offset = F.sum(F.col("timestamp") - F.col("win_start"))
    return (
        framed.groupBy(*keys, "win_start", "win_end")
        .agg(offset.alias("__offset"), F.count(F.lit(1)).alias("__n"))
        .select(*keys, "win_start", "win_end",
                (F.col("win_start") + F.expr("__offset div __n")).alias("mean_ms"))
    )


def url_counts(df: DataFrame, size_ms: int, slide_ms: int) -> DataFrame:
    """Count per url and sliding window: the rows of a url → count map per window."""
    return slide_count(df, ["url"], size_ms, slide_ms)


def window_start(ms: Column, size_ms: int) -> Column:
    return window_floor(ms, size_ms)
