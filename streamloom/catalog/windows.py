"""Event-time windows, watermarks, late rows, top-n and timers."""

from __future__ import annotations

from pyspark.sql import functions as F

from streamloom.catalog.registry import CLICKS, DISORDER, query
from streamloom.operators import lateness, ranking, windows
from streamloom.operators.running import cuts_for
from streamloom.plans.derived import clicks, disordered_clicks

SECOND, MINUTE, HOUR, DAY = 1000, 60_000, 3_600_000, 86_400_000


def sliding(size: int, slide: int, keys: str = "url") -> str:
    """SQL text: counts per key and sliding window."""
    by = f", {keys}" if keys else ""
    return f"""slid AS (
        SELECT win_start{by}, win_start + {size} AS win_end, count(*) AS count
        FROM (SELECT {keys + ', ' if keys else ''}ts_ms - ts_ms % {slide} - unnest(range(0, {size}, {slide})) AS win_start FROM clicks)
        GROUP BY ALL)"""


# --- windows -----------------------------------------------------------------------------------

TUMBLE = f"""
    WITH {CLICKS}
    SELECT url, ts_ms - ts_ms % {DAY} AS win_start, ts_ms - ts_ms % {DAY} + {DAY} AS win_end, count(*) AS count
    FROM clicks GROUP BY ALL"""


@query("tumble_count", TUMBLE)
def _(spark, sf):
    return windows.tumble_count(clicks(spark, sf), ["url"], DAY)


@query("tumble_reduce_pt", f"""
    WITH {CLICKS}
    SELECT "user", ts_ms - ts_ms % {6 * HOUR} AS win_start, ts_ms - ts_ms % {6 * HOUR} + {6 * HOUR} AS win_end, count(*) AS one
    FROM clicks GROUP BY ALL""")
def _(spark, sf):
    rows = clicks(spark, sf).withColumnRenamed("ts", "ingest_ts").withColumn("one", F.lit(1))
    return windows.tumble_sum(rows, ["user"], "one", 6 * HOUR, "ingest_ts")


SLIDE = f"WITH {CLICKS}, {sliding(DAY, DAY // 2)} SELECT * FROM slid"


@query("slide_count", SLIDE)
def _(spark, sf):
    return windows.slide_count(clicks(spark, sf), ["url"], DAY, DAY // 2)


SESSION_GAP = 6 * HOUR
SESSION = f"""
    WITH {CLICKS}, flagged AS (
        SELECT "user", ts_ms, CASE WHEN ts_ms - lag(ts_ms) OVER w <= {SESSION_GAP} THEN 0 ELSE 1 END AS opens
        FROM clicks WINDOW w AS (PARTITION BY "user" ORDER BY ts_ms, seq)),
    numbered AS (
        SELECT "user", ts_ms, sum(opens) OVER (PARTITION BY "user" ORDER BY ts_ms ROWS UNBOUNDED PRECEDING) AS s FROM flagged)
    SELECT "user", count(*) AS count, min(ts_ms) AS win_start, max(ts_ms) + {SESSION_GAP} AS win_end
    FROM numbered GROUP BY "user", s"""


@query("session_count", SESSION)
def _(spark, sf):
    return windows.session_count(clicks(spark, sf), ["user"], SESSION_GAP)


@query("slide_hour_30s", f"WITH {CLICKS}, {sliding(HOUR, 30 * SECOND)} SELECT * FROM slid")
def _(spark, sf):
    return windows.slide_count(clicks(spark, sf), ["url"], HOUR, 30 * SECOND)


@query("tumble_hour", f"""
    WITH {CLICKS}
    SELECT url, ts_ms - ts_ms % {HOUR} AS win_start, ts_ms - ts_ms % {HOUR} + {HOUR} AS win_end, count(*) AS count
    FROM clicks GROUP BY ALL""")
def _(spark, sf):
    return windows.tumble_count(clicks(spark, sf), ["url"], HOUR)


_UV = f"""
    WITH {CLICKS}
    SELECT ts_ms - ts_ms % {DAY} AS win_start, ts_ms - ts_ms % {DAY} + {DAY} AS win_end, count(DISTINCT "user") AS uv
    FROM clicks GROUP BY 1, 2"""


@query("window_pv_uv", f"""
    WITH {CLICKS}
    SELECT ts_ms - ts_ms % {DAY} AS win_start, ts_ms - ts_ms % {DAY} + {DAY} AS win_end, count(*) AS pv,
        count(DISTINCT "user") AS uv, CAST(count(*) AS DOUBLE) / count(DISTINCT "user") AS ratio
    FROM clicks GROUP BY 1, 2""")
def _(spark, sf):
    return windows.window_pv_uv(clicks(spark, sf), "user", DAY)


@query("window_uv_incremental", _UV)
def _(spark, sf):
    return windows.window_uv_incremental(clicks(spark, sf), "user", DAY)


@query("window_uv_full", _UV)
def _(spark, sf):
    return windows.window_uv_full(clicks(spark, sf), "user", DAY)


@query("window_all", f"WITH {CLICKS}, {sliding(DAY, DAY // 2, '')} SELECT * FROM slid")
def _(spark, sf):
    return windows.window_all(clicks(spark, sf), DAY, DAY // 2)


@query("url_count_map", f"WITH {CLICKS}, {sliding(12 * HOUR, 6 * HOUR)} SELECT * FROM slid")
def _(spark, sf):
    return windows.url_counts(clicks(spark, sf), 12 * HOUR, 6 * HOUR)


@query("mean_timestamp", f"""
    WITH {CLICKS}
    SELECT "user", ts_ms - ts_ms % {DAY} AS win_start, ts_ms - ts_ms % {DAY} + {DAY} AS win_end,
        CAST(sum(ts_ms) // count(*) AS BIGINT) AS mean_ms FROM clicks GROUP BY 1, 2, 3""")
def _(spark, sf):
    return windows.mean_timestamp(clicks(spark, sf), ["user"], DAY)


@query("window_floor", f"WITH {CLICKS} SELECT seq, ts_ms - ts_ms % {3 * SECOND} AS win_start FROM clicks")
def _(spark, sf):
    return clicks(spark, sf).select("seq", windows.window_start(F.col("timestamp"), 3 * SECOND).alias("win_start"))


# --- top-n -------------------------------------------------------------------------------------

TOP_TWO = f"""
    WITH {CLICKS}, {sliding(DAY, DAY // 2)}, ranked AS (
        SELECT *, row_number() OVER (PARTITION BY win_start ORDER BY count DESC, url) AS rank FROM slid)
    SELECT win_start, win_end, url, count, CAST(rank AS INTEGER) AS rank FROM ranked WHERE rank <= 2"""


@query("topn_window_all", TOP_TWO)
def _(spark, sf):
    return ranking.topn_per_window(windows.url_counts(clicks(spark, sf), DAY, DAY // 2), 2)


@query("sort_desc", "SELECT event_type AS url, count(*) AS count FROM events GROUP BY 1 ORDER BY 2 DESC, 1")
def _(spark, sf):
    return ranking.sort_desc(clicks(spark, sf).groupBy("url").agg(F.count(F.lit(1)).alias("count")))


# --- watermarks and late rows ------------------------------------------------------------------

LATE_SIZE, LATE_DELAY, LATE_ALLOWED = HOUR, 4 * HOUR, HOUR


def _marked(source: str, delay: int) -> str:
    return f"""{source}, marked AS (
        SELECT *, max(ts_ms) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {delay} - 1 AS wm FROM clicks)"""


def _split(delay: int, allowed: int) -> str:
    return _marked(DISORDER, delay) + f""", framed AS (
        SELECT *, ts_ms - ts_ms % {LATE_SIZE} AS win_start, ts_ms - ts_ms % {LATE_SIZE} + {LATE_SIZE} AS win_end FROM marked),
    split AS (
        SELECT *, CASE WHEN win_end - 1 + {allowed} <= wm THEN 'late_dropped' WHEN win_end - 1 <= wm THEN 'late_refire'
            ELSE 'on_time' END AS status FROM framed)"""


def _late(spark, sf, delay=LATE_DELAY, allowed=LATE_ALLOWED):
    return lateness.split_late(disordered_clicks(spark, sf), LATE_SIZE, delay, allowed)


@query("wm_bounded", f"WITH {_marked(DISORDER, LATE_DELAY)} SELECT event_id, wm FROM marked")
def _(spark, sf):
    return lateness.with_watermark(disordered_clicks(spark, sf), LATE_DELAY).select("event_id", "wm")


@query("wm_monotonous", f"WITH {_marked(CLICKS, 0)} SELECT seq, wm FROM marked")
def _(spark, sf):
    return lateness.with_watermark(clicks(spark, sf), 0).select("seq", "wm")


@query("wm_none", f"WITH {CLICKS} SELECT seq, url, CAST(NULL AS BIGINT) AS wm FROM clicks")
def _(spark, sf):
    return lateness.without_watermark(clicks(spark, sf)).select("seq", "url", "wm")


@query("union_streams_wm", f"""
    WITH {DISORDER}, paired AS (
        SELECT *, max(CASE WHEN event_id % 2 = 0 THEN ts_ms END) OVER w - {2 * HOUR} - 1 AS a,
            max(CASE WHEN event_id % 2 = 1 THEN ts_ms END) OVER w - {5 * HOUR} - 1 AS b
        FROM clicks WINDOW w AS (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
    SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'first' ELSE 'second' END AS side,
        CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN least(a, b) END AS wm FROM paired""")
def _(spark, sf):
    rows = disordered_clicks(spark, sf)
    first = rows.filter("event_id % 2 = 0").withColumn("side", F.lit("first"))
    second = rows.filter("event_id % 2 = 1").withColumn("side", F.lit("second"))
    merged = lateness.with_merged_watermark(
        first.unionByName(second), F.col("side"), {"first": 2 * HOUR, "second": 5 * HOUR}
    )
    return merged.select("event_id", "side", "wm")


@query("late_drop", f"""
    WITH {_split(LATE_DELAY, 0)}
    SELECT url, win_start, win_end, count(*) AS count FROM split WHERE status = 'on_time' GROUP BY ALL""")
def _(spark, sf):
    return lateness.on_time_counts(_late(spark, sf, allowed=0), ["url"])


@query("late_refire", f"""
    WITH {_split(LATE_DELAY, LATE_ALLOWED)}, counted AS (
        SELECT *, count(*) OVER (PARTITION BY url, win_start ORDER BY seq ROWS UNBOUNDED PRECEDING) AS count
        FROM split WHERE status <> 'late_dropped')
    SELECT url, win_start, win_end, CAST(NULL AS BIGINT) AS seq, count(*) AS count, 'first' AS kind
    FROM split WHERE status = 'on_time' GROUP BY ALL
    UNION ALL SELECT url, win_start, win_end, seq, count, 'refire' FROM counted WHERE status = 'late_refire'""")
def _(spark, sf):
    rows = disordered_clicks(spark, sf)
    chunk = cuts_for(rows, "seq")
    split = lateness.split_late(rows, LATE_SIZE, LATE_DELAY, LATE_ALLOWED, chunk=chunk)
    return lateness.emissions(split, ["url"], chunk=chunk)


@query("late_side_output", f"""
    WITH {_split(LATE_DELAY, LATE_ALLOWED)}
    SELECT event_id, "user", url, ts_ms AS timestamp, win_end, wm FROM split WHERE status = 'late_dropped'""")
def _(spark, sf):
    late = lateness.late_side_output(_late(spark, sf))
    return late.select("event_id", "user", "url", "timestamp", "win_end", "wm")


@query("wm_in_output", f"""
    WITH {_split(LATE_DELAY, LATE_ALLOWED)} SELECT event_id, url, status, win_start, wm FROM split""")
def _(spark, sf):
    return _late(spark, sf).select("event_id", "url", "status", "win_start", "wm")


@query("timer_event", f"""
    WITH {CLICKS}
    SELECT "user", ts_ms AS at, 'arrival' AS kind FROM clicks
    UNION ALL SELECT DISTINCT "user", ts_ms + {10 * SECOND}, 'timer' FROM clicks""")
def _(spark, sf):
    return lateness.arrivals_and_timers(clicks(spark, sf), "user", 10 * SECOND)
