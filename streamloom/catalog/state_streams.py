"""Streams with their own keyed state, fed in several micro-batches with a restart from the checkpoint between them; the SQL is over the same tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from streamloom.catalog.registry import CLICKS, DISORDER, ORACLES, SENSORS, query
from streamloom.catalog.windows import DAY, HOUR, TOP_TWO
from streamloom.operators import windows
from streamloom.plans.derived import clicks_of, disordered_clicks, sensors
from streamloom.sources.files import read_table
from streamloom.streaming import keyed_state
from streamloom.streaming.run import EndMark, feed_in_order

PARTS = 4
SIZE, LATE_DELAY, ALLOWED = HOUR, 4 * HOUR, HOUR
MARK = {"ts": EndMark.AT}


def _clicks_in_time(spark, sf):
    """Clicks and the number they are fed by: their time."""
    return [(clicks_of(read_table(spark, sf, "events")), "timestamp")]


@query("late_refire_stream", f"""
    WITH {DISORDER}, cut AS (SELECT *, (seq - min(seq) OVER ()) * {PARTS} // (max(seq) OVER () - min(seq) OVER () + 1) AS part FROM clicks),
    marked AS (SELECT *, max(ts_ms) OVER (ORDER BY part GROUPS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {LATE_DELAY} - 1 AS wm FROM cut),
    framed AS (SELECT *, ts_ms - ts_ms % {SIZE} AS win_start, ts_ms - ts_ms % {SIZE} + {SIZE} AS win_end FROM marked),
    split AS (
        SELECT *, CASE WHEN win_end - 1 + {ALLOWED} <= wm THEN 'later' WHEN win_end - 1 <= wm THEN 'refire' ELSE 'first' END AS kind FROM framed),
    counted AS (SELECT *, count(*) OVER (PARTITION BY url, win_start ORDER BY seq ROWS UNBOUNDED PRECEDING) AS n FROM split WHERE kind <> 'later')
    SELECT url, win_start, win_end, CAST(NULL AS BIGINT) AS seq, count(*) AS count, 'first' AS kind, CAST(NULL AS VARCHAR) AS "user", CAST(NULL AS BIGINT) AS timestamp
    FROM split WHERE kind = 'first' GROUP BY url, win_start, win_end
    UNION ALL SELECT url, win_start, win_end, seq, n, 'refire', NULL, NULL FROM counted WHERE kind = 'refire'
    UNION ALL SELECT url, win_start, win_end, seq, NULL, 'later', "user", ts_ms FROM split WHERE kind = 'later'""")
def _(spark, sf):
    rows = disordered_clicks(spark, sf).withColumn("ts", F.timestamp_millis("timestamp"))
    make = lambda s: keyed_state.late_counts(s, SIZE, LATE_DELAY, ALLOWED)
    out = feed_in_order(spark, [(rows, "seq")], PARTS, make, marks=[{**MARK, "url": "end", "seq": 0, "timestamp": 221845392000000}])
    return out.filter("win_end < 221845392000000").drop("batch_id")


@query("running_changelog_stream", f"""
    WITH {SENSORS}
    SELECT id AS key, seq, CAST(first_value(ts) OVER w AS VARCHAR) AS first_other, CAST(ts AS VARCHAR) AS other, count(*) OVER w AS n,
        CAST(sum(vc) OVER w AS BIGINT) AS total, CAST(max(vc) OVER w AS BIGINT) AS largest
    FROM sensors WINDOW w AS (PARTITION BY id ORDER BY seq ROWS UNBOUNDED PRECEDING)""")
def _(spark, sf):
    return feed_in_order(spark, [(sensors(spark, sf), "seq")], PARTS, lambda s: keyed_state.running_changelog(s, "id", "vc", "ts")).drop("batch_id")


@query("connect_keyed_stream", ORACLES["connect_keyed_join"])
def _(spark, sf):
    at = lambda c: F.unix_millis(F.col(c).cast("timestamp"))
    left = read_table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("a"), at("o_orderdate").alias("at"))
    right = read_table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_partkey").alias("b"), F.col("l_linenumber").alias("n"), at("l_shipdate").alias("at"))
    out = feed_in_order(spark, [(left, "at"), (right, "at")], PARTS, lambda a, b: keyed_state.connect_by_key(a, b, "id", "at", "at"))
    of = {name: f"{name} {kind.simpleString()}" for df in (left, right) for name, kind in ((f.name, f.dataType) for f in df.schema.fields)}
    rows = out.select("id", "later_side", F.from_json("left", of["a"]).alias("l"), F.from_json("right", f"{of['b']}, {of['n']}").alias("r"))
    return rows.select("id", "l.a", "r.b", "r.n", "later_side")


@query("list_state_timer", TOP_TWO)
def _(spark, sf):
    def make(clicks):
        counted = windows.slide_count_stream(clicks.withWatermark("ts", "2 seconds"), ["url"], DAY, DAY // 2)
        return keyed_state.top_of_windows(counted, DAY, 2)

    out = feed_in_order(spark, _clicks_in_time(spark, sf), PARTS, make, marks=[{**MARK, "url": "end"}])
    return out.drop("batch_id")


@query("uv_distinct_stream", f"""
    WITH {CLICKS} SELECT ts_ms - ts_ms % {DAY} AS win_start, ts_ms - ts_ms % {DAY} + {DAY} AS win_end, count(DISTINCT "user") AS uv FROM clicks GROUP BY ALL""")
def _(spark, sf):
    make = lambda s: windows.window_uv_exact_stream(s.withWatermark("ts", "2 seconds"), "user", DAY)
    return feed_in_order(spark, _clicks_in_time(spark, sf), PARTS, make, marks=[MARK]).drop("batch_id")
