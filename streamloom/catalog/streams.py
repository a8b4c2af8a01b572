"""Streaming forms of the operators, run over a whole table to its end.

Each reads its table as a stream, writes every micro-batch to the shared scratch folder and reads the result
back; the SQL is that of the batch form.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from streamloom.catalog.joins import TODAY
from streamloom.catalog.pipelines import CDC_FACTS, DAU, LOG_MESSAGES, ORDER_WIDE, dim_tables, fact_tables, read_messages
from streamloom.catalog.registry import CLICKS, ORACLES, WORDS, query
from streamloom.catalog.windows import DAY, SECOND, SESSION, SESSION_GAP, SLIDE, TOP_TWO, TUMBLE
from streamloom.operators import project, windows
from streamloom.plans import cdc, log_fanout
from streamloom.plans.dau import enrich_visits, first_visits_stream
from streamloom.plans.derived import (
    changes, clicks_of, order_details_of, order_headers_of, province_dim, raw_logs_of, user_dim,
)
from streamloom.plans.order_wide import order_wide_stream
from streamloom.session import scratch
from streamloom.sources.files import read_table, stream_table
from streamloom.streaming import meeting, queries, sinks, stateful
from streamloom.streaming.run import EndMark, feed_in_order, read_batches, run_latest, run_to_table, start_to_table

DELAY = "2 seconds"
#: How long an order row waits for its partner in a stream's state; pairs further apart are settled in batch.
WAIT, WAIT_DAYS = "90 days", 90


def _clicks(spark, sf):
    return clicks_of(stream_table(spark, sf, "events"))


def _in_time(spark, sf, make, parts=3):
    """What a stream gives that gets the clicks in the order of their time, in several micro-batches, and the mark that closes the windows."""
    clicks = clicks_of(read_table(spark, sf, "events"))
    return feed_in_order(spark, [(clicks, "timestamp")], parts, make, marks=[{"ts": EndMark.AT, "timestamp": END}]).drop("batch_id")


#: ``EndMark.AT`` in milliseconds.
END = 221845392000000


@query("word_count_stream", f"WITH {WORDS} SELECT word, count(*) AS n FROM words GROUP BY word")
def _(spark, sf):
    lines = project.text_lines(stream_table(spark, sf, "documents"), "text")
    return run_latest(queries.word_count(lines, "line"), ["word"])


@query("tumble_count_stream", TUMBLE)
def _(spark, sf):
    return _in_time(spark, sf, lambda rows: windows.tumble_count(rows.withWatermark("ts", DELAY), ["url"], DAY))


@query("slide_count_stream", SLIDE)
def _(spark, sf):
    return _in_time(spark, sf, lambda rows: queries.sliding_counts(rows, DAY, DAY // 2, DELAY))


@query("session_count_stream", SESSION)
def _(spark, sf):
    return _in_time(spark, sf, lambda rows: windows.session_count_stream(rows.withWatermark("ts", DELAY), ["user"], SESSION_GAP))


@query("topn_two_stage", TOP_TWO)
def _(spark, sf):
    clicks = clicks_of(read_table(spark, sf, "events"))
    return queries.topn_in_order(spark, clicks, DAY, DAY // 2, 2, DELAY, 3, END).drop("batch_id")


@query("union_streams_wm_stream", TUMBLE)
def _(spark, sf):
    clicks = clicks_of(read_table(spark, sf, "events"))
    halves = [(clicks.filter(F.col("seq") % 2 == k), "timestamp") for k in range(2)]
    make = lambda a, b: windows.tumble_count(queries.union_watermarked(a, "2 seconds", b, "5 seconds"), ["url"], DAY)
    return feed_in_order(spark, halves, 3, make, marks=[{"ts": EndMark.AT}] * 2).drop("batch_id")


@query("timer_event_stream", ORACLES["timer_event"])
def _(spark, sf):
    out = _in_time(spark, sf, lambda rows: stateful.timer_event(rows, 10 * SECOND, DELAY))
    return out.filter(F.col("at") < END).select("user", "at", "kind")


@query("log_fanout_stream", LOG_MESSAGES)
def _(spark, sf):
    messages = log_fanout.route_logs(raw_logs_of(stream_table(spark, sf, "events")))
    routed = sinks.routed(messages, F.col("topic"), F.col("value"))
    path = scratch(spark, "topics")
    sinks.sink_routed_files(routed, path, scratch(spark, "topics-checkpoint")).trigger(availableNow=True).start().awaitTermination()
    return read_messages(spark.read.schema("key string, value string, topic string").parquet(path))


def _change_stream(spark, sf):
    path = scratch(spark, "changes")
    raw = changes(spark, sf)
    raw.write.parquet(path)
    return cdc.parse_changes(spark.readStream.schema(raw.schema).parquet(path))


@query("cdc_route_stream", CDC_FACTS)
def _(spark, sf):
    return run_to_table(cdc.fact_changes(_change_stream(spark, sf), fact_tables(spark, sf))).drop("batch_id")


@query("dim_upsert_stream", ORACLES["dim_upsert"])
def _(spark, sf):
    keyed = cdc.dim_changes(cdc.parse_changes(_in_files(spark, changes(spark, sf), 6)), dim_tables(spark, sf))
    path = scratch(spark, "dims")
    sinks.sink_dimensions(keyed, path, scratch(spark, "dims-checkpoint"), fold_every=2).trigger(availableNow=True).start().awaitTermination()
    return sinks.read_dimensions(spark, path)


@query("dau_stream", DAU)
def _(spark, sf):
    # Visits come in the order of their time, so a day stays open only until rows of the next one have come, however many days there are.
    pages = log_fanout.log_page(log_fanout.parse_logs(raw_logs_of(read_table(spark, sf, "events")), *log_fanout.PAGE_PARTS))
    first = feed_in_order(spark, [(pages, "ts")], 3, lambda rows: first_visits_stream(rows, "1 day"), marks=[{"ts": END}])
    return enrich_visits(first.drop("batch_id").filter(F.col("ts") < END), user_dim(spark, sf), province_dim(spark, sf), F.lit(TODAY).cast("date"))


@query("order_wide_stream", ORDER_WIDE)
def _(spark, sf):
    return order_wide_stream(
        spark, order_headers_of(read_table(spark, sf, "orders")), order_details_of(read_table(spark, sf, "lineitem")),
        user_dim(spark, sf), province_dim(spark, sf), F.lit(TODAY).cast("date"), WAIT,
    )


@query("sink_rolling_files", f"""
    WITH {CLICKS} SELECT strftime(make_timestamp(ts_ms * 1000), '%Y-%m-%d %H') AS dt_hour, 'a:' || seq AS value FROM clicks""")
def _(spark, sf):
    lines = _clicks(spark, sf).select(F.concat(F.lit("a:"), F.col("seq")).alias("value"), "ts")
    path = scratch(spark, "rolling")
    writer = sinks.sink_rolling_files(lines, path, scratch(spark, "rolling-checkpoint"), at=F.col("ts"))
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("value string, dt_hour string").text(path)


@query("sink_labelled", f"""
    WITH {CLICKS}
    SELECT CASE WHEN url = 'error' THEN 'later' ELSE 'first' END AS label,
        '{{"user":"' || "user" || '","url":"' || url || '","timestamp":' || ts_ms || '}}' AS value FROM clicks""")
def _(spark, sf):
    path = scratch(spark, "labelled")
    for label, rows in {"first": "url <> 'error'", "later": "url = 'error'"}.items():
        stream = _clicks(spark, sf).filter(rows).select("user", "url", "timestamp")
        writer = sinks.sink_labelled(stream, label, path, scratch(spark, "labelled-checkpoint"))
        writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(path).select("label", "value")


def _in_files(spark, df, batches):
    """The rows as a stream of ``batches`` micro-batches, each of a file for every core, so that all cores write and read them."""
    path, cores = scratch(spark, "feed"), spark.sparkContext.defaultParallelism
    df.repartition(batches * cores).write.option("maxRecordsPerFile", 0).parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", cores).parquet(path)


@query("exactly_once_progress", f'WITH {CLICKS} SELECT seq, "user", url, ts_ms AS timestamp FROM clicks')
def _(spark, sf):
    rows = clicks_of(_in_files(spark, read_table(spark, sf, "events"), 4)).drop("ts")
    path, checkpoint = scratch(spark, "once"), scratch(spark, "once-checkpoint")
    for _start in range(2):  # the second start finds everything done
        start_to_table(rows, path, checkpoint).awaitTermination()
    return read_batches(spark, path, rows.schema).drop("batch_id")


def _headers(spark, sf, shift=0):
    return read_table(spark, sf, "orders").select((F.col("o_orderkey") + shift).alias("id"), F.col("o_totalprice").alias("total_amount"), F.col("o_orderdate").alias("header_time"))


def _details(spark, sf):
    return read_table(spark, sf, "lineitem").selectExpr("l_orderkey AS order_id", "l_linenumber AS line", "l_partkey AS sku_id", "l_shipdate AS detail_time")


SIDES = ("id", "order_id", "header_time", "detail_time")


@query("cross_batch_order_state", """
    SELECT o_orderkey AS id, o_totalprice AS total_amount, l_partkey AS sku_id
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey""")
def _(spark, sf):
    pairs = meeting.met_in_parts(spark, _headers(spark, sf), _details(spark, sf), *SIDES, WAIT)
    return pairs.where(F.col("left").isNotNull() & F.col("right").isNotNull()).select("left.id", "left.total_amount", "right.sku_id")


@query("order_expiry_stream", f"""
    WITH headers AS (SELECT o_orderkey + 4 AS id, CAST(o_orderdate AS TIMESTAMP) AS header_time FROM orders),
    details AS (SELECT l_orderkey AS order_id, l_linenumber AS line, CAST(l_shipdate AS TIMESTAMP) AS detail_time FROM lineitem)
    SELECT id, order_id, line, CASE WHEN order_id IS NULL THEN 'left alone' WHEN id IS NULL THEN 'right alone' ELSE 'met' END AS outcome
    FROM headers FULL OUTER JOIN details ON id = order_id
        AND detail_time BETWEEN header_time - INTERVAL {WAIT_DAYS} DAY AND header_time + INTERVAL {WAIT_DAYS} DAY""")
def _(spark, sf):
    out = meeting.expired_in_parts(spark, _headers(spark, sf, 4), _details(spark, sf), *SIDES, WAIT)
    return out.select("left.id", "right.order_id", "right.line", "outcome")


@query("full_outer_orders_stream", ORACLES["full_outer_orders"])
def _(spark, sf):
    out = meeting.met_in_parts(spark, _headers(spark, sf, 4), _details(spark, sf), *SIDES, WAIT)
    return out.select(F.col("left.id").alias("header_id"), "left.total_amount", "right.order_id", "right.sku_id")


@query("sink_routed", f"SELECT CAST(seq AS VARCHAR) AS key, topic, value FROM ({CDC_FACTS})")
def _(spark, sf):
    facts = cdc.fact_changes(_change_stream(spark, sf), fact_tables(spark, sf))
    messages = sinks.routed(facts, F.col("topic"), F.col("value"), F.col("seq"))
    path = scratch(spark, "routed")
    sinks.sink_routed_files(messages, path, scratch(spark, "routed-checkpoint")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("key string, value string, topic string").parquet(path).select("key", "topic", "value")
