"""Sources, projections, filters, flat-maps, splits, unions, placement and table edits."""

from __future__ import annotations

from pyspark.sql import functions as F

from streamloom.catalog.registry import CLICKS, LINES, SENSORS, WORDS, query
from streamloom.functions.clock import epoch_ms
from streamloom.operators import placement, project, split_merge, table_edits
from streamloom.plans.derived import clicks, sensors
from streamloom.schemas import PAGE_LOG, copy_same_name
from streamloom.session import scratch
from streamloom.sources.collection import numbered
from streamloom.sources.files import parse_clicks, parse_sensors, read_table, read_text, scan_table_by_name

HOUR, DAY = 3_600_000, 86_400_000


# --- sources -----------------------------------------------------------------------------------

@query("scan_text", f"WITH {LINES} SELECT line AS value, count(*) AS n FROM lines GROUP BY line")
def _(spark, sf):
    path = scratch(spark, "text")
    project.text_lines(read_table(spark, sf, "documents"), "text").write.text(path)
    return read_text(spark, path).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


@query("parse_click_csv", f'WITH {CLICKS} SELECT seq, "user", url, ts_ms AS timestamp FROM clicks')
def _(spark, sf):
    lines = clicks(spark, sf).select("seq", F.concat_ws(",", "user", "url", "timestamp").alias("value"))
    return parse_clicks(lines)


@query("parse_sensor_line", f"WITH {SENSORS} SELECT seq, id, ts, vc FROM sensors")
def _(spark, sf):
    lines = sensors(spark, sf).select("seq", F.concat_ws(" ", "id", "ts", "vc").alias("value"))
    return parse_sensors(lines)


@query("sequence_source", "SELECT 'a:' || i AS value FROM range((SELECT count(*) FROM events)) t(i)")
def _(spark, sf):
    return numbered(spark, read_table(spark, sf, "events").count())


@query("scan_table_by_name", "SELECT c_custkey, c_name FROM customer")
def _(spark, sf):
    read_table(spark, sf, "customer").createOrReplaceTempView("loom_customer")
    return scan_table_by_name(spark, "loom_customer").select("c_custkey", "c_name")


# --- maps and filters --------------------------------------------------------------------------

@query("map_field", f'WITH {CLICKS} SELECT seq, "user" FROM clicks')
def _(spark, sf):
    return project.map_field(clicks(spark, sf), "user", "seq")


@query("map_url_length", f"WITH {CLICKS} SELECT seq, url, length(url) AS length FROM clicks")
def _(spark, sf):
    return project.map_length(clicks(spark, sf), "url", "seq")


@query("map_plus_one", "SELECT l_orderkey, l_partkey, l_quantity + 1 AS l_quantity FROM lineitem")
def _(spark, sf):
    return project.map_plus_one(read_table(spark, sf, "lineitem"), "l_quantity", "l_orderkey", "l_partkey")


@query("map_pair_one", f'WITH {CLICKS} SELECT seq, "user", 1 AS one FROM clicks')
def _(spark, sf):
    return project.map_pair_one(clicks(spark, sf), "user", "seq")


@query("filter_ignore_case", f"WITH {CLICKS} SELECT seq, url FROM clicks WHERE lower(url) = 'click'")
def _(spark, sf):
    return project.filter_ignore_case(clicks(spark, sf), "url", "CLICK").select("seq", "url")


@query("split_words", f"WITH {WORDS} SELECT doc_id, word FROM words")
def _(spark, sf):
    lines = project.text_lines(read_table(spark, sf, "documents"), "text", "doc_id")
    return project.split_words(lines, "line", "doc_id")


@query("flatmap_conditional", f"""
    WITH {SENSORS}
    SELECT seq, 0 AS pos, CASE id WHEN 's1' THEN CAST(vc AS VARCHAR) ELSE CAST(ts AS VARCHAR) END AS value
    FROM sensors WHERE id IN ('s1', 's2')
    UNION ALL SELECT seq, 1, CAST(vc AS VARCHAR) FROM sensors WHERE id = 's2'""")
def _(spark, sf):
    return project.flatmap_conditional(sensors(spark, sf), "id", "S1", "S2", "ts", "vc", "seq")


@query("process_emit", f"""
    WITH {CLICKS}, paired AS (
        SELECT seq, "user", 'Event{{user=''' || "user" || ''', url=''' || url || ''', timestamp=' || ts_ms || '}}' AS txt, url FROM clicks)
    SELECT seq, 0 AS pos, "user" || 'click' || url AS value FROM paired WHERE "user" IN ('7', '8')
    UNION ALL SELECT seq, CASE WHEN "user" IN ('7', '8') THEN 1 ELSE 0 END, txt FROM paired""")
def _(spark, sf):
    return project.process_emit(clicks(spark, sf), ["7", "8"], "seq")


@query("point_lookup", "SELECT * FROM customer WHERE c_custkey = 7 AND c_name = 'Customer#000000007'")
def _(spark, sf):
    return project.point_lookup(read_table(spark, sf, "customer"), c_custkey=7, c_name="Customer#000000007")


@query("like_contains", "SELECT * FROM part WHERE p_name LIKE '%ring%'")
def _(spark, sf):
    return project.like_contains(read_table(spark, sf, "part"), "p_name", "ring")


@query("select_star", "SELECT * FROM customer")
def _(spark, sf):
    return read_table(spark, sf, "customer")


@query("project_columns", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def _(spark, sf):
    return project.project_columns(read_table(spark, sf, "customer"), ["c_custkey", "c_name", "c_acctbal"])


@query("copy_same_name", """
    SELECT CAST(NULL AS VARCHAR) AS mid, CAST(user_id AS VARCHAR) AS user_id, CAST(NULL AS VARCHAR) AS province_id,
        CAST(NULL AS VARCHAR) AS channel, CAST(NULL AS VARCHAR) AS is_new, CAST(NULL AS VARCHAR) AS model,
        CAST(NULL AS VARCHAR) AS operate_system, CAST(NULL AS VARCHAR) AS version_code, event_type AS page_id,
        CAST(NULL AS VARCHAR) AS last_page_id, CAST(NULL AS VARCHAR) AS page_item, CAST(NULL AS VARCHAR) AS page_item_type,
        CAST(NULL AS BIGINT) AS during_time, epoch_us(ts) // 1000 AS ts FROM events""")
def _(spark, sf):
    rows = read_table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("user_id"), F.col("event_type").alias("page_id"),
        F.col("value").alias("during_time"), epoch_ms("ts").alias("ts"), "event_id",
    )
    return copy_same_name(rows, PAGE_LOG)


# --- splitting and merging ---------------------------------------------------------------------

@query("split_parity", """
    SELECT event_id, CASE event_id % 2 WHEN 0 THEN 'even' ELSE 'odd' END AS side FROM events WHERE event_id % 2 IN (0, 1)""")
def _(spark, sf):
    even, odd = split_merge.split_parity(read_table(spark, sf, "events").select("event_id"), "event_id")
    return even.withColumn("side", F.lit("even")).unionByName(odd.withColumn("side", F.lit("odd")))


@query("side_output", f"""
    WITH {CLICKS}
    SELECT seq, CASE WHEN "user" IN ('7', '8') THEN "user" ELSE 'else' END AS tag,
        CASE WHEN "user" IN ('7', '8') THEN url ELSE "user" END AS "first", url AS "second", ts_ms AS timestamp FROM clicks""")
def _(spark, sf):
    return split_merge.side_output(clicks(spark, sf), ["7", "8"], "seq")


@query("side_output_sensor", f"""
    WITH {SENSORS} SELECT seq, id, ts, vc, CASE WHEN id IN ('s1', 's2') THEN upper(id) ELSE 'main' END AS tag FROM sensors""")
def _(spark, sf):
    return split_merge.tag_rows(sensors(spark, sf), "id", ["S1", "S2"], "main", ignore_case=True)


@query("union_all", """
    SELECT o_custkey AS k FROM orders UNION ALL SELECT c_custkey FROM customer UNION ALL SELECT o_custkey FROM orders""")
def _(spark, sf):
    buyers = read_table(spark, sf, "orders").select(F.col("o_custkey").alias("k"))
    customers = read_table(spark, sf, "customer").select(F.col("c_custkey").alias("k"))
    return split_merge.union_all(buyers, customers, buyers)


@query("connect_map", """
    SELECT 'left' AS side, CAST(o_orderkey AS VARCHAR) AS value FROM orders
    UNION ALL SELECT 'right', c_name FROM customer""")
def _(spark, sf):
    return split_merge.connect_map(
        read_table(spark, sf, "orders"), F.col("o_orderkey"), read_table(spark, sf, "customer"), F.col("c_name")
    )


# --- placement: the rows stay the same ---------------------------------------------------------

_E = "SELECT event_id, user_id FROM events"


def _pairs(spark, sf):
    return read_table(spark, sf, "events").select("event_id", "user_id")


@query("part_shuffle", _E)
def _(spark, sf):
    return placement.shuffle(_pairs(spark, sf), 8, ["event_id"])


@query("part_rebalance", _E)
def _(spark, sf):
    return placement.rebalance(_pairs(spark, sf), 8)


@query("part_rescale", _E)
def _(spark, sf):
    return placement.rescale(_pairs(spark, sf), 2)


@query("part_broadcast", "SELECT event_id, user_id, target FROM events, (VALUES (0), (1), (2), (3)) t(target)")
def _(spark, sf):
    return placement.to_every(_pairs(spark, sf), 4)


@query("part_global", _E)
def _(spark, sf):
    return placement.global_order(_pairs(spark, sf), 8, "event_id")


@query("part_key", _E)
def _(spark, sf):
    return placement.by_key(_pairs(spark, sf), 8, "user_id")


@query("part_custom", "SELECT event_id, user_id, CAST(event_id % 4 AS INTEGER) AS placed FROM events")
def _(spark, sf):
    keyed = _pairs(spark, sf).withColumn("text_key", F.col("event_id").cast("string"))
    placed = placement.by_parsed_modulo(keyed, 4, "text_key").drop("text_key")
    return placed.withColumn("placed", F.spark_partition_id())


# --- table edits -------------------------------------------------------------------------------

@query("insert_row", """
    SELECT * FROM customer UNION ALL SELECT -1, 'Customer#new', 3, CAST(NULL AS DOUBLE), 'BUILDING'""")
def _(spark, sf):
    return table_edits.insert_row(
        read_table(spark, sf, "customer"), c_custkey=-1, c_name="Customer#new", c_nationkey=3, c_mktsegment="BUILDING"
    )


@query("update_where", """
    SELECT c_custkey, CASE WHEN c_nationkey = 3 THEN 'moved' ELSE c_name END AS c_name, c_nationkey, c_acctbal, c_mktsegment
    FROM customer""")
def _(spark, sf):
    return table_edits.update_where(read_table(spark, sf, "customer"), F.col("c_nationkey") == 3, c_name=F.lit("moved"))


@query("delete_where", "SELECT * FROM customer WHERE NOT coalesce(c_acctbal < 0, FALSE)")
def _(spark, sf):
    return table_edits.delete_where(read_table(spark, sf, "customer"), F.col("c_acctbal") < 0)


@query("delete_in", """
    SELECT * FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""")
def _(spark, sf):
    gone = read_table(spark, sf, "orders").filter("o_orderstatus = 'P'").select("o_custkey")
    return table_edits.delete_in(read_table(spark, sf, "customer"), "c_custkey", gone, "o_custkey")


@query("insert_overwrite", """
    SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier""")
def _(spark, sf):
    first, second = scratch(spark, "stage"), scratch(spark, "final")
    customers = read_table(spark, sf, "customer").selectExpr("c_custkey AS id", "c_name AS name")
    suppliers = read_table(spark, sf, "supplier").selectExpr("s_suppkey AS id", "s_name AS name")
    staged = table_edits.insert_overwrite(customers.unionByName(suppliers), first)
    return table_edits.insert_overwrite(staged, second)


_SETTLE = """purchases AS (
    SELECT o_custkey AS user_id, l_partkey AS book_id FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def _settled(spark, sf):
    purchases = (
        read_table(spark, sf, "lineitem").join(read_table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .select(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("book_id"))
    )
    books = read_table(spark, sf, "part").select(
        F.col("p_partkey").alias("book_id"), F.floor("p_retailprice").alias("price"),
        (F.col("p_size") * 100).cast("bigint").alias("stock"),
    )
    users = read_table(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_id"), (F.col("c_custkey") * 10 + 100_000).alias("balance")
    )
    return table_edits.settle_purchases(purchases, books, users)


@query("ledger_settle_stock", f"""
    WITH {_SETTLE}
    SELECT p_partkey AS book_id, CAST(floor(p_retailprice) AS BIGINT) AS price,
        CAST(p_size * 100 - coalesce(n, 0) AS BIGINT) AS stock
    FROM part LEFT JOIN (SELECT book_id, count(*) AS n FROM purchases GROUP BY 1) ON book_id = p_partkey""")
def _(spark, sf):
    return _settled(spark, sf)[0]


@query("ledger_settle_balance", f"""
    WITH {_SETTLE}
    SELECT c_custkey AS user_id, CAST(c_custkey * 10 + 100000 - coalesce(s, 0) AS BIGINT) AS balance
    FROM customer LEFT JOIN (
        SELECT user_id, sum(CAST(floor(p_retailprice) AS BIGINT)) AS s
        FROM purchases JOIN part ON book_id = p_partkey GROUP BY 1) ON user_id = c_custkey""")
def _(spark, sf):
    return _settled(spark, sf)[1]
