"""Joins and dimension look-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from streamloom.catalog.registry import query
from streamloom.operators import joins
from streamloom.plans.cdc import parse_changes
from streamloom.plans.dau import province_attributes, user_attributes
from streamloom.plans.derived import changes, order_details_of, order_headers_of, province_dim, user_dim
from streamloom.sources.files import read_table

TODAY = "2024-02-01"

AGE = f"""(date_part('year', DATE '{TODAY}') - date_part('year', born)
    - CASE WHEN strftime(DATE '{TODAY}', '%m%d') < strftime(born, '%m%d') THEN 1 ELSE 0 END)"""
USER_DIM = """users AS (
    SELECT c_custkey AS uid, CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
        DATE '1960-01-01' + CAST(c_custkey * 37 % 15000 AS INTEGER) AS born FROM customer)"""
PROVINCE_DIM = """provinces AS (
    SELECT n_nationkey AS pid, n_name AS province_name, 'ISO-' || n_nationkey AS province_iso_code,
        'X-' || n_nationkey AS province_3166, 'R' || n_regionkey || '-' || n_nationkey AS province_area_code FROM nation)"""


@query("connect_keyed_join", """
    SELECT o_orderkey AS id, o_orderpriority AS a, l_partkey AS b, l_linenumber AS n,
        CASE WHEN epoch_ms(o_orderdate) > epoch_ms(l_shipdate) THEN 'left' ELSE 'right' END AS later_side
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey""")
def _(spark, sf):
    left = read_table(spark, sf, "orders").selectExpr("o_orderkey AS id", "o_orderpriority AS a", "o_orderdate AS left_seq")
    right = read_table(spark, sf, "lineitem").selectExpr("l_orderkey AS id", "l_partkey AS b", "l_linenumber AS n", "l_shipdate AS right_seq")
    return joins.connect_keyed_join(left, right, "id", "left_seq", "right_seq").drop("left_seq", "right_seq")


@query("order_wide_join", """
    SELECT o_orderkey AS id, o_totalprice AS total_amount, l_orderkey * 10 + l_linenumber AS detail_id, l_partkey AS sku_id
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey""")
def _(spark, sf):
    headers = order_headers_of(read_table(spark, sf, "orders")).select("id", "total_amount")
    details = order_details_of(read_table(spark, sf, "lineitem")).withColumnRenamed("id", "detail_id")
    pair = joins.join_on(headers, details, headers["id"] == details["order_id"])
    return pair.select("id", "total_amount", "detail_id", "sku_id")


@query("full_outer_orders", """
    SELECT o_orderkey AS header_id, o_totalprice AS total_amount, l_orderkey AS order_id, l_partkey AS sku_id
    FROM (SELECT o_orderkey + 4 AS o_orderkey, o_totalprice FROM orders) FULL OUTER JOIN lineitem ON o_orderkey = l_orderkey""")
def _(spark, sf):
    # Header keys are shifted, so that either side has keys without a partner.
    headers = order_headers_of(read_table(spark, sf, "orders")).selectExpr("id + 4 AS id", "total_amount")
    details = order_details_of(read_table(spark, sf, "lineitem")).select("order_id", "sku_id")
    return joins.full_outer_orders(headers, details).withColumnRenamed("id", "header_id")


@query("dim_lookup_user", f"""
    WITH {USER_DIM}
    SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, gender AS user_gender, CAST(CAST({AGE} AS BIGINT) AS VARCHAR) AS user_age
    FROM events LEFT JOIN users ON user_id = uid + 2""")
def _(spark, sf):
    facts = read_table(spark, sf, "events").select("event_id", F.col("user_id").cast("string").alias("user_id"))
    users = user_dim(spark, sf).withColumn("id", (F.col("id").cast("long") + 2).cast("string"))  # the lowest users have no row
    return joins.dim_lookup(facts, "user_id", users, "id", user_attributes(F.lit(TODAY).cast("date")))


@query("dim_lookup_province", f"""
    WITH {PROVINCE_DIM}
    SELECT c_custkey, c_nationkey, r_name, province_name, province_iso_code, province_3166 AS province_3166_2, province_area_code
    FROM customer LEFT JOIN provinces ON c_nationkey = pid + 2
    LEFT JOIN (SELECT n_nationkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey) ON c_nationkey = n_nationkey""")
def _(spark, sf):
    nation, region = read_table(spark, sf, "nation"), read_table(spark, sf, "region")
    regions = nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select("n_nationkey", "r_name")
    facts = read_table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    provinces = province_dim(spark, sf).withColumn("id", F.col("id").cast("int") + 2)  # two provinces have no row
    rows = joins.dim_lookup(facts, "c_nationkey", regions, "n_nationkey", {"r_name": F.col("r_name")})
    return joins.dim_lookup(rows, "c_nationkey", provinces, "id", province_attributes("province_3166_2"))


@query("df_join_using", "SELECT o_custkey AS username, o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey")
def _(spark, sf):
    orders = read_table(spark, sf, "orders").selectExpr("o_custkey AS username", "o_orderkey")
    customers = read_table(spark, sf, "customer").selectExpr("c_custkey AS username", "c_name")
    return joins.join_using(orders, customers, ["username", "username"])


@query("df_join_expr", "SELECT o_custkey, c_custkey, o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey")
def _(spark, sf):
    orders = read_table(spark, sf, "orders").select("o_custkey", "o_orderkey")
    customers = read_table(spark, sf, "customer").select("c_custkey", "c_name")
    return joins.join_on(orders, customers, orders["o_custkey"] == customers["c_custkey"])


_ONE = """
    SELECT c_custkey, c_name, n_nationkey + 2 AS cid, n_name AS class_name
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey + 2"""


def _customers_and_nations(spark, sf):
    customers = read_table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    nations = read_table(spark, sf, "nation").selectExpr("n_nationkey + 2 AS cid", "n_name AS class_name")
    return customers, nations


@query("left_join_one", _ONE)
def _(spark, sf):
    customers, nations = _customers_and_nations(spark, sf)
    nested = joins.left_join_one(customers, nations, "c_nationkey", "cid", "class")
    return nested.select("c_custkey", "c_name", "class.cid", "class.class_name")


@query("step_association", """
    SELECT n_nationkey + 2 AS cid, n_name AS class_name,
        coalesce(list({'c_custkey': c_custkey, 'c_name': c_name} ORDER BY c_custkey) FILTER (c_custkey IS NOT NULL), []) AS students
    FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey + 2 GROUP BY ALL""")
def _(spark, sf):
    customers, nations = _customers_and_nations(spark, sf)
    return joins.left_join_list(nations, customers, "cid", "c_nationkey", "c_custkey", "students")


@query("left_join_many", """
    SELECT n_nationkey + 2 AS cid, n_name AS class_name, c_custkey // 1000 AS slice,
        coalesce(string_agg(c_custkey || ':' || c_name, ',' ORDER BY c_custkey), '') AS students
    FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey + 2
    GROUP BY ALL""")
def _(spark, sf):
    customers, nations = _customers_and_nations(spark, sf)
    nested = joins.left_join_many(nations, customers, "cid", "c_nationkey", "c_custkey", "students", slice_ids=1000)
    as_text = F.transform("students", lambda s: F.concat(s["c_custkey"], F.lit(":"), s["c_name"]))
    return nested.withColumn("students", F.array_join(as_text, ","))


@query("table_list_semi", """
    SELECT o_orderkey AS seq, 'order_info' AS "table" FROM orders WHERE o_orderkey % 5 <> 4""")
def _(spark, sf):
    rows = parse_changes(changes(spark, sf)).select("seq", "table")
    listed = read_table(spark, sf, "region").selectExpr(
        "CASE r_regionkey WHEN 0 THEN 'order_info' ELSE concat('other_', r_regionkey) END AS name"
    )
    return joins.keep_listed(rows, "table", listed, "name")
