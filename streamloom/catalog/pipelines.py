"""Whole pipelines: log fan-out, change routing, daily active users, wide orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from streamloom.catalog.joins import AGE, PROVINCE_DIM, TODAY, USER_DIM
from streamloom.catalog.registry import ORACLES, query
from streamloom.operators.ranking import dedup_daily
from streamloom.operators.placement import over_all_cores
from streamloom.operators.project import filter_first_visit
from streamloom.functions.clock import day_of
from streamloom.plans import cdc, log_fanout
from streamloom.plans.dau import daily_active_users
from streamloom.plans.derived import changes, order_details_of, order_headers_of, province_dim, raw_logs, raw_logs_of, user_dim
from streamloom.plans.order_wide import order_wide
from streamloom.sources.files import read_table

_VISITOR = """'mid_' || user_id AS mid, CAST(user_id AS VARCHAR) AS user_id, CAST(user_id % 25 AS VARCHAR) AS province_id,
    'ch_' || (event_id % 3) AS channel, CAST(event_id % 2 AS VARCHAR) AS is_new, 'md_' || (user_id % 7) AS model,
    'os_' || (event_id % 2) AS operate_system, 'v' || (event_id % 5) AS version_code"""
_PAGE = """event_type AS page_id, CASE WHEN event_id % 3 <> 0 THEN 'home' END AS last_page_id,
    CAST(event_id % 100 AS VARCHAR) AS page_item, 'sku' AS page_item_type, event_id % 1000 AS during_time"""
_IS_PAGE = "event_type IN ('view', 'click', 'purchase')"
_NAMES = "mid, user_id, province_id, channel, is_new, model, operate_system, version_code"
_PAGE_NAMES = "page_id, last_page_id, page_item, page_item_type, during_time"

PAGE_LOG = f"page_log AS (SELECT {_VISITOR}, {_PAGE}, epoch_us(ts) // 1000 AS ts FROM events WHERE {_IS_PAGE})"


def _displays(which: str) -> str:
    return f"""
    SELECT {_VISITOR}, {_PAGE}, 'promo' AS display_type, CAST((event_id + i) % 100 AS VARCHAR) AS display_item,
        'sku' AS display_item_type, CAST(i AS VARCHAR) AS display_order, 'pos_' || i AS display_pos_id, epoch_us(ts) // 1000 AS ts
    FROM (SELECT *, unnest(range(1, event_id % 4 + 1)) AS i FROM events WHERE {which})"""


def _logs(spark, sf, parts=log_fanout.PAGE_PARTS):
    return log_fanout.parse_logs(raw_logs(spark, sf), *parts)


@query("log_error", """
    SELECT event_id % 7 AS error_code, 'failed' AS msg FROM events WHERE event_type = 'error'""")
def _(spark, sf):
    err = F.from_json("err", "error_code bigint, msg string")
    return log_fanout.log_error(_logs(spark, sf, ["err"])).select(err.alias("e")).select("e.*")


@query("log_page", f"WITH {PAGE_LOG} SELECT * FROM page_log")
def _(spark, sf):
    return log_fanout.log_page(_logs(spark, sf))


@query("log_action", f"""
    SELECT {_VISITOR}, {_PAGE}, 'act_' || i AS action_id, CAST(event_id % 100 AS VARCHAR) AS action_item,
        'sku' AS action_item_type, (epoch_us(ts) // 1000) + i AS ts
    FROM (SELECT *, unnest(CASE event_type WHEN 'click' THEN [1] ELSE [1, 2] END) AS i
          FROM events WHERE event_type IN ('click', 'purchase'))""")
def _(spark, sf):
    return log_fanout.log_action(_logs(spark, sf, log_fanout.ACTION_PARTS))


@query("log_display", _displays("event_type IN ('click', 'purchase')"))
def _(spark, sf):
    return log_fanout.log_display(_logs(spark, sf, log_fanout.DISPLAY_PARTS))


@query("log_display_all", _displays(_IS_PAGE))
def _(spark, sf):
    return log_fanout.log_display_all(_logs(spark, sf, log_fanout.DISPLAY_PARTS))


@query("log_start", f"""
    SELECT {_VISITOR}, 'icon' AS entry, 'ad_' || (event_id % 20) AS open_ad_id, event_id % 500 AS loading_time_ms,
        event_id % 300 AS open_ad_ms, event_id % 50 AS open_ad_skip_ms, epoch_us(ts) // 1000 AS ts
    FROM events WHERE event_type <> 'error' AND (event_type = 'signup' OR event_id % 10 = 0)""")
def _(spark, sf):
    return log_fanout.log_start(_logs(spark, sf, log_fanout.START_PARTS))


_OUTPUTS = {"error": "log_error", "page": "log_page", "action": "log_action", "display": "log_display", "start": "log_start"}
#: Every message with all its fields: each output's own SQL, side by side under its topic.
LOG_MESSAGES = " UNION ALL BY NAME ".join(f"(SELECT '{log_fanout.TOPICS[output]}' AS topic, * FROM ({ORACLES[name]}))" for output, name in _OUTPUTS.items())

_MESSAGE = (
    ", ".join(f"{name} string" for name in f"{_NAMES}, page_id, last_page_id, page_item, page_item_type".split(", "))
    + ", during_time bigint, action_id string, action_item string, action_item_type string"
    + ", display_type string, display_item string, display_item_type string, display_order string, display_pos_id string"
    + ", entry string, open_ad_id string, loading_time_ms bigint, open_ad_ms bigint, open_ad_skip_ms bigint, error_code bigint, msg string, ts bigint"
)


def read_messages(messages):
    """What a consumer reads out of the messages: ``topic`` and the fields of all topics, NULL where a topic has none."""
    return messages.select("topic", F.from_json("value", _MESSAGE).alias("m")).select("topic", "m.*")


@query("log_fanout", LOG_MESSAGES)
def _(spark, sf):
    events = over_all_cores(read_table(spark, sf, "events"))
    return read_messages(log_fanout.route_logs(raw_logs_of(events)))


# --- change routing ----------------------------------------------------------------------------

def fact_tables(spark, sf):
    """The fact-table list, kept in a table and read for every run."""
    return read_table(spark, sf, "region").selectExpr(
        "CASE r_regionkey WHEN 0 THEN 'order_info' ELSE concat('fact_', r_regionkey) END AS name")


def dim_tables(spark, sf):
    return read_table(spark, sf, "region").selectExpr(
        "CASE r_regionkey WHEN 0 THEN 'user_info' WHEN 1 THEN 'base_province' ELSE concat('dim_', r_regionkey) END AS name")


CDC_FACTS = """
    SELECT o_orderkey AS seq, 'DWD_ORDER_INFO_' || CASE o_orderkey % 5 WHEN 1 THEN 'U' WHEN 2 THEN 'D' ELSE 'I' END AS topic,
        '{"id":' || o_orderkey || ',"user_id":' || o_custkey || ',"order_status":"' || o_orderstatus || '","total_amount":' || CAST(o_totalprice AS DECIMAL(15,2)) || '}' AS value
    FROM orders WHERE o_orderkey % 5 <> 4"""


@query("cdc_route", CDC_FACTS)
def _(spark, sf):
    return cdc.fact_changes(cdc.parse_changes(changes(spark, sf)), fact_tables(spark, sf))


@query("dim_upsert", f"""
    WITH {USER_DIM}
    SELECT 'DIM_USER_INFO_' || c_custkey AS key, '{{"id":' || c_custkey || ',"name":"' || c_name || '","version":'
        || CASE WHEN c_custkey % 3 = 0 THEN 2 ELSE 1 END || ',"gender":"' || gender || '","birthday":"' || strftime(born, '%Y-%m-%d') || '"}}' AS value
    FROM customer JOIN users ON uid = c_custkey
    UNION ALL
    SELECT 'DIM_BASE_PROVINCE_' || n_nationkey, '{{"id":' || n_nationkey || ',"name":"' || n_name || '","iso_code":"ISO-' || n_nationkey
        || '","iso_3166_2":"X-' || n_nationkey || '","area_code":"R' || n_regionkey || '-' || n_nationkey || '"}}' FROM nation""")
def _(spark, sf):
    keyed = cdc.dim_changes(cdc.parse_changes(changes(spark, sf)), dim_tables(spark, sf))
    return cdc.dim_snapshot(keyed)


# --- daily active users ------------------------------------------------------------------------

@query("filter_first_visit", f"WITH {PAGE_LOG} SELECT * FROM page_log WHERE last_page_id IS NULL AND ts <> 0")
def _(spark, sf):
    return filter_first_visit(log_fanout.log_page(_logs(spark, sf)))


FIRST = f"""{PAGE_LOG}, first_visit AS (
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY mid, ts // 86400000 ORDER BY ts, user_id, province_id, channel, is_new, model,
            operate_system, version_code, page_id, last_page_id, page_item, page_item_type, during_time) AS rn
        FROM page_log WHERE last_page_id IS NULL AND ts <> 0) WHERE rn = 1)"""


@query("dedup_daily", f"WITH {FIRST} SELECT * FROM first_visit")
def _(spark, sf):
    pages = filter_first_visit(log_fanout.log_page(_logs(spark, sf)))
    return dedup_daily(pages, day_of(F.col("ts")), "mid", [F.col("ts"), F.col("page_id"), F.col("during_time")])


DAU = f"""
    WITH {FIRST}, {USER_DIM}, {PROVINCE_DIM}
    SELECT {_NAMES}, page_id, page_item, page_item_type, during_time, gender AS user_gender,
        CAST(CAST({AGE} AS BIGINT) AS VARCHAR) AS user_age, province_name, province_iso_code, province_3166 AS province_3166_2,
        province_area_code, strftime(make_timestamp(ts * 1000), '%Y-%m-%d') AS dt, strftime(make_timestamp(ts * 1000), '%H') AS hr, ts
    FROM first_visit LEFT JOIN users ON user_id = CAST(uid AS VARCHAR) LEFT JOIN provinces ON province_id = CAST(pid AS VARCHAR)"""


@query("dau", DAU)
def _(spark, sf):
    pages = log_fanout.log_page(_logs(spark, sf))
    return daily_active_users(pages, user_dim(spark, sf), province_dim(spark, sf), F.lit(TODAY).cast("date"))


# --- wide orders -------------------------------------------------------------------------------

ORDER_WIDE = f"""
    WITH {USER_DIM}, {PROVINCE_DIM}
    SELECT l_orderkey * 10 + l_linenumber AS detail_id, o_orderkey AS order_id, l_partkey AS sku_id, l_extendedprice AS order_price,
        CAST(l_quantity AS BIGINT) AS sku_num, 'sku_' || l_partkey AS sku_name, l_extendedprice AS split_total_amount,
        CAST(0 AS DOUBLE) AS split_activity_amount, CAST(0 AS DOUBLE) AS split_coupon_amount, o_custkey % 30 AS province_id,
        o_orderstatus AS order_status, o_custkey AS user_id, o_totalprice AS total_amount, CAST(0 AS DOUBLE) AS activity_reduce_amount,
        CAST(0 AS DOUBLE) AS coupon_reduce_amount, o_totalprice AS original_total_amount, CAST(0 AS DOUBLE) AS feight_fee,
        CAST(0 AS DOUBLE) AS feight_fee_reduce, CAST(NULL AS VARCHAR) AS expire_time, CAST(NULL AS VARCHAR) AS refundable_time,
        strftime(l_shipdate, '%Y-%m-%d') || ' 08:30:00' AS create_time, CAST(NULL AS VARCHAR) AS operate_time,
        strftime(o_orderdate, '%Y-%m-%d') AS create_date, lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') AS create_hour,
        province_name, province_area_code, province_3166 AS province_3166_2_code, province_iso_code,
        CAST({AGE} AS INTEGER) AS user_age, gender AS user_gender
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey LEFT JOIN users ON o_custkey = uid LEFT JOIN provinces ON o_custkey % 30 = pid"""


@query("order_wide", ORDER_WIDE)
def _(spark, sf):
    return order_wide(
        order_headers_of(read_table(spark, sf, "orders")), order_details_of(read_table(spark, sf, "lineitem")),
        user_dim(spark, sf), province_dim(spark, sf), F.lit(TODAY).cast("date"),
    )
