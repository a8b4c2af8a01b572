"""Streams whose reference tables change while they run; the SQL says which version each part of the input must have met."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from streamloom.catalog.pipelines import CDC_FACTS
from streamloom.catalog.registry import query
from streamloom.operators.joins import dim_lookup
from streamloom.plans import cdc
from streamloom.plans.derived import changes, clicks_of
from streamloom.session import scratch
from streamloom.sources.files import read_table
from streamloom.streaming.run import feed_in_order
from streamloom.streaming.versions import VersionedTable, start_versioned

PARTS = 4


def _part(seq: str) -> str:
    """The part a row is fed in, in SQL over all rows that are fed."""
    return f"({seq} - min({seq}) OVER ()) * {PARTS} // (max({seq}) OVER () - min({seq}) OVER () + 1)"


@query("cdc_route_versions_stream", f"""
    WITH fed AS (
        SELECT o_orderkey AS seq, 'orders' AS kind FROM orders
        UNION ALL SELECT c_custkey * 3 + v, 'users' FROM (SELECT c_custkey, unnest(CASE WHEN c_custkey % 3 = 0 THEN [0, 1, 2] ELSE [0, 1] END) AS v FROM customer)
        UNION ALL SELECT n_nationkey, 'provinces' FROM nation UNION ALL SELECT p_partkey, 'skus' FROM part),
    parts AS (SELECT *, {_part("seq")} AS part FROM fed)
    SELECT seq, topic, value FROM ({CDC_FACTS})
    UNION ALL SELECT p_partkey, 'DWD_SKU_INFO_I', '{{"id":' || p_partkey || ',"name":"' || p_name || '"}}'
    FROM part JOIN parts ON p_partkey = seq AND kind = 'skus' WHERE part >= 1""")
def _(spark, sf):
    """Parts are no facts at first; their table is on the list from the second part of the feed on."""
    lists = VersionedTable(spark, scratch(spark, "fact-lists"), "name string")
    names = read_table(spark, sf, "region").selectExpr("r_regionkey", "CASE r_regionkey WHEN 0 THEN 'order_info' WHEN 1 THEN 'sku_info' ELSE concat('fact_', r_regionkey) END AS name")
    route = lambda batch, listed: cdc.fact_changes(cdc.parse_changes(batch), listed)
    return feed_in_order(
        spark, [(changes(spark, sf), "seq")], PARTS, lambda raw: raw, start=partial(start_versioned, reference=lists, work=route),
        schema="seq bigint, topic string, value string", before=lambda part: lists.publish(names.where(F.col("r_regionkey") <= part).select("name")),
    ).drop("batch_id")


@query("dim_lookup_versions_stream", f"""
    WITH clicks AS (SELECT event_id AS seq, user_id, epoch_us(ts) // 1000 AS ts_ms FROM events),
    parts AS (SELECT *, {_part("ts_ms")} AS part FROM clicks)
    SELECT seq, CAST(user_id AS VARCHAR) AS user_id, CASE WHEN (c_custkey + CAST(c_custkey % 4 < part AS INTEGER)) % 2 = 0 THEN 'M' ELSE 'F' END AS user_gender
    FROM parts LEFT JOIN customer ON user_id = c_custkey""")
def _(spark, sf):
    """Users change before every part of the feed; a click sees its user as of its micro-batch."""
    users = VersionedTable(spark, scratch(spark, "users"), "id string, gender string")
    key = F.col("c_custkey")

    def publish(part: int) -> None:
        gender = F.when((key + (key % 4 < part).cast("int")) % 2 == 0, "M").otherwise("F")
        users.publish(read_table(spark, sf, "customer").select(key.cast("string").alias("id"), gender.alias("gender")))

    events = read_table(spark, sf, "events")
    clicks = events.select(F.col("event_id").alias("seq"), F.col("user_id").cast("string").alias("user_id"), F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"))
    look_up = lambda batch, dim: dim_lookup(batch.select("seq", "user_id"), "user_id", dim, "id", {"user_gender": F.col("gender")})
    return feed_in_order(
        spark, [(clicks, "ms")], PARTS, lambda rows: rows, start=partial(start_versioned, reference=users, work=look_up),
        schema="seq bigint, user_id string, user_gender string", before=publish,
    ).drop("batch_id")
