"""Order headers with dimensions, joined to their details: one wide row per detail."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from streamloom.functions.clock import date_text_part, hour_text_part
from streamloom.operators.joins import dim_lookup
from streamloom.plans.dau import province_attributes, user_attributes
from streamloom.schemas import ORDER_INFO, ORDER_WIDE, copy_same_name
from streamloom.streaming.meeting import met_in_parts

_LOOKED_UP = [
    "create_date", "create_hour", "province_name", "province_area_code", "province_3166_2_code",
    "province_iso_code", "user_age", "user_gender",
]


def enrich_orders(orders: DataFrame, users: DataFrame, provinces: DataFrame, today: Column) -> DataFrame:
    """Fill user, province and date columns of order headers. Batch or streaming."""
    rows = orders.drop(*_LOOKED_UP).withColumns(
        {"create_date": date_text_part(F.col("create_time")), "create_hour": hour_text_part(F.col("create_time"))}
    )
    users = users.withColumn("id", F.col("id").cast("bigint"))
    provinces = provinces.withColumn("id", F.col("id").cast("bigint"))
    rows = dim_lookup(rows, "user_id", users, "id", user_attributes(today, "int"))
    return dim_lookup(rows, "province_id", provinces, "id", province_attributes("province_3166_2_code"))


def merge_order(pair: DataFrame) -> DataFrame:
    """Joined header and detail columns → the 30-column record.

    Both sides have ``id`` and ``create_time``; the detail's ``create_time`` wins.
    """
    return copy_same_name(pair, ORDER_WIDE)


def _detail_side(details: DataFrame) -> DataFrame:
    return details.withColumnRenamed("id", "detail_id")


def order_wide(orders: DataFrame, details: DataFrame, users: DataFrame, provinces: DataFrame, today: Column) -> DataFrame:
    """Only headers and details that have a partner are kept."""
    headers = copy_same_name(enrich_orders(orders, users, provinces, today), ORDER_INFO).drop("create_time")
    pair = headers.join(_detail_side(details), headers["id"] == F.col("order_id"), "inner")
    return merge_order(pair)


def order_wide_stream(
    spark: SparkSession, orders: DataFrame, details: DataFrame, users: DataFrame, provinces: DataFrame, today: Column, within: str, parts: int = 3,
) -> DataFrame:
    """Stream form over tables fed in time order: a row waits ``within`` in state for its partner, and pairs further apart are settled in batch."""
    time = "yyyy-MM-dd HH:mm:ss"
    headers = copy_same_name(enrich_orders(orders, users, provinces, today), ORDER_INFO).withColumn("header_time", F.to_timestamp("create_time", time)).drop("create_time")
    lines = _detail_side(details).withColumn("detail_time", F.to_timestamp("create_time", time))
    pairs = met_in_parts(spark, headers, lines, "id", "order_id", "header_time", "detail_time", within, parts=parts)
    return merge_order(pairs.where(F.col("left").isNotNull() & F.col("right").isNotNull()).select("left.*", "right.*").drop("header_time", "detail_time"))
