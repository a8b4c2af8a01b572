"""Daily active users: first page view per device and day, with user and province attributes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from streamloom.functions.clock import age_years, day_of, hour_of
from streamloom.operators.joins import dim_lookup
from streamloom.operators.project import filter_first_visit
from streamloom.operators.ranking import dedup_daily
from streamloom.schemas import DAU, copy_same_name


def user_attributes(today: Column, age_type: str = "string") -> dict[str, Column]:
    age = age_years(F.to_date("birthday"), today)
    return {"user_gender": F.col("gender"), "user_age": age.cast(age_type)}


def province_attributes(code_3166: str) -> dict[str, Column]:
    return {
        "province_name": F.col("name"), "province_iso_code": F.col("iso_code"),
        code_3166: F.col("iso_3166_2"), "province_area_code": F.col("area_code"),
    }


def enrich_visits(first: DataFrame, users: DataFrame, provinces: DataFrame, today: Column) -> DataFrame:
    """First visits → the 21-column record. ``users(id, gender, birthday)``, ``provinces(id, name, …)``."""
    rows = first.withColumns({"dt": day_of(F.col("ts")), "hr": hour_of(F.col("ts"))})
    rows = dim_lookup(rows, "user_id", users, "id", user_attributes(today))
    rows = dim_lookup(rows, "province_id", provinces, "id", province_attributes("province_3166_2"))
    return copy_same_name(rows, DAU)


def daily_active_users(page_log: DataFrame, users: DataFrame, provinces: DataFrame, today: Column) -> DataFrame:
    """Filter, then keep one row per device and day, then look up: later steps see few rows."""
    order = [F.col("ts"), *[F.col(c) for c in page_log.columns if c not in ("ts", "mid")]]
    first = dedup_daily(filter_first_visit(page_log), day_of(F.col("ts")), "mid", order)
    return enrich_visits(first, users, provinces, today)


def first_visits_stream(page_log: DataFrame, delay: str) -> DataFrame:
    """First visit per device and day of a stream: the row that ``daily_active_users`` keeps, once the watermark passes the day.

    ``delay`` is how much later than a later visit an earlier one may come; rows beyond it are dropped. State
    is one row per device and open day, and rows are reduced to that before they are shuffled, so a busy device costs no more than another.
    """
    order = ["ts", *[c for c in page_log.columns if c not in ("ts", "mid")]]
    timed = filter_first_visit(page_log).withColumn("event_time", F.timestamp_millis("ts")).withWatermark("event_time", delay)
    visits = timed.groupBy(F.window("event_time", "1 day").alias("day"), "mid").agg(F.min(F.struct(*order)).alias("visit"))
    return visits.select(*[F.col(c) if c == "mid" else F.col("visit")[c].alias(c) for c in page_log.columns])
