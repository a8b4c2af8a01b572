"""Grouped aggregates. All of them combine on the map side before the shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from streamloom.operators.project import split_words


def word_count(df: DataFrame, line: str = "value") -> DataFrame:
    return split_words(df, line).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def count_all(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def group_sum_one(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(F.lit(1)).alias("n"))


def uv_distinct(df: DataFrame, user: str, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count_distinct(user).alias("uv"))


def uv_approx(df: DataFrame, user: str, *keys: str, error: float = 0.02) -> DataFrame:
    """Distinct users by sketch: one small state per group whatever the number of users."""
    return df.groupBy(*keys).agg(F.approx_count_distinct(user, error).alias("uv"))


def pv_uv_ratio(df: DataFrame, user: str, *keys: str) -> DataFrame:
    """Views, distinct users and views per user.

    Users are counted in two steps (per user, then per group), so a hot group is reduced to its users
    before it meets in one place.
    """
    per_user = df.groupBy(*keys, user).agg(F.count(F.lit(1)).alias("__n"))
    out = per_user.groupBy(*keys).agg(F.sum("__n").alias("pv"), F.count(user).alias("uv"))
    return out.withColumn("ratio", F.try_divide(F.col("pv").cast("double"), F.col("uv").cast("double")))


def rows_by_key(df: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """One row per key: the last one in ``seq`` order.

    The rank filter is pushed below the shuffle, so each task sends at most one row per key.
    """
    from streamloom.operators.ranking import first_per_key

    return first_per_key(df, keys, [F.col(seq).desc()])
