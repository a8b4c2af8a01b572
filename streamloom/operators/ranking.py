"""Sorting, first-per-key and top-n."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """First ``n`` rows per key; Spark keeps at most ``n`` rows per key and task before the shuffle."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return top_per_key(df, keys, order, 1, "__rank").drop("__rank")


def sort_desc(counts: DataFrame, count: str = "count", tie: str = "url") -> DataFrame:
    """Total order by count, largest first; equal counts by ``tie``."""
    return counts.orderBy(F.col(count).desc(), F.col(tie).asc())


def topn_per_window(counts: DataFrame, n: int) -> DataFrame:
    """The ``n`` most frequent urls of each window; equal counts by url. Fewer urls give fewer rows."""
    return top_per_key(counts, ["win_start", "win_end"], [F.col("count").desc(), F.col("url").asc()], n)


def dedup_daily(df: DataFrame, day: Column, device: str, order: list[Column]) -> DataFrame:
    """First record per day and device."""
    return first_per_key(df.withColumn("__day", day), ["__day", device], order).drop("__day")
