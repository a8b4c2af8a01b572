"""Splitting one stream into several and merging several into one."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from streamloom.functions import text


def split_parity(df: DataFrame, number: str) -> tuple[DataFrame, DataFrame]:
    """Even and odd rows; the remainder keeps its sign, so negative odd numbers are in neither."""
    return df.filter(F.col(number) % 2 == 0), df.filter(F.col(number) % 2 == 1)


def tag_rows(df: DataFrame, field: str, tags: list[str], rest: str, ignore_case: bool = False) -> DataFrame:
    """One pass over the rows: ``tag`` is the matching value or ``rest``."""
    def matches(value: str) -> Column:
        return text.equal_ignore_case(F.col(field), F.lit(value)) if ignore_case else F.col(field) == value

    tag = reduce(lambda case, value: case.when(matches(value), value), tags[1:], F.when(matches(tags[0]), tags[0]))
    return df.withColumn("tag", tag.otherwise(rest))


def side_output(clicks: DataFrame, users: list[str], *keep: str, rest: str = "else") -> DataFrame:
    """Tagged clicks: side rows carry the url twice, the rest keep user and url."""
    tagged = tag_rows(clicks, "user", users, rest)
    return tagged.select(
        *keep, "tag",
        F.when(F.col("tag") == rest, F.col("user")).otherwise(F.col("url")).alias("first"),
        F.col("url").alias("second"), "timestamp",
    )


def union_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of all inputs, duplicates kept."""
    return reduce(DataFrame.unionByName, others, first)


def connect_map(left: DataFrame, left_value: Column, right: DataFrame, right_value: Column) -> DataFrame:
    """Two inputs of different types, each mapped to text."""
    return left.select(F.lit("left").alias("side"), left_value.cast("string").alias("value")).unionByName(
        right.select(F.lit("right").alias("side"), right_value.cast("string").alias("value"))
    )
