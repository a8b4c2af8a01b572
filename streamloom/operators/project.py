"""Record-by-record transforms: maps, filters and flat-maps."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from streamloom.functions import text
from streamloom.shipping import ship_by_value

ship_by_value(__name__)


def map_field(df: DataFrame, field: str, *keep: str) -> DataFrame:
    return df.select(*keep, field)


def map_length(df: DataFrame, field: str, *keep: str) -> DataFrame:
    return df.select(*keep, field, F.length(field).alias("length"))


def map_plus_one(df: DataFrame, field: str, *keep: str) -> DataFrame:
    return df.select(*keep, (F.col(field) + 1).alias(field))


def map_with_resource(
    df: DataFrame, open_resource: Callable[[], object], apply: Callable[[object, pd.DataFrame], pd.DataFrame],
    close_resource: Callable[[object], None], schema: str,
) -> DataFrame:
    """Arrow batches through ``apply`` with a resource opened and closed once per task."""

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resource = open_resource()
        try:
            for batch in batches:
                yield apply(resource, batch)
        finally:
            close_resource(resource)

    return df.mapInPandas(task, schema)


def map_pair_one(df: DataFrame, field: str, *keep: str) -> DataFrame:
    return df.select(*keep, field, F.lit(1).alias("one"))


def filter_ignore_case(df: DataFrame, field: str, value: str) -> DataFrame:
    return df.filter(text.equal_ignore_case(F.col(field), F.lit(value)))


def filter_first_visit(page_log: DataFrame) -> DataFrame:
    """Page views that open a visit and carry a time."""
    return page_log.filter(F.col("last_page_id").isNull() & (F.col("ts") != 0))


def split_words(df: DataFrame, line: str, *keep: str) -> DataFrame:
    return df.select(*keep, F.explode(text.words(F.col(line))).alias("word"))


def text_lines(df: DataFrame, column: str, *keep: str) -> DataFrame:
    """One row per line of a whole text."""
    return df.select(*keep, F.explode(text.lines(F.col(column))).alias("line"))


def flatmap_conditional(df: DataFrame, id_col: str, first: str, second: str, ts: str, vc: str, *keep: str) -> DataFrame:
    """``first`` ids give their reading, ``second`` ids time and reading, all others nothing."""
    def same(value: str) -> Column:
        return text.equal_ignore_case(F.col(id_col), F.lit(value))

    reading, time = F.col(vc).cast("string"), F.col(ts).cast("string")
    out = F.when(same(first), F.array(reading)).when(same(second), F.array(time, reading))
    return df.select(*keep, F.posexplode(out).alias("pos", "value"))


def process_emit(df: DataFrame, users: list[str], *keep: str) -> DataFrame:
    """Each event as text; for the named users a ``<user>click<url>`` row comes first."""
    as_text = F.concat(
        F.lit("Event{user='"), F.col("user"), F.lit("', url='"), F.col("url"),
        F.lit("', timestamp="), F.col("timestamp"), F.lit("}"),
    )
    click = F.concat(F.col("user"), F.lit("click"), F.col("url"))
    out = F.when(F.col("user").isin(users), F.array(click, as_text)).otherwise(F.array(as_text))
    return df.select(*keep, F.posexplode(out).alias("pos", "value"))


def point_lookup(df: DataFrame, **equal) -> DataFrame:
    """Rows whose named columns equal the given values."""
    for name, value in equal.items():
        df = df.filter(F.col(name) == F.lit(value))
    return df


def like_contains(df: DataFrame, field: str, part: str) -> DataFrame:
    """``field LIKE '%part%'``; ``%`` and ``_`` inside ``part`` stay wildcards."""
    return df.filter(F.col(field).like(f"%{part}%"))


def project_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*columns)
