"""Small in-memory rows and numbered sequences."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType


def from_rows(spark: SparkSession, rows: Iterable[Sequence], schema: StructType | str) -> DataFrame:
    """In-memory rows; ``seq`` keeps the order in which they were given."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    numbered = [(*row, i) for i, row in enumerate(rows)]
    return spark.createDataFrame(numbered, StructType([*schema.fields, StructField("seq", LongType())]))


def numbered(spark: SparkSession, n: int, prefix: str = "a:") -> DataFrame:
    """``n`` rows ``prefix0 … prefix(n-1)``."""
    return spark.range(n).select(F.concat(F.lit(prefix), F.col("id")).alias("value"))


def numbered_with_time(spark: SparkSession, n: int, now: Column | None = None) -> DataFrame:
    """``n`` rows ``number: i  time: yyyy-MM-dd HH:mm:ss``."""
    now = F.current_timestamp() if now is None else now
    clock = F.date_format(now, "yyyy-MM-dd HH:mm:ss")
    return spark.range(n).select(
        F.concat(F.lit("number: "), F.col("id"), F.lit("  time: "), clock).alias("value")
    )


def numbered_stream(spark: SparkSession, rows_per_batch: int, prefix: str = "a:") -> DataFrame:
    """An endless numbered stream with a fixed number of rows per micro-batch."""
    rows = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", rows_per_batch).load()
    return rows.select(F.concat(F.lit(prefix), F.col("value")).alias("value"))
