"""File sources, as batch or streaming DataFrames."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from streamloom.schemas import CLICK

_NAME = re.compile(r"[A-Za-z_]\w*(\.[A-Za-z_]\w*){0,2}")


def read_text(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """One row (``value``) per line of the text files under ``path``."""
    reader = spark.readStream if streaming else spark.read
    return reader.text(path)


def read_clicks(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """``user,url,timestamp`` files, with the event time added."""
    reader = spark.readStream if streaming else spark.read
    rows = reader.schema(CLICK).option("ignoreLeadingWhiteSpace", True).csv(path)
    return rows.withColumn("ts", F.timestamp_millis("timestamp"))


def parse_clicks(lines: DataFrame) -> DataFrame:
    """``user,url,timestamp`` lines in ``value`` → click columns; other columns are kept."""
    parts = F.split("value", ",")
    return lines.select(
        *[c for c in lines.columns if c != "value"],
        parts[0].alias("user"),
        parts[1].alias("url"),
        F.trim(parts[2]).cast("bigint").alias("timestamp"),
    )


def parse_sensors(lines: DataFrame) -> DataFrame:
    """``id ts vc`` lines in ``value`` → sensor columns; other columns are kept."""
    parts = F.split("value", " ")
    return lines.select(
        *[c for c in lines.columns if c != "value"],
        parts[0].alias("id"),
        parts[1].cast("bigint").alias("ts"),
        parts[2].cast("int").alias("vc"),
    )


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream_table(spark: SparkSession, sf_dir: str, name: str, files_per_batch: int | None = None) -> DataFrame:
    """The parquet files of one table, a single file or a folder of part files, as a stream. A table that is not there is an error."""
    table = read_table(spark, sf_dir, name)
    reader = spark.readStream.schema(table.schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    files = table.inputFiles()
    if len(files) == 1 and files[0].endswith(f"/{name}.parquet"):  # a stream reads folders: take the one file out of its folder
        return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def scan_table_by_name(spark: SparkSession, name: str) -> DataFrame:
    """Read a catalog table whose name is a parameter; anything but an identifier is refused."""
    if not _NAME.fullmatch(name):
        raise ValueError(f"not a table name: {name!r}")
    return spark.table(name)
