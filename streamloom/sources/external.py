"""Readers for systems outside Spark: message broker and relational database."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession


def kafka_options(
    servers: str,
    topics: list[str],
    group: str | None = None,
    start: str | dict[str, dict[int, int]] = "latest",
) -> dict[str, str]:
    """Reader options; ``start`` is ``latest``, ``earliest`` or ``{topic: {partition: offset}}``."""
    if isinstance(start, dict):
        start = json.dumps({t: {str(p): o for p, o in parts.items()} for t, parts in start.items()})
    elif start not in ("latest", "earliest"):
        raise ValueError(f"unknown start position: {start!r}")
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": start,
        "failOnDataLoss": "true",
    }
    if group:
        options["kafka.group.id"] = group
    return options


def kafka_lines(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Message values as text, one row per message (needs the connector on the class path)."""
    return spark.readStream.format("kafka").options(**options).load().selectExpr("CAST(value AS STRING) AS value")


def jdbc_options(url: str, query: str, user: str, password: str, driver: str, fetch_size: int = 10_000) -> dict[str, str]:
    return {
        "url": url,
        "query": query,
        "user": user,
        "password": password,
        "driver": driver,
        "fetchsize": str(fetch_size),
    }


def jdbc_partitioned_options(
    url: str, table: str, user: str, password: str, driver: str,
    column: str, lower: int, upper: int, partitions: int,
) -> dict[str, str]:
    """Options that split one table read into ``partitions`` ranges of ``column``."""
    return {
        "url": url, "dbtable": table, "user": user, "password": password, "driver": driver,
        "partitionColumn": column, "lowerBound": str(lower), "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def jdbc_scan(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Rows of a SQL query, columns by name (needs the database driver on the class path)."""
    return spark.read.format("jdbc").options(**options).load()
