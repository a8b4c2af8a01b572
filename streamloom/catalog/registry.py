"""Where queries and their SQL are collected."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from streamloom.session import tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register ``run(spark, sf_dir)``; ``sql`` gives the same rows on the same tables."""

    def add(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        @wraps(run)
        def tuned(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(tune(spark), sf_dir)

        QUERIES[name] = tuned
        if sql is not None:
            ORACLES[name] = sql
        return run

    return add


# Building blocks of the SQL side.
CLICKS = """clicks AS (
    SELECT CAST(user_id AS VARCHAR) AS "user", event_type AS url, epoch_us(ts) // 1000 AS ts_ms, event_id AS seq FROM events)"""
DISORDER = """clicks AS (
    SELECT CAST(user_id AS VARCHAR) AS "user", event_type AS url, epoch_us(ts) // 1000 AS ts_ms, event_id,
        (event_id + (event_id * 7919) % 97) * 97 + 96 - (event_id * 7919) % 97 AS seq FROM events)"""
SENSORS = """sensors AS (
    SELECT 's' || (user_id % 4) AS id, epoch_us(ts) // 1000 AS ts, CAST(floor(value) AS INTEGER) AS vc, event_id AS seq FROM events)"""
LINES = """lines AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)"""
WORDS = LINES + """, words AS (
    SELECT doc_id, unnest(CASE WHEN line = '' THEN [''] WHEN rtrim(line, ' ') = '' THEN [] ELSE string_split(rtrim(line, ' '), ' ') END) AS word
    FROM lines)"""
