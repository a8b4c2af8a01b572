"""Awkward rows, and tables in the shapes the operators take."""

import pandas as pd
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names the operators use themselves.
CLASHING = ["size", "source_size", "target", "copies", "shard", "slot", "score", "spans", "key", "tie", "_tie", "_key", "h", "n", "label", "rule", "kept", "n_words", "n_tokens", "verdict", "host", "path", "listed", "item_id", "bucket", "place", "block", "w0", "whole", "part", "cut", "start", "canonical", "digest", "raw", "node", "signature"]
LONG = "word " * 60_000


def awkward_docs(spark):
    """NULL in every column, empty, blank and very long texts, ties, repeated rows and rows without a key."""
    rows = [
        (1, "the quick brown fox jumps over the lazy dog and runs far away from here today", "en", "a", 10),
        (2, "the quick brown fox jumps over the lazy dog and runs far away from here today", "en", "b", 10),
        (3, None, "en", "a", None), (4, "", None, None, 0), (5, " \t\n ", "en", "", 4),
        (6, LONG, "en", "a", 300_000), (7, "single", "de", "b", 6), (7, "single", "de", "b", 6),
        (None, "a text without any key at all", None, "c", None), (None, None, None, None, None),
        (8, "naïve café ünïcode 中文 😀 <|endoftext|> ### $$$", "fr", "c", 3), (9, "one two", "en", "a", 7),
    ]
    return spark.createDataFrame(rows, DOCS)


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


def with_clashes(df):
    for c in CLASHING:
        if c not in df.columns:
            df = df.withColumn(c, F.lit("own"))
    return df


def bag(df, *columns):
    return sorted(map(tuple, (df.select(*columns) if columns else df).collect()), key=repr)


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def read(sf, name):
    return pd.read_parquet(f"{sf}/{name}.parquet")
