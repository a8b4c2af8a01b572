"""The corpus pipeline: each stage applies one operator of ``streamloom.llm`` to all that the stage before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from streamloom.llm.common import table, written
from streamloom.llm.decontaminate import keep_uncontaminated
from streamloom.llm.mixing import mixed
from streamloom.llm.neardup import keep_one
from streamloom.llm.quality import keep_good
from streamloom.llm.queries import MIX_SEED, MIX_WEIGHTS
from streamloom.llm.sharding import shuffle_into_shards


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the importance resample keeps."""
    return keep_good(docs, table(spark, sf_dir, "labels"), seed=3)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more."""
    return keep_one(docs, size=5, share=(80, 100))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item, its parameters changed or not."""
    return keep_uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: documents left out, once or twice."""
    return mixed(docs, MIX_WEIGHTS, share=1.5, most=2.0, seed=MIX_SEED)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows in one random order over eight shards: the columns of documents, ``shard`` and ``slot``."""
    return shuffle_into_shards(docs, 8, seed=8)


#: (name, function of the session, the documents so far and the folder of the tables)
STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
    ("shard", shard),
]

#: The classifier is learned and the near-duplicate groups are found by hashing; SQL cannot express either.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
