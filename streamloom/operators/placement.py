"""Where rows go. None of these changes the set of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def shuffle(df: DataFrame, n: int, ids: list[str], seed: int = 0) -> DataFrame:
    """To a pseudo-random partition drawn from the row's ``ids``.

    A hash instead of ``rand()``: a lost task that is run again sends every row where it went before.
    """
    return df.repartition(n, F.xxhash64(*ids, F.lit(seed)))


def rebalance(df: DataFrame, n: int) -> DataFrame:
    """Round robin: equal partitions whatever the keys."""
    return df.repartition(n)


#: A scan of fewer splits than this for each core is dealt out.
DEALT = 4


def over_all_cores(scan: DataFrame) -> DataFrame:
    """Rows of a scan of few splits, dealt out to ``DEALT`` tasks a core before heavy work; any other scan as it is.

    Splits are cut by bytes and their number says little about rows: a split in which no row group begins is empty. Only a scan of
    many splits, which are of full size, is sure to have rows in most of them.
    """
    tasks = DEALT * scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(tasks) if scan.rdd.getNumPartitions() < tasks else scan


def rescale(df: DataFrame, n: int, grow: bool = False) -> DataFrame:
    """Fewer partitions without a shuffle; to ``grow`` needs one."""
    return df.repartition(n) if grow else df.coalesce(n)


def to_every(df: DataFrame, n: int) -> DataFrame:
    """A copy of every row in each of ``n`` partitions (``target``)."""
    copies = df.withColumn("target", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return copies.repartitionById(n, "target")


def global_order(df: DataFrame, n: int, *order: str) -> DataFrame:
    """One sequence over all rows, held by ``n`` tasks.

    Read in partition order this is what a single task would see; rows never meet in one task.
    """
    return df.repartitionByRange(n, *order).sortWithinPartitions(*order)


def by_key(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """All rows of a key in one partition. For joins and aggregates prefer leaving placement to Spark."""
    return df.repartition(n, *keys)


def by_target(df: DataFrame, n: int, target: Column) -> DataFrame:
    """To the partition computed by the caller, ``0 … n-1``."""
    return df.repartitionById(n, target.cast("int"))


def by_parsed_modulo(df: DataFrame, n: int, key: str) -> DataFrame:
    """To partition ``int(key) % n``."""
    return by_target(df, n, F.col(key).cast("bigint") % n)


def set_parallelism(spark, n: int) -> None:
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
