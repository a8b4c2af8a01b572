"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from streamloom.session import scratch
from streamloom.shipping import ship_by_value

#: ASCII blanks: the space and the bytes 9 to 13. Words are runs of anything else.
BLANKS = " \t\n\x0b\x0c\r"
WORD_BREAK = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows a file of a thin table should have at least, where the number of rows is known beforehand.
ROWS_PER_FILE = 200_000


_passing: list[list[str]] = []


@contextmanager
def passing_tables(spark: SparkSession) -> Iterator[None]:
    """Tables ``written`` inside, but for those that are to stay, are removed at the end."""
    paths: list[str] = []
    _passing.append(paths)
    try:
        yield
    finally:
        _passing.remove(paths)
        for path in paths:
            _remove(spark, path)


def _remove(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def written(df: DataFrame, purpose: str, rows: int | None = None, stays: bool = False) -> DataFrame:
    """``df`` as a table in the shared scratch folder: lineage ends there, and losing an executor loses nothing.

    ``rows`` is an upper bound of a thin table's rows. It gets so few files that they aren't tiny; a table that fits one file is read as one
    partition, and what is done with such tables alone needs no shuffle.
    """
    path = scratch(df.sparkSession, purpose)
    if _passing and not stays:
        _passing[-1].append(path)
    files = None if rows is None else max(1, -(-rows // ROWS_PER_FILE))
    (df.coalesce(files) if files else df).write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    return back.coalesce(1) if files == 1 else back


#: Tasks a core to which rows of few splits are dealt out, and rows of a split from which that pays.
DEALT, DEALT_FROM = 4, 5_000


@contextmanager
def evenly(rows: DataFrame, *by: str) -> Iterator[DataFrame]:
    """``rows`` as they are if no split has more than twice a core's share of them; otherwise dealt out by a hash of ``by``, as a table that is removed at the end.

    Splits are cut by bytes, but a row group is read by one task: a table of few row groups keeps few cores at work, however many splits it has.
    The count by splits reads no column of a table.
    """
    spark = rows.sparkSession
    cores = spark.sparkContext.defaultParallelism
    most, n = rows.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.sum("count")).first()
    if most is None or most <= DEALT_FROM or most * cores <= 2 * n:
        yield rows
        return
    path = scratch(spark, "dealt")
    try:
        rows.repartition(DEALT * cores, *by).write.parquet(path)
        yield spark.read.schema(rows.schema).parquet(path)
    finally:
        _remove(spark, path)


def fresh(*taken: str) -> str:
    """A column name that clashes with none of the user's."""
    name = f"__{uuid.uuid4().hex[:12]}"
    while name in taken:
        name = f"__{uuid.uuid4().hex[:12]}"
    return name


def words(text: Column) -> Column:
    """The words of a text as an array; none for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), "")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def uniform(*parts: Column | str | int) -> Column:
    """A double in (0, 1) drawn from an MD5 of the parts: 48 bits and a half, so that neither end occurs.

    MD5 rather than a seeded generator: the same row gets the same number on every run and on every engine.
    """
    text = F.concat_ws("|", *[p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts])
    draw = F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double")
    return (draw + F.lit(0.5)) / F.lit(float(2**48))


def bounded(df: DataFrame, most: int) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``most`` rows; otherwise as it is, for a shuffled join.

    Call with a written or persisted table: its rows are counted.
    """
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def hashed_sample(df: DataFrame, most: int, *keys: str) -> DataFrame:
    """``most`` rows of ``df`` at most: those with the smallest hashes of ``keys``, the same on every run.

    Rows are counted first, and only hashes so small that about four times ``most`` rows have them are ordered: tasks send
    the driver little, however many there are.
    """
    share = min(1.0, 4 * most / max(1, df.count()))
    order = F.xxhash64(*keys)
    few = df if share == 1.0 else df.where(F.shiftrightunsigned(order, 1) <= F.lit(int(share * (2**63 - 1))))
    return few.orderBy(order, *keys).limit(most)


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Regroup batches of a partition sorted by ``key`` so that no key is cut in two."""
    import pyarrow as pa
    import pyarrow.compute as pc

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = batch.column(key)[batch.num_rows - 1]
        same = pc.equal(batch.column(key), last)
        first = pc.index(same, True).as_py()
        if first:
            yield pa.Table.from_batches([*held, batch.slice(0, first)])
            held = [batch.slice(first)]
        elif held and held[0].column(key)[0] != last:
            yield pa.Table.from_batches(held)
            held = [batch]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


ship_by_value(__name__)
