"""Two-pass external shuffle into shards.

Pass 1 scatters records uniformly over buckets that fit in memory, by a seeded hash. Pass 2 gives each bucket
a Fisher-Yates shuffle and writes it. The buckets in order are one random order of all records, which
is cut into shards of equal row counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from streamloom.llm.common import bounded, fresh, written
from streamloom.shipping import ship_by_value

#: Bytes of text in a bucket on average. A task holds about three times as much; raise it with executor memory.
BUCKET_BYTES = 16 << 20
#: Bucket offsets are added up in blocks of so many, so that no task sees them all.
BLOCK = 1024
#: Offsets that are broadcast at most (16 bytes each); more are joined by shuffle.
MOST_OFFSETS = 500_000


def fisher_yates(n: int, seed: int, bucket: int):
    """A random order of ``range(n)``, the same for the same seed and bucket."""
    import numpy as np

    order = list(range(n))
    draws = np.random.default_rng([seed % 2**63, bucket]).integers(0, np.arange(1, n + 1)).tolist() if n else []
    for i in range(n - 1, 0, -1):
        j = draws[i]
        order[i], order[j] = order[j], order[i]
    return order


def shuffle_into_shards(docs: DataFrame, n_shards: int, seed: int = 0, key: str = "doc_id", text: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``docs`` with ``shard`` (0 to ``n_shards`` - 1) and ``slot`` (0, 1, … in each shard), read back from the written buckets.

    Shards differ by one row at most. The hash takes seed, key, text and the number of the input partition:
    copies of a text have different keys, rows without a key different texts, and rows alike in all come from many
    partitions, so no bucket gathers a hot group. NULLs are values like any other; rows are never
    merged. An empty table gives an empty one; with fewer rows than shards some shards are empty. Columns named
    ``shard`` or ``slot`` are replaced.
    """
    kept = [c for c in docs.columns if c not in ("shard", "slot")]
    bucket, place = fresh(*kept), fresh(*kept)
    docs = docs.select(*[F.col(f"`{c}`") for c in kept])
    total, n_rows = docs.agg(F.sum(F.octet_length(text)), F.count("*")).first()
    n_buckets = max(1, -(-((total or 0) + 100 * n_rows) // bucket_bytes))

    def shuffle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa
        import pyarrow.compute as pc

        held = [b for b in batches if b.num_rows]
        if not held:
            return
        gathered = pa.Table.from_batches(held)
        held.clear()
        for own in pc.unique(gathered.column(bucket)).to_pylist():  # one, as a partition is a bucket
            rows = gathered if gathered.num_rows == 0 else gathered.filter(pc.equal(gathered.column(bucket), own))
            rows = rows.take(pc.sort_indices(rows, [(key, "ascending"), (place, "ascending")]))  # whatever order they came in
            rows = rows.take(pa.array(fisher_yates(rows.num_rows, seed, own), "int64"))
            rows = rows.set_column(rows.column_names.index(place), place, pa.array(range(rows.num_rows), "int64"))
            yield from rows.to_batches(max_chunksize=2000)

    rows = docs.withColumn(place, F.xxhash64(F.lit(seed), F.col(key), F.col(text)))
    rows = rows.withColumn(bucket, F.pmod(F.xxhash64(F.lit(seed + 1), F.col(place), F.spark_partition_id()), F.lit(n_buckets)).cast("int"))
    scattered = rows.repartitionById(n_buckets, F.col(bucket))
    buckets = written(scattered.mapInArrow(shuffle, rows.schema), "buckets")

    counts = buckets.groupBy(F.col(bucket).alias("b")).agg(F.count("*").alias("n")).withColumn("block", F.expr(f"b div {BLOCK}"))
    counts = written(counts, "bucket-counts")
    blocks = counts.groupBy(F.col("block").alias("k")).agg(F.sum("n").alias("m"))
    blocks = blocks.withColumn("before", F.sum("m").over(Window.orderBy("k").rowsBetween(Window.unboundedPreceding, -1)))
    inside = F.sum("n").over(Window.partitionBy("block").orderBy("b").rowsBetween(Window.unboundedPreceding, -1))
    offset = fresh(*kept)
    offsets = counts.withColumn("inside", inside).join(blocks, F.col("block") == F.col("k"))
    offsets = offsets.select(F.col("b"), (F.coalesce("inside", F.lit(0)) + F.coalesce("before", F.lit(0))).alias(offset))
    offsets = bounded(written(offsets.withColumnRenamed("b", offset + "b"), "offsets"), MOST_OFFSETS)

    position = F.col(offset) + F.col(place)
    placed = buckets.join(offsets, F.col(bucket) == F.col(offset + "b")).withColumn(offset, position)
    placed = placed.withColumn("shard", F.floor(F.expr(f"`{offset}` * {n_shards} div {max(1, n_rows)}")).cast("int"))
    first = F.expr(f"(shard * {n_rows}L + {n_shards - 1}) div {n_shards}")
    return placed.withColumn("slot", F.col(offset) - first).select(*[F.col(f"`{c}`") for c in kept], "shard", "slot")


def write_shards(placed: DataFrame, path: str) -> None:
    """The shards as folders ``shard=0`` … of Parquet files, rows in slot order inside each file."""
    placed.repartition("shard", F.expr("slot div 1000000")).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


ship_by_value(__name__)
