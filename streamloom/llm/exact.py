"""Exact duplicates by an extendible-hash index on shared files.

A text's 64-bit hash is its key. The leading bits of the key name its owner; owners with neighbouring keys are the work of one task. Inside an
owner a directory of slots, addressed by the next bits, points to buckets. A bucket that overflows is split by one more bit; if it has as many
bits as the directory, the directory doubles first. Texts with equal keys are chained and told apart by their bytes, never by the key alone.
The index is a table in the shared folder that Spark writes and commits, so a lost executor's owners are built again from the shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from streamloom.llm.common import bounded, fresh, written
from streamloom.shipping import ship_by_value

#: Distinct keys of a bucket before it is split.
CAPACITY = 512
#: Bytes of text that an owner task should get at most, on average; owners per task at least.
TASK_BYTES, OWNERS_PER_TASK = 64 << 20, 4
#: Bytes of text that a task holds back while it counts copies, and that it sends in one batch.
HELD_BYTES, BATCH_BYTES = 16 << 20, 4 << 20
#: Groups of two rows or more that are broadcast at most (about 100 bytes each); more are joined by shuffle.
MOST_GROUPS = 500_000


class Directory:
    """The extendible-hash directory of one owner, whose keys agree on the leading ``skip`` bits.

    ``slots`` are addressed by the next ``depth`` bits. A bucket is ``[depth, prefix, chains]``: how many of these bits its keys share, these
    bits, and for each key the entries ``[text, n, top]`` of the different texts that have it.
    """

    def __init__(self, skip: int, capacity: int):
        self.skip, self.capacity, self.depth = skip, capacity, 0
        self.slots: list[list] = [[0, 0, {}]]

    def _bits(self, key: int, depth: int) -> int:
        """``depth`` bits of a key behind the owner's."""
        return (key & ((1 << (64 - self.skip)) - 1)) >> (64 - self.skip - depth)

    def add(self, key: int, text: bytes, n: int, top) -> None:
        """Count ``n`` more rows of a text, the largest of whose ids is ``top``."""
        bucket = self.slots[self._bits(key, self.depth)]
        while key not in bucket[2] and len(bucket[2]) >= self.capacity:
            self._split(bucket)
            bucket = self.slots[self._bits(key, self.depth)]
        chain = bucket[2].setdefault(key, [])
        count_in(chain, text, n, top)

    def _split(self, bucket: list) -> None:
        depth, prefix, chains = bucket
        if depth == self.depth:
            self.slots = [b for b in self.slots for _ in range(2)]
            self.depth += 1
        halves = [[depth + 1, prefix * 2, {}], [depth + 1, prefix * 2 + 1, {}]]
        for key, chain in chains.items():
            halves[self._bits(key, depth + 1) & 1][2][key] = chain
        width = 1 << (self.depth - depth - 1)
        start = prefix * 2 * width
        self.slots[start : start + 2 * width] = [halves[0]] * width + [halves[1]] * width

    def buckets(self) -> Iterator[list]:
        """Every bucket once, in the order of its keys."""
        before = None
        for bucket in self.slots:
            if bucket is not before:
                yield bucket
            before = bucket


def count_in(chain: list[list], text: bytes, n: int, top) -> bool:
    """Add rows of a text to the chain of its key, comparing bytes; whether the text is new there."""
    for entry in chain:
        if entry[0] == text:
            entry[1] += n
            if entry[2] is None or top is not None and top > entry[2]:
                entry[2] = top
            return False
    chain.append([text, n, top])
    return True


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text", normalise: Callable[[Column], Column] | None = None, earlier: DataFrame | None = None, capacity: int = CAPACITY, bits: int = 64) -> DataFrame:
    """The index of the texts of ``docs``, written: one row per distinct text.

    ``owner``, ``bucket`` (the bits its keys share behind the owner's), ``depth`` (how many), ``hash``, ``chain`` (place among texts of equal hash), ``text``
    (bytes), ``text_sha256``, ``n`` (rows) and ``top`` (largest id). ``earlier`` is an index to which these rows are added. NULL counts
    as the empty text; a NULL id never is the largest. ``bits`` shortens the keys, for tests of chains.

    Copies are counted in each task before the shuffle, so a text that a third of all rows have is sent once per task and window of
    ``HELD_BYTES``. An owner holds its distinct texts only; hashes spread them evenly.
    """
    spark = docs.sparkSession
    body = F.coalesce((normalise or (lambda c: c))(F.col(text)), F.lit(""))
    rows = docs.select(F.xxhash64(body).alias("hash"), F.encode(body, "UTF-8").alias("text"), F.lit(1).cast("long").alias("n"), F.col(key).alias("top"))
    if bits < 64:
        rows = rows.withColumn("hash", F.shiftleft(F.shiftrightunsigned("hash", 64 - bits), 64 - bits))
    if earlier is not None:
        rows = rows.unionByName(earlier.select("hash", "text", "n", "top"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / TASK_BYTES))
    skip = math.ceil(math.log2(tasks * OWNERS_PER_TASK))
    top_type = rows.schema["top"].dataType.simpleString()

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chains: dict[int, list[list]] = {}
        held = 0
        for batch in batches:
            top_as = batch.schema.field("top").type
            for h, body, n, top in zip(*(batch.column(c).to_pylist() for c in ("hash", "text", "n", "top"))):
                if count_in(chains.setdefault(h, []), body, n, top):
                    held += len(body) + 100
                if held >= HELD_BYTES:
                    yield from rows_of(chains, top_as)
                    chains, held = {}, 0
        if chains:
            yield from rows_of(chains, top_as)

    def rows_of(chains: dict[int, list[list]], top_as: pa.DataType) -> Iterator[pa.RecordBatch]:
        entries = ((h, *entry) for h, chain in chains.items() for entry in chain)
        for part in parts(entries, lambda e: len(e[1])):
            hashes, texts, counts, tops = zip(*part)
            yield pa.RecordBatch.from_arrays([pa.array(hashes, "int64"), pa.array(texts, "binary"), pa.array(counts, "int64"), pa.array(tops, top_as)], names=["hash", "text", "n", "top"])

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owner, directory, top_as = None, None, None
        for batch in batches:
            top_as = batch.schema.field("top").type
            for mine, h, body, n, top in zip(*(batch.column(c).to_pylist() for c in ("owner", "hash", "text", "n", "top"))):
                if mine != owner:
                    if directory is not None:
                        yield from entries_of(owner, directory, top_as)
                    owner, directory = mine, Directory(skip, capacity)
                directory.add(h % 2**64, body, n, top)
        if directory is not None:
            yield from entries_of(owner, directory, top_as)

    def entries_of(owner: int, directory: Directory, top_as: pa.DataType) -> Iterator[pa.RecordBatch]:
        import hashlib

        def entries():
            for depth, prefix, chains in directory.buckets():
                for h in sorted(chains):
                    digests = [hashlib.sha256(body).hexdigest() for body, _, _ in chains[h]]
                    if len(set(digests)) < len(digests):
                        raise ValueError("two texts agree in both hashes and differ in bytes")
                    for place, (entry, digest) in enumerate(zip(chains[h], digests)):
                        yield (owner, prefix, depth, h - 2**64 if h >= 2**63 else h, place, entry[0], digest, entry[1], entry[2])

        kinds = ["int32", "int64", "int32", "int64", "int32", "binary", "string", "int64", top_as]
        names = ["owner", "bucket", "depth", "hash", "chain", "text", "text_sha256", "n", "top"]
        for part in parts(entries(), lambda e: len(e[5])):
            yield pa.RecordBatch.from_arrays([pa.array(values, kind) for values, kind in zip(zip(*part), kinds)], names=names)

    sent = rows.mapInArrow(gather, f"hash long, text binary, n long, top {top_type}")
    sent = sent.withColumn("owner", F.shiftrightunsigned("hash", 64 - skip).cast("int"))
    # Neighbouring owners go to one task.
    sent = sent.repartitionById(tasks, F.floor(F.col("owner") * F.lit(tasks) / F.lit(1 << skip)).cast("int")).sortWithinPartitions("owner")
    index = sent.mapInArrow(own, f"owner int, bucket long, depth int, hash long, chain int, text binary, text_sha256 string, n long, top {top_type}")
    return written(index, "exact-index")


def parts(entries, size: Callable) -> Iterator[list]:
    """``entries`` in lists of about ``BATCH_BYTES``."""
    part, held = [], 0
    for entry in entries:
        part.append(entry)
        held += size(entry) + 100
        if held >= BATCH_BYTES:
            yield part
            part, held = [], 0
    if part:
        yield part


def exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", normalise: Callable[[Column], Column] | None = None, capacity: int = CAPACITY, bits: int = 64) -> DataFrame:
    """``key``, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256`` for every row; other columns are ignored.

    Texts are equal if their bytes are, after ``normalise`` if given. Of equal texts the row with the largest key stays. NULL counts as the empty text. Rows
    alike in key and text stay or go together; a group without any key has no ``keep_id`` and keeps its rows. An empty table gives an empty one.
    """
    index = build_index(docs, key, text, normalise, None, capacity, bits)
    groups = written(index.where("n > 1").select(F.col("text_sha256").alias("_sha256"), F.col("hash").alias("_hash"), "n", "top"), "exact-groups")
    body = F.coalesce((normalise or (lambda c: c))(F.col(text)), F.lit(""))
    full = F.xxhash64(body)
    short = full if bits == 64 else F.shiftleft(F.shiftrightunsigned(full, 64 - bits), 64 - bits)
    rows = docs.select(F.col(key).alias("_key"), short.alias("_own"), F.sha2(body, 256).alias("text_sha256"))
    out = rows.join(bounded(groups, MOST_GROUPS), (F.col("_own") == F.col("_hash")) & (F.col("text_sha256") == F.col("_sha256")), "left")
    keep = F.when(F.col("n").isNull(), F.col("_key")).otherwise(F.col("top"))
    return out.select(
        F.col("_key").alias(key), keep.alias("keep_id"), F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce(F.col("_key") == keep, keep.isNull()).alias("kept"), "text_sha256",
    )


def keep_last(docs: DataFrame, key: str = "doc_id", text: str = "text", normalise: Callable[[Column], Column] | None = None) -> DataFrame:
    """The rows of ``docs`` that ``exact_duplicates`` keeps, with all their columns."""
    own, sha = fresh(*docs.columns), fresh(*docs.columns)
    found = exact_duplicates(docs, key, text, normalise).where("NOT kept")
    gone = written(found.select(F.col(key).alias(own), F.col("text_sha256").alias(sha)).distinct(), "exact-gone")
    body = F.coalesce((normalise or (lambda c: c))(F.col(text)), F.lit(""))
    return docs.join(bounded(gone, MOST_GROUPS), F.col(key).eqNullSafe(F.col(own)) & (F.sha2(body, 256) == F.col(sha)), "left_anti")


ship_by_value(__name__)
