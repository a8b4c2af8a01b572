"""Spelling variants by a bit-sliced position index.

Two words are near if one inserted, deleted or replaced code point makes one the other. The words of a block are numbered, and for every (position, letter) a
bitset says which of them have the letter there. A query word is read once: the set of words without an error so far and the sets with one error (a replaced
letter, or a letter more, whose positions are shifted by one) are advanced for all words of the block at once by a few operations on bitsets.

Blocks: near words share the first or the last half of the letters that may differ. A block with too many letters is divided in the same way
again, until few positions are left, and then the alphabet bounds it. So no block grows with the vocabulary, and no near words are lost.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from streamloom.llm.common import bounded, whole_groups, written
from streamloom.shipping import ship_by_value

#: Letters of a word in UTF-8 behind lower-casing of A-Z: a-z, and U+00C0 to U+00FF.
RUN = rb"(?:[a-z]|\xc3[\x80-\xbf])+"
#: One in so many (word, document) pairs gets a letter taken out.
ONE_IN = 199
#: Words have so many code points and occurrences at least; a form has so many times the occurrences of its word.
LEAST_LETTERS, LEAST_TIMES, TIMES = 6, 5, 5
#: Different words a task counts before it passes the counts on, and letters of a block (in positions that may differ) before it is divided.
HELD_WORDS, BLOCK_LETTERS = 200_000, 16_384
#: Words that are broadcast at most (about 60 bytes each); more are joined by shuffle.
MOST_WORDS = 1_000_000


def damaged(run: bytes, start: int) -> bytes:
    """``run``, or ``run`` without one code point if the checksum that begins with ``start`` says so."""
    h = zlib.crc32(run, start)
    if h % ONE_IN:
        return run
    letters = run.decode()
    k = h % len(letters)
    return (letters[:k] + letters[k + 1 :]).encode()


def count_words(docs: DataFrame, key: str = "doc_id", text: str = "text", least_letters: int = LEAST_LETTERS, least_times: int = LEAST_TIMES) -> DataFrame:
    """``word`` and ``n`` of the words of all texts. NULL text has none; a NULL key is the empty string in the checksum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter

        import pyarrow as pa

        find = re.compile(RUN).findall
        total: Counter[bytes] = Counter()

        def batch_of(counts) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([w.decode() for w in counts], "string"), pa.array(list(counts.values()), "int64")], names=["word", "n"])

        for batch in batches:
            for own, body in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                start = zlib.crc32(f"{'' if own is None else own}:".encode())
                for word, n in Counter(find(body.encode().lower())).items():
                    total[damaged(word, start)] += n
                if len(total) > HELD_WORDS:
                    yield batch_of(total)
                    total = Counter()
        if total:
            yield batch_of(total)

    rows = docs.where(F.col(text).isNotNull()).select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"))
    counts = rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where((F.char_length("word") >= least_letters) & (F.col("n") >= least_times))


class Index:
    """The bit-sliced index of some words: a bitset of the words with a letter at a position, one for each length, and one of all."""

    def __init__(self, words: list[str]):
        self.slices: dict[tuple[int, str], int] = {}
        self.lengths: dict[int, int] = {}
        members: dict[tuple[int, str], list[int]] = {}
        sizes: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            sizes.setdefault(len(word), []).append(i)
            for place in enumerate(word):
                members.setdefault(place, []).append(i)
        self.slices = {place: bits_of(rows) for place, rows in members.items()}
        self.lengths = {size: bits_of(rows) for size, rows in sizes.items()}
        self.all = (1 << len(words)) - 1

    def near(self, word: str) -> int:
        """The set of the words as long as ``word`` or one letter longer that one error separates from it."""
        at, size = self.slices.get, len(word)
        same, more = self.lengths.get(size, 0), self.lengths.get(size + 1, 0)
        none, replaced, longer = same | more, 0, more  # the sets before the first letter: an error may be a letter before it
        for i, letter in enumerate(word):
            here = at((i, letter), 0)
            replaced = replaced & here | none & ~here & same
            none &= here
            longer = longer & at((i + 1, letter), 0) | none & more
            if not (none or replaced or longer):
                return 0
        return replaced | longer


def bits_of(members: list[int]) -> int:
    """A bitset as a number."""
    out = bytearray((members[-1] >> 3) + 1)
    for i in members:
        out[i >> 3] |= 1 << (i & 7)
    return int.from_bytes(out, "little")


def members_of(bits: int) -> Iterator[int]:
    while bits:
        low = bits & -bits
        yield low.bit_length() - 1
        bits ^= low


def first_blocks(words: DataFrame) -> DataFrame:
    """``word``, ``size`` (letters of the shorter word of a pair), ``head`` and ``tail``: letters at both ends that all words of the block share.

    A word is as long as the shorter one, or one letter longer. Near words share ``size - 1`` letters at least, so half of these at one end.
    """
    sizes = F.explode(F.array(F.char_length("word"), F.char_length("word") - 1)).alias("size")
    return divided(words.select("word", sizes, F.lit(0).alias("head"), F.lit(0).alias("tail")))


def divided(blocks: DataFrame) -> DataFrame:
    """Each block in two ways: by the first half of the letters between head and tail, and by the last."""
    half = F.ceil((F.col("size") - F.col("head") - F.col("tail") - 1) / F.lit(2)).cast("int")
    ways = F.explode(F.array(F.struct((F.col("head") + half).alias("head"), F.col("tail")), F.struct(F.col("head"), (F.col("tail") + half).alias("tail")))).alias("way")
    return blocks.select("word", "size", ways).select("word", "size", "way.head", "way.tail")


def near_in_blocks(blocks: DataFrame) -> DataFrame:
    """``a`` and ``b`` of near words in ``blocks``, ``a`` the shorter or, of the same length, each of the two."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa

        left: list[str] = []
        right: list[str] = []
        for rows in whole_groups(batches, "block"):
            names = rows.column("block").to_pylist()
            words, size, head, tail = (rows.column(c).to_pylist() for c in ("word", "size", "head", "tail"))
            start = 0
            for end in range(1, len(names) + 1):
                if end < len(names) and names[end] == names[start]:
                    continue
                own = words[start:end]
                if len(own) > 1:
                    middles = [w[head[start] : len(w) - tail[start]] for w in own]
                    free = size[start] - head[start] - tail[start]
                    index = Index(middles)
                    for word, middle in zip(own, middles):
                        if len(middle) == free:
                            for i in members_of(index.near(middle)):
                                left.append(word)
                                right.append(own[i])
                start = end
            if len(left) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(left, "string"), pa.array(right, "string")], names=["a", "b"])
                left, right = [], []
        if left:
            yield pa.RecordBatch.from_arrays([pa.array(left, "string"), pa.array(right, "string")], names=["a", "b"])

    return blocks.repartition("block").sortWithinPartitions("block").mapInArrow(run, "a string, b string")


def near_words(words: DataFrame, block_letters: int = BLOCK_LETTERS) -> DataFrame:
    """Each pair ``a``, ``b`` of near words in both orders, once. ``words`` has distinct ``word`` of two letters or more, and is written or cheap."""
    blocks, found = first_blocks(words), []
    while True:
        # Head and tail by their letters: a block is one value, and no two blocks share it.
        name = F.concat_ws("|", "size", F.substring("word", F.lit(1), F.col("head")), F.when(F.col("tail") > 0, F.substring("word", -F.col("tail"), F.col("tail"))).otherwise(""), "head", "tail")
        blocks = written(blocks.withColumn("block", name), "spelling-blocks")
        free = F.col("size") - F.col("head") - F.col("tail")
        large = blocks.groupBy(F.col("block").alias("_block")).agg(F.count("*").alias("n"), F.first(free).alias("free"))
        large = written(large.where((F.col("free") > 1) & (F.col("n") * F.col("free") > block_letters)).select("_block"), "spelling-large")
        any_large = large.limit(1).count() > 0
        small = blocks.join(bounded(large, MOST_WORDS), F.col("block") == F.col("_block"), "left_anti") if any_large else blocks
        found.append(written(near_in_blocks(small), "spelling-pairs"))
        if not any_large:
            break
        blocks = divided(blocks.join(bounded(large, MOST_WORDS), F.col("block") == F.col("_block"), "left_semi"))
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.union(more)
    return pairs.union(pairs.select("b", "a")).distinct()


def spelling_forms(docs: DataFrame, key: str = "doc_id", text: str = "text", least_letters: int = LEAST_LETTERS, least_times: int = LEAST_TIMES, times: int = TIMES, block_letters: int = BLOCK_LETTERS) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n`` and ``root`` of every word of the texts that has ``least_letters`` and occurs ``least_times``.

    ``form`` is the near word of largest ``n`` (of equal ones the first in code-point order) if that is ``times`` the word's or more, else NULL. ``root``
    is where following forms from the word ends, the word itself if it has none. Texts that are NULL or have no letters add no words; repeated rows count
    each time; an empty table gives an empty one. Other columns are ignored.
    """
    words = written(count_words(docs, key, text, least_letters, least_times), "spelling-words")
    pairs = near_words(words.select("word"), block_letters)
    known = words.select(F.col("word").alias("b"), F.col("n").alias("near_n"))
    best = pairs.join(bounded(known, MOST_WORDS), "b").groupBy(F.col("a").alias("_a")).agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("b"))).alias("best"))
    rows = words.join(best, F.col("word") == F.col("_a"), "left")
    taken = -F.col("best.less") >= F.col("n") * times
    rows = rows.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(taken, F.col("best.b")).alias("form"), F.when(taken, -F.col("best.less")).alias("form_n"))
    rows = written(rows, "spelling-forms")
    roots = roots_of(rows.where("form IS NOT NULL").select("word", "form"))
    out = rows.join(bounded(roots.withColumnRenamed("word", "_word"), MOST_WORDS), F.col("word") == F.col("_word"), "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def roots_of(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``, by doubling the steps: each round follows from where the last one ended. Occurrences grow along a way, so it has no circles."""
    roots = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = bounded(roots.select(F.col("word").alias("_at"), F.col("root").alias("_next")), MOST_WORDS)
        step = written(roots.join(on, F.col("root") == F.col("_at"), "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_at").isNotNull().alias("moved")), "spelling-roots")
        moved, roots = step.where("moved").limit(1).count(), step.select("word", "root")
        if not moved:
            return roots


ship_by_value(__name__)
