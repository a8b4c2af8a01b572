"""Token counts: heap-and-linked-list byte-pair merging.

A text is cut into pretokens by the vocabulary's pattern. Each pretoken starts as one symbol per UTF-8 byte,
linked left and right; a heap holds the adjacent pairs that may merge, by rank and then by place. The lowest
is popped and merged until the heap is empty: tokens are the initial symbols less the merges. No identifier
is looked up or emitted.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from streamloom.shipping import ship_by_value

#: The pattern of byte-level vocabularies, and the printable stand-ins of the 256 bytes.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Entries a worker keeps of either cache; a full cache is emptied, which costs time and changes no count.
CACHE = 400_000


def byte_stand_ins() -> dict[str, int]:
    """Printable Latin-1 characters stand for themselves, the other bytes for code points from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def read_merges(path: str) -> tuple[dict[tuple[bytes, bytes], int], list[str]]:
    """Ranks of the merges, as pairs of byte strings, and the special strings of a ``tokenizers`` file."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    to_byte = byte_stand_ins()
    plain = lambda s: bytes(to_byte[c] for c in s)
    pairs = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
    ranks = {(plain(a), plain(b)): rank for rank, (a, b) in enumerate(pairs)}
    return ranks, [t["content"] for t in spec["added_tokens"] if t["special"]]


def merged_length(symbols: list[bytes], ranks: dict[tuple[bytes, bytes], int]) -> int:
    """How many symbols are left when no adjacent pair has a rank."""
    from heapq import heapify, heappop, heappush

    n = len(symbols)
    if n < 2:
        return n
    left, right = list(range(-1, n - 1)), [*range(1, n), -1]
    heap = [(rank, i, symbols[i], symbols[i + 1]) for i in range(n - 1) if (rank := ranks.get((symbols[i], symbols[i + 1]))) is not None]
    heapify(heap)
    count = n
    while heap:
        _, i, a, b = heappop(heap)
        j = right[i]
        if j < 0 or symbols[i] != a or symbols[j] != b:  # one of the two has merged meanwhile
            continue
        symbols[i], symbols[j] = a + b, b""
        right[i] = k = right[j]
        right[j] = -1
        count -= 1
        if k >= 0:
            left[k] = i
            if (rank := ranks.get((symbols[i], symbols[k]))) is not None:
                heappush(heap, (rank, i, symbols[i], symbols[k]))
        if (h := left[i]) >= 0 and (rank := ranks.get((symbols[h], symbols[i]))) is not None:
            heappush(heap, (rank, h, symbols[h], symbols[i]))
    return count


def counter(ranks: dict[tuple[bytes, bytes], int], specials: list[str]):
    """A function from a text to its number of tokens."""
    import re

    import regex

    pattern = regex.compile(PRETOKEN)
    single = [bytes([b]) for b in range(256)]
    special = re.compile("|".join(map(re.escape, sorted(specials, key=len, reverse=True)))) if specials else None
    inner_blank = re.compile(r" (?!\S)")

    class Pretokens(dict):
        def __missing__(self, pretoken: str) -> int:
            if len(self) >= CACHE:
                self.clear()
            self[pretoken] = n = merged_length([single[b] for b in pretoken.encode("utf-8", "surrogatepass")], ranks)
            return n

    pretokens = Pretokens()

    def by_pattern(text: str) -> int:
        return sum(map(pretokens.__getitem__, pattern.findall(text)))

    class Pieces(dict):
        """Tokens of a space and what follows it up to the next space."""

        def __missing__(self, piece: str) -> int:
            if len(self) >= CACHE:
                self.clear()
            self[piece] = n = by_pattern(" " + piece)
            return n

    pieces = Pieces()

    def plain(text: str) -> int:
        # A pretoken has a space only in front or among other blanks. Where each space stands before a
        # character that is none, texts can be cut before their spaces, and most pieces have been seen.
        if inner_blank.search(text):
            return by_pattern(text)
        first, *rest = text.split(" ")
        return by_pattern(first) + sum(map(pieces.__getitem__, rest))

    def count(text: str) -> int:
        if special is None or not special.search(text):
            return plain(text)
        return len(special.findall(text)) + sum(map(plain, special.split(text)))

    return count


def count_tokens(docs: DataFrame, vocabulary: str, limit: int, text: str = "text") -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_tokens`` and ``over_limit`` in place of ``text``.

    ``vocabulary`` is the path of a byte-level ``tokenizers`` file on the driver; only its merges are sent out
    (50,000 pairs). Rows map to rows: nothing is shuffled. NULL counts as empty: 0 bytes, 0 tokens. Columns of
    these three names in ``docs`` are replaced; an empty table gives an empty one.
    """
    ranks, specials = read_merges(vocabulary)
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, ranks, specials))
    made = ["n_bytes", "n_tokens", "over_limit"]
    kept = [c for c in docs.columns if c not in (text, *made)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sys
        import types

        import pyarrow as pa
        import pyarrow.compute as pc

        vocabulary, ranks, specials = shared.value
        own = sys.modules.setdefault("_worker_token_counts", types.ModuleType("_worker_token_counts"))  # outlives the task
        if getattr(own, "vocabulary", None) != vocabulary:
            own.vocabulary, own.count = vocabulary, counter(ranks, specials)
        for batch in batches:
            texts = batch.column(text)
            n_tokens = [own.count(t.as_py() or "") for t in texts]
            n_bytes = pc.fill_null(pc.binary_length(texts), 0).cast("int64")
            columns = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, n_bytes, pa.array(n_tokens, "int64")], names=[*kept, *made[:2]])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in kept), "n_bytes long", "n_tokens long"])
    counted = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(text)).mapInArrow(run, schema)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


ship_by_value(__name__)
