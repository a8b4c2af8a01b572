"""Quality classifier by importance resampling.

Two hashed n-gram models are fitted: of the target text (labelled good) and of the raw text (every document). A
document's importance weight is the ratio of what the two give it. Documents are resampled without
replacement by Gumbel top-k: log weight plus Gumbel noise, the k largest stay.

The n-grams are of words, and of word classes (shape, and whether the word repeats what the text has had), so that unseen
words still have counts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from streamloom.llm.common import bounded, fresh, hashed_sample, passing_tables, uniform, written
from streamloom.shipping import ship_by_value

#: Buckets the n-grams hash into: the size of either model.
BUCKETS = 1 << 16
#: Labelled rows that the target model and the calibration use at most: those with the smallest hashes.
MOST_LABELS = 20_000
#: n-grams overlap, so they are not independent: every text weighs its mean log ratio times this many words, whatever its length.
EVIDENCE_WORDS = 60
#: Rejected rows that are broadcast at most (24 bytes each); more are joined by shuffle.
MOST_REJECTED = 1_000_000
#: Bins of either histogram that finds the k-th largest key.
BINS = 4096


def extractor():
    """A function from a text to the buckets of its n-grams, as an array."""
    import re
    import zlib

    import numpy as np

    shapes = [re.compile(p) for p in (r"[^\w]+", r"[^\W\d_]+[^\w\s]?", r"\W*\d[\d\W]*", r"\w+\W{2,}", r"\w+(\W\w+)+\W?")]

    def shape(word: str) -> int:
        if word.isalpha() and word[1:].islower():
            return 1
        kind = next((k for k, p in enumerate(shapes) if p.fullmatch(word)), len(shapes))
        if kind == 1 and len(word) > 2 and word.upper() == word and word.lower() != word:
            return 7
        if kind == 3 and word.upper() == word and word.lower() != word:
            return 6
        return kind

    class Codes(dict):
        def __missing__(self, word: str) -> int:
            if len(self) >= 400_000:
                self.clear()
            self[word] = code = zlib.crc32(word.encode("utf-8", "surrogatepass")) << 3 | shape(word)
            return code

    codes = Codes()
    mix = np.uint64(0x9E3779B97F4A7C15)

    def buckets(text: str):
        words = text.split()
        if not words:
            return np.zeros(0, np.int64)
        code = np.fromiter(map(codes.__getitem__, words), np.uint64, len(words))
        word, kind = code >> np.uint64(3), code & np.uint64(7)
        pair = np.zeros_like(word)
        pair[1:] = (word[:-1] * mix + word[1:]) * mix
        triple = np.zeros_like(word)
        triple[2:] = (pair[1:-1] + word[2:]) * mix
        # 0: new, 1: the word just before, 2: one of the two before that, 3: a three-word run the text has had
        seen = np.zeros(len(words), np.uint64)
        if len(words) > 3:
            order = np.argsort(triple[2:], kind="stable")
            run = triple[2:][order]
            seen[order[1:][run[1:] == run[:-1]] + 2] = 3
        for d in (3, 2):
            seen[d:][word[d:] == word[:-d]] = 2
        seen[1:][word[1:] == word[:-1]] = 1
        state = kind * np.uint64(4) + seen + np.uint64(1)
        states = state.copy()
        states[1:] += state[:-1] * np.uint64(64)
        states[2:] += state[:-2] * np.uint64(4096)
        grams = np.concatenate([word * mix, pair[1:] + np.uint64(1), state * mix + np.uint64(2), states * mix + np.uint64(3)])
        grams ^= grams >> np.uint64(29)
        return ((grams * mix) >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)

    return buckets


def fit(docs: DataFrame, labels: DataFrame, key: str, good: str) -> tuple[list[float], DataFrame]:
    """Log ratio of each bucket, target over raw, and the labelled rows used as a small table. ``docs`` has ``key`` and ``text``."""
    used = labels.where(F.col(good).isNotNull() & F.col(key).isNotNull()).select(F.col(key).alias("_key"), F.col(good).cast("int").alias("_good"))
    used = used.groupBy("_key").agg(F.min("_good").alias("_good"))
    used = written(hashed_sample(used, MOST_LABELS, "_key"), "labels")  # bounded, so it can be sent to every task
    rows = docs.select(F.col("key").alias("_key"), F.col("text").alias("_text")).join(F.broadcast(used), "_key", "left").select("_text", "_good")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow as pa

        buckets, raw, target = extractor(), np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text, label in zip(batch.column("_text"), batch.column("_good")):
                at = buckets(text.as_py() or "")
                np.add.at(raw, at, 1)
                if label.as_py() == 1:
                    np.add.at(target, at, 1)
        at = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(raw[at]), pa.array(target[at])], names=["bucket", "raw", "target"])

    counts = rows.mapInArrow(count, "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    raw, target = [0] * BUCKETS, [0] * BUCKETS
    for r in counts.collect():  # as many rows as the model has buckets
        raw[r.bucket], target[r.bucket] = r.raw, r.target
    if not sum(target):
        return [0.0] * BUCKETS, used
    a, b = 1.0 / (sum(target) + BUCKETS), 1.0 / (sum(raw) + BUCKETS)
    return [math.log((t + 1) * a) - math.log((r + 1) * b) for t, r in zip(target, raw)], used


def log_weights(docs: DataFrame, ratio: list[float]) -> DataFrame:
    """``_key``, ``_tie`` (hash of the text) and ``log_weight`` of every row of ``key`` and ``text``."""
    shared = docs.sparkSession.sparkContext.broadcast(ratio)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow as pa

        buckets, ratio = extractor(), np.array(shared.value)
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for i, text in enumerate(batch.column("_text")):
                at = buckets(text.as_py() or "")
                if len(at):
                    out[i] = ratio[at].mean() * EVIDENCE_WORDS
            yield pa.RecordBatch.from_arrays([batch.column("_key"), batch.column("_tie"), pa.array(out)], names=["_key", "_tie", "log_weight"])

    rows = docs.select(F.col("key").alias("_key"), F.xxhash64("text").alias("_tie"), F.col("text").alias("_text"))
    kind = rows.schema["_key"].dataType.simpleString()
    return rows.mapInArrow(score, f"_key {kind}, _tie long, log_weight double")


def threshold(scored: DataFrame, used: DataFrame) -> float | None:
    """The log weight between labelled good and other rows: halfway between the classes' edges (a 200th of each may lie beyond).

    NULL if a class is missing.
    """
    edges = scored.join(F.broadcast(used), "_key").agg(
        F.percentile_approx(F.when(F.col("_good") == 1, F.col("log_weight")), 0.005, 100_000).alias("good"),
        F.percentile_approx(F.when(F.col("_good") != 1, F.col("log_weight")), 0.995, 100_000).alias("other"),
    ).first()
    return None if edges.good is None or edges.other is None else (edges.good + edges.other) / 2


def top_k(rows: DataFrame, k: int) -> float:
    """The k-th largest ``rank_key`` (of 0 to 1), found by two histograms; only the last bin's rows are ordered."""
    if k <= 0:
        return 2.0
    left, width = rows.select("rank_key"), 1.0
    low = 0.0
    for _ in range(2):
        width /= BINS
        bin_ = F.least(F.floor((F.col("rank_key") - F.lit(low)) / F.lit(width)), F.lit(BINS - 1)).alias("bin")
        for r in left.groupBy(bin_).count().orderBy(F.desc("bin")).collect():  # as many rows as bins at most
            if r["count"] >= k:
                break
            k -= r["count"]
        left = left.select("rank_key", bin_).where(F.col("bin") == r.bin).drop("bin")
        low += r.bin * width
    last = left.groupBy("rank_key").count().orderBy(F.desc("rank_key")).limit(k).collect()
    for r in last:
        k -= r["count"]
        if k <= 0:
            break
    return r.rank_key


def resample(docs: DataFrame, labels: DataFrame, seed: int = 0, key: str = "doc_id", text: str = "text", good: str = "quality") -> DataFrame:
    """One row per document: ``key``, ``_tie`` (hash of its text), ``log_weight``, ``rank_key`` and ``kept``.

    k is the expected number of good documents: the sum over all documents of the logistic of log weight less ``threshold``. With labels of
    one class only everything is kept. Gumbel noise comes from an MD5 of seed, key and text, so reruns agree; rows alike in
    key and text share it and stay or go together. NULL and empty texts have weight 1 (log 0). ``labels`` may hold
    unknown keys, NULLs and a key more than once (the worst label counts). An empty table gives an empty one.
    """
    docs = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    ratio, used = fit(docs, labels, key if key in labels.columns else "doc_id", good)
    scored = written(log_weights(docs, ratio), "log-weights")
    middle = threshold(scored, used)
    noise = -F.log(-F.log(uniform(F.lit(seed), F.coalesce(F.col("_key").cast("string"), F.lit("")), F.col("_tie"))))
    gumbel = scored.withColumn("gumbel_key", F.col("log_weight") + noise)
    if middle is None:
        kept = gumbel.withColumn("kept", F.lit(True))
    else:
        away = F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(middle) - F.col("log_weight")))
        k = round(scored.agg(F.sum(away)).first()[0] or 0)
        squeezed = F.lit(0.5) + F.atan((F.col("gumbel_key") - F.lit(middle)) / 8) / F.lit(math.pi)  # keeps the order, within 0 to 1
        least = top_k(gumbel.withColumn("rank_key", squeezed), k) if scored.limit(1).count() else 0.0
        kept = gumbel.withColumn("kept", squeezed >= F.lit(least))
    return kept.select(F.col("_key").alias(key), "_tie", "log_weight", "gumbel_key", "kept")


def keep_good(docs: DataFrame, labels: DataFrame, seed: int = 0, key: str = "doc_id", text: str = "text", good: str = "quality") -> DataFrame:
    """The rows of ``docs`` that ``resample`` keeps, with all their columns."""
    own, tie = fresh(*docs.columns), fresh(*docs.columns)
    with passing_tables(docs.sparkSession):
        verdict = resample(docs, labels, seed, key, text, good)
        gone = written(verdict.where("NOT kept").select(F.col(key).alias(own), F.col("_tie").alias(tie)).distinct(), "rejected", stays=True)
    same = F.col(key).eqNullSafe(F.col(own)) & (F.xxhash64(F.col(text)) == F.col(tie))
    return docs.join(bounded(gone, MOST_REJECTED), same, "left_anti")


ship_by_value(__name__)
