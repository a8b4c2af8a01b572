"""Toxicity: a linear-chain conditional random field over words.

Words of labelled documents get token labels (below), the field is trained on them by maximum likelihood, and the
forward-backward recursion gives every word of every document its marginal probability of being toxic. Marginals
make the document's score, and the words above one half are the offending spans.

Only words with a feature of the model have a potential of their own. All others share one, so a run of them is a power of one
2 × 2 matrix: the recursion steps from word with features to word with features and is still exact.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from streamloom.llm.common import hashed_sample, written
from streamloom.shipping import ship_by_value

#: Labelled documents to learn from: at most so many, those with the smallest hashes, none longer than so many characters.
MOST_DOCUMENTS, MOST_CHARACTERS = 4000, 30_000
#: What makes a feature one of toxic words, see ``toxic_features``.
LEAST_PRECISION, CHANCE = 0.85, 10
#: Prefix lengths that are features beside the whole word.
PREFIXES = (4, 5, 6, 7, 8)
#: Training: words around a labelled one, steps, step size and the weight of the penalty on squares.
CONTEXT, STEPS, RATE, PENALTY = 12, 150, 0.3, 1e-4
#: Marginals count as offending from here on.
OFFENDING = 0.5


def word_features(word: str) -> list[str]:
    """The features of one word: its lower-case form without marks at the ends, and that form's prefixes."""
    plain = word.lower().strip(".,;:!?\"'()[]{}<>*#$%&|-_")
    if not plain:
        return []
    return ["w=" + plain, *(f"p{n}={plain[:n]}" for n in PREFIXES if len(plain) > n)]


def families(texts: list[str]) -> list[int]:
    """A number per text, the same for most pairs of near copies: texts with the same least hash of their three-word runs, by either of two hashes."""
    import zlib

    above: dict[tuple[int, int], int] = {}
    parent = list(range(len(texts)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    for i, text in enumerate(texts):
        words = text.split()
        runs = [zlib.crc32(" ".join(words[k : k + 3]).encode("utf-8", "surrogatepass")) for k in range(max(1, len(words) - 2))]
        for k, factor in enumerate((2654435761, 2246822519)):
            first = above.setdefault((k, min(r * factor % 2**32 for r in runs)), i)
            parent[root(i)] = root(first)
    return [root(i) for i in range(len(texts))]


def toxic_features(texts: list[str], toxic: list[bool]) -> set[str]:
    """Features whose words are toxic: those that toxic families have and others hardly.

    The share of toxic families among those with the feature must be ``LEAST_PRECISION``, and so far from the share among all that by the
    Chernoff bound chance would make one such feature in ``CHANCE`` vocabularies.
    """
    own = families(texts)
    bad = {f for f, t in zip(own, toxic) if t}
    base = min(0.5, max(0.01, len(bad) / max(1, len(set(own)))))
    of = lambda text: {f for w in set(text.split()) for f in word_features(w)}
    members: dict[int, list[int]] = {}
    for i, f in enumerate(own):
        members.setdefault(f, []).append(i)
    with_it: Counter = Counter()
    for f in bad:
        with_it.update(set().union(*(of(texts[i]) for i in members[f] if toxic[i])))
    bar = math.log(max(1, len(with_it)) * CHANCE)
    with_it = Counter({f: n for f, n in with_it.items() if n * -math.log(base) >= bar})
    without: Counter = Counter()
    for f, rows in members.items():
        if f not in bad:
            without.update(set().union(*(of(texts[i]) & with_it.keys() for i in rows)))

    def far(n: int, all_: int) -> bool:
        share = n / all_
        apart = share * math.log(share / base) + ((1 - share) * math.log((1 - share) / (1 - base)) if share < 1 else 0.0)
        return share >= LEAST_PRECISION and all_ * apart >= bar

    return {f for f, n in with_it.items() if far(n, n + without[f])}


def train(texts: list[str], toxic: list[bool]) -> dict:
    """The field's weights: of features for the toxic label, its bias, and the transitions.

    Token labels: in toxic documents the words with a feature of ``toxic_features``; every other word is clean.
    """
    import numpy as np

    marks = toxic_features(texts, toxic)
    if not marks:
        return {"features": {}, "bias": -12.0, "moves": [[0.0, 0.0], [0.0, 0.0]]}
    names = {f: i for i, f in enumerate(sorted(marks))}
    sequences: list[tuple[list[list[int]], list[int]]] = []
    known: dict[str, list[int]] = {}
    for n, (text, bad) in enumerate(zip(texts, toxic)):
        words = text.split()
        active = [known[w] if w in known else known.setdefault(w, [names[f] for f in word_features(w) if f in names]) for w in words]
        hits = [i for i, a in enumerate(active) if a]
        if hits:  # windows around words that have features, overlapping ones as one
            start, end = max(0, hits[0] - CONTEXT), hits[0] + CONTEXT + 1
            for i in hits[1:] + [None]:
                if i is not None and i - CONTEXT <= end and end - start < 200:
                    end = i + CONTEXT + 1
                    continue
                span = range(start, min(end, len(words)))
                sequences.append(([active[j] for j in span], [int(bad and bool(active[j])) for j in span]))
                if i is not None:
                    start, end = max(end, i - CONTEXT), i + CONTEXT + 1
        elif n % 4 == 0:
            sequences.append(([[]] * min(len(words), 100), [0] * min(len(words), 100)))
    sequences = [s for s in sequences if s[1]]
    longest, k = max(len(s[1]) for s in sequences), len(names)
    rows, length = len(sequences), np.array([len(s[1]) for s in sequences])
    gold, here = np.zeros((rows, longest), int), np.arange(longest)[None, :] < length[:, None]
    at: list[tuple[int, int, int]] = []
    for r, (active, labels) in enumerate(sequences):
        gold[r, : len(labels)] = labels
        at += [(r, t, f) for t, fs in enumerate(active) for f in fs]
    where = np.array(at)
    flat = where[:, 0] * longest + where[:, 1]
    theta = np.zeros(k + 5)  # features, bias, transitions
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    seen = np.zeros_like(theta)
    np.add.at(seen, where[:, 2], gold.reshape(-1)[flat])
    seen[k] = (gold * here).sum()
    pairs = here[:, 1:]
    for a in (0, 1):
        for b in (0, 1):
            seen[k + 1 + 2 * a + b] = ((gold[:, :-1] == a) & (gold[:, 1:] == b) & pairs).sum()
    for step in range(1, STEPS + 1):
        weight = np.bincount(flat, theta[where[:, 2]], rows * longest).reshape(rows, longest) + theta[k]
        potential = np.stack([np.ones_like(weight), np.exp(np.clip(weight, -40, 40))], 2)
        move = np.exp(theta[k + 1 :].reshape(2, 2))
        forward, back = np.zeros_like(potential), np.ones_like(potential)
        forward[:, 0] = potential[:, 0] / potential[:, 0].sum(1, keepdims=True)
        for t in range(1, longest):
            x = (forward[:, t - 1] @ move) * potential[:, t]
            forward[:, t] = x / x.sum(1, keepdims=True)
        for t in range(longest - 2, -1, -1):
            x = (back[:, t + 1] * potential[:, t + 1]) @ move.T
            back[:, t] = np.where(here[:, t + 1 : t + 2], x / x.sum(1, keepdims=True), 1.0)
        both = forward * back
        marginal = (both[:, :, 1] / both.sum(2)) * here
        edge = forward[:, :-1, :, None] * move * (back * potential)[:, 1:, None, :]
        edge = edge / edge.sum((2, 3), keepdims=True) * pairs[:, :, None, None]
        expected = np.concatenate([np.bincount(where[:, 2], marginal.reshape(-1)[flat], k), [marginal.sum()], edge.sum((0, 1)).reshape(-1)])
        slope = (seen - expected) / rows - PENALTY * theta
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        theta += RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8) * min(1.0, 20 / step)
    return {"features": {f: float(theta[i]) for f, i in names.items()}, "bias": float(theta[k]), "moves": theta[k + 1 :].reshape(2, 2).tolist()}


def tagger(model: dict):
    """A function from a text to its score and the character spans of offending words with their marginals."""
    import re

    weights, bias = model["features"], model["bias"]
    (m00, m01), (m10, m11) = [[math.exp(x) for x in row] for row in model["moves"]]
    clean = math.exp(max(-40.0, bias))
    step = (m00, m01 * clean, m10, m11 * clean)  # on to a word without features
    powers = [(1.0, 0.0, 0.0, 1.0)]

    def times(a, b):
        x = (a[0] * b[0] + a[1] * b[2], a[0] * b[1] + a[1] * b[3], a[2] * b[0] + a[3] * b[2], a[2] * b[1] + a[3] * b[3])
        s = x[0] + x[1] + x[2] + x[3]
        return (x[0] / s, x[1] / s, x[2] / s, x[3] / s)

    def power(n: int):
        while n >= len(powers) and len(powers) < 512:
            powers.append(times(powers[-1], step))
        if n < len(powers):
            return powers[n]
        half = power(n // 2)
        return times(times(half, half), powers[n % 2])

    class Weights(dict):
        def __missing__(self, word: str) -> float:
            if len(self) >= 400_000:
                self.clear()
            self[word] = w = sum(weights.get(f, 0.0) for f in word_features(word))
            return w

    known = Weights()
    # A text without such words scores what one of its words would after a clean one: the same for all of them.
    base = min(0.5, clean * m01 / (m00 + clean * m01))

    def tag(text: str) -> tuple[float, list[tuple[int, int, float]]]:
        words = text.split()
        own = list(map(known.__getitem__, words))
        if not any(own):
            return (base if words else 0.0), []
        at = [i for i, w in enumerate(own) if w]
        potentials = [math.exp(min(40.0, max(-40.0, bias + own[i]))) for i in at]
        move = (m00, m01, m10, m11)
        # forward: what comes before a word, by its label
        f0, f1, forward = 1.0, 1.0, []
        for n, i in enumerate(at):
            gap = i - (at[n - 1] + 1 if n else 0)
            if n == 0 and gap == 0:
                f0, f1 = 1.0, 1.0
            else:
                if n == 0:  # the first word has no move before it
                    f0, f1, gap = 1.0, clean, gap - 1
                p = times(power(gap), move)
                f0, f1 = f0 * p[0] + f1 * p[2], f0 * p[1] + f1 * p[3]
            f1 *= potentials[n]
            s = f0 + f1
            f0, f1 = f0 / s, f1 / s
            forward.append((f0, f1))
        b0, b1, marginals = 1.0, 1.0, [0.0] * len(at)
        for n in range(len(at) - 1, -1, -1):
            after = (at[n + 1] if n + 1 < len(at) else len(words)) - at[n] - 1
            if n + 1 < len(at):
                p = times(power(after), move)
                x0, x1 = b0, b1 * potentials[n + 1]
                b0, b1 = p[0] * x0 + p[1] * x1, p[2] * x0 + p[3] * x1
            else:
                p = power(after)
                b0, b1 = p[0] + p[1], p[2] + p[3]
            s = b0 + b1
            b0, b1 = b0 / s, b1 / s
            x0, x1 = forward[n][0] * b0, forward[n][1] * b1
            marginals[n] = x1 / (x0 + x1)
        spared = 1.0
        for m in marginals:
            spared *= 1.0 - m
        offending = [(i, m) for i, m in zip(at, marginals) if m >= OFFENDING]
        spans = []
        if offending:
            wanted = dict(offending)
            for i, found in enumerate(re.finditer(r"\S+", text)):
                if i in wanted:
                    spans.append((found.start(), found.end(), wanted[i]))
        return 1.0 - spared, spans

    return tag


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", toxic: str = "toxic") -> dict:
    """The model from a bounded sample of labelled documents (``MOST_DOCUMENTS``, ``MOST_CHARACTERS``)."""
    marks = labels.where(F.col(toxic).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.max(toxic).alias("_toxic"))
    marks = written(hashed_sample(marks, MOST_DOCUMENTS, "_key"), "toxic-labels")
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).where(F.length("_text") <= MOST_CHARACTERS)
    sample = rows.join(F.broadcast(marks), "_key").orderBy("_key", "_text").limit(MOST_DOCUMENTS).collect()
    return train([r._text for r in sample], [r._toxic == 1 for r in sample])


def score(docs: DataFrame, model: dict, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``score`` (0 to 1) and ``spans`` (start, end, marginal) of every row, whole texts; nothing is shuffled.

    The score is the probability that not all words with features are clean, marginals taken as independent. NULL, empty and blank texts score
    0 and have no spans. Offsets are in code points. An empty table gives an empty one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa

        tag = tagger(shared.value)
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("marginal", pa.float64())]))
        for batch in batches:
            found = [tag(t.as_py() or "") for t in batch.column("_text")]
            spans = pa.array([[{"start": a, "end": b, "marginal": m} for a, b, m in s] for _, s in found], span)
            yield pa.RecordBatch.from_arrays([batch.column("_key"), pa.array([s for s, _ in found], "float64"), spans], names=["_key", "score", "spans"])

    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    kind = rows.schema["_key"].dataType.simpleString()
    tagged = rows.mapInArrow(run, f"_key {kind}, score double, spans array<struct<start:int,end:int,marginal:double>>")
    return tagged.withColumnRenamed("_key", key)


ship_by_value(__name__)
