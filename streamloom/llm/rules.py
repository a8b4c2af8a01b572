"""Quality rules: learned decision lists.

Sequential covering over labelled statistics: a rule is grown condition by condition on two thirds of the labelled rows,
pruned on the other third, and kept if it is precise there; what it covers is taken out before the next rule. Conditions are thresholds
on text statistics. The list is emitted as one ordered conditional expression. All counts are grouped
aggregates over all labelled rows; the driver sees one count per feature, threshold and class.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from streamloom.llm.common import BLANKS, fresh, uniform, words, written

SYMBOLS = "#*$%&|<>"
STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Quantiles per class from which the thresholds come.
QUANTILES = 32
#: Limits of the search: rules in the list, conditions in a rule, and the precision a rule needs on the pruning rows.
MOST_RULES, MOST_CONDITIONS, PRECISION = 8, 3, 0.95

#: (feature, "<=" or ">", threshold)
Condition = tuple[str, str, float]


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the five ``STATISTICS`` (long) of each whole text; NULL has none of anything.

    A text's three-word windows are hashed, sorted with their places and compared with their neighbours inside the row, so nothing is
    shuffled. Hashes have 64 bits whatever the length of the text.
    """
    kept = [c for c in docs.columns if c not in STATISTICS]
    w, runs, again, lines = (fresh(*kept) for _ in range(4))
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(*[F.col(f"`{c}`") for c in kept])
    rows = rows.withColumn(w, words(F.col(text))).withColumn(lines, F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    run = lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("place"))
    places = F.when(F.size(w) >= 3, F.sequence(F.lit(0), F.size(w) - 3)).otherwise(F.array().cast("array<int>"))
    rows = rows.withColumn(runs, F.sort_array(F.transform(places, run)))
    twice = F.filter(runs, lambda x, i: (x.h == F.get(runs, i + 1)["h"]) | (x.h == F.get(runs, i - 1)["h"]))
    rows = rows.withColumn(again, twice)
    covered = F.array_distinct(F.flatten(F.transform(again, lambda x: F.array(x.place, x.place + 1, x.place + 2))))
    made = {
        "n_words": F.size(w),
        "word_chars": F.length(F.translate(body, BLANKS, "")),
        "n_symbols": F.length(body) - F.length(F.translate(body, SYMBOLS, "")),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": F.when(F.size(again) > 0, F.size(covered)).otherwise(0),
    }
    return rows.select(*[F.col(f"`{c}`") for c in kept], *[v.cast("long").alias(k) for k, v in made.items()])


def features() -> dict[str, Column]:
    """What conditions are about: the statistics of a text, those that grow with its length as shares."""
    n, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    return {
        "words": F.col("n_words").cast("double"),
        "word_length": F.col("word_chars") / n,
        "symbol_share": F.col("n_symbols") / chars,
        "dup_lines": F.col("n_dup_lines").cast("double"),
        "repeat_share": F.col("n_repeat_words") / n,
    }


def holds(rule: Sequence[Condition], of: Callable[[str], Column]) -> Column:
    tests = [of(f) > F.lit(t) if sign == ">" else of(f) <= F.lit(t) for f, sign, t in rule]
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def thresholds(labelled: DataFrame, names: Sequence[str]) -> dict[str, list[float]]:
    """Candidates per feature: halfway between neighbouring quantiles of either class."""
    cuts = [k / QUANTILES for k in range(QUANTILES + 1)]
    found = labelled.groupBy("bad").agg(*[F.percentile_approx(n, cuts, 10_000).alias(n) for n in names]).collect()
    out = {}
    for n in names:
        seen = sorted({v for row in found for v in row[n]})
        out[n] = [(a + b) / 2 for a, b in zip(seen, seen[1:])]
    return out


def learn(labelled: DataFrame, names: Sequence[str]) -> list[list[Condition]]:
    """The rules for rejecting, in order. ``labelled`` has ``bad`` (boolean), ``grow`` (boolean) and the features.

    Rows are first counted by their bins, so the search runs over a small table whatever the number of labels.
    """
    cuts = thresholds(labelled, names)
    names = [n for n in names if cuts[n]]
    if not names:
        return []
    # A row's bin is the number of thresholds below its value: "> threshold k" is "bin > k".
    bin_of = lambda n: F.size(F.filter(F.array(*[F.lit(c) for c in cuts[n]]), lambda c: c < F.col(n)))
    bins = [bin_of(n).alias(n) for n in names]
    cube = written(labelled.select("bad", "grow", *bins).groupBy("bad", "grow", *names).agg(F.count("*").alias("n")), "rule-cube")
    in_bins = lambda rule: holds([(f, s, k) for f, s, k in rule], F.col)

    def table_of(rows: DataFrame) -> dict[str, dict[int, list[int]]]:
        pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("f"), F.col(n).alias("bin")) for n in names])).alias("x")
        got = rows.select("bad", "n", pairs).groupBy("x.f", "x.bin").agg(F.sum(F.when(F.col("bad"), F.col("n")).otherwise(0)).alias("p"), F.sum("n").alias("all")).collect()
        out: dict[str, dict[int, list[int]]] = {n: {} for n in names}
        for r in got:
            out[r.f][r.bin] = [r.p, r["all"] - r.p]
        return out

    rules: list[list[tuple[str, str, int]]] = []
    left = cube
    while len(rules) < MOST_RULES:
        rule: list[tuple[str, str, int]] = []
        while len(rule) < MOST_CONDITIONS:
            counts = table_of(left.where("grow").where(in_bins(rule)))
            p0, n0 = (sum(v[i] for v in counts[names[0]].values()) for i in (0, 1))
            if not p0 or rule and not n0:
                break
            best, gain = None, 1e-9
            for f in names:
                p = n = 0
                for k in range(len(cuts[f])):  # p, n: rows in bins up to k
                    a, b = counts[f].get(k, (0, 0))
                    p, n = p + a, n + b
                    for sign, pp, nn in (("<=", p, n), (">", p0 - p, n0 - n)):
                        if pp:
                            g = pp * (math.log((pp + 1e-9) / (pp + nn + 1)) - math.log(p0 / (p0 + n0)))
                            if g > gain:
                                best, gain = (f, sign, k), g
            if best is None:
                break
            rule.append(best)
        if not rule:
            break
        tests = [F.sum(F.when(in_bins(rule[: k + 1]) & (F.col("bad") == F.lit(side)), F.col("n")).otherwise(0)) for k in range(len(rule)) for side in (True, False)]
        row = list(left.where("NOT grow").agg(*tests).first())
        value = lambda k: ((row[2 * k] or 0) - (row[2 * k + 1] or 0)) / max(1, (row[2 * k] or 0) + (row[2 * k + 1] or 0))
        size = max(range(len(rule)), key=lambda k: (value(k), row[2 * k] or 0, -k))
        p, n = row[2 * size] or 0, row[2 * size + 1] or 0
        if p < 2 or p / (p + n) < PRECISION:
            break
        rules.append(rule[: size + 1])
        left = left.where(~in_bins(rules[-1]))
    return [[(f, s, cuts[f][k]) for f, s, k in rule] for rule in rules]


def as_text(rule: Sequence[Condition]) -> str:
    return " and ".join(f"{f} {sign} {t:.6g}" for f, sign, t in rule)


def decision(rules: Sequence[Sequence[Condition]], columns: dict[str, Column]) -> Column:
    """The list as one conditional expression: the text of the first rule that holds, else NULL."""
    return reduce(lambda rest, r: F.when(holds(r, columns.__getitem__), F.lit(as_text(r))).otherwise(rest), reversed(rules), F.lit(None).cast("string"))


def judge(docs: DataFrame, labels: DataFrame, base: Column | None = None, key: str = "doc_id", text: str = "text", good: str = "quality") -> DataFrame:
    """``key``, the ``STATISTICS``, ``base_failed``, ``rule`` and ``kept``, a row for each row of ``docs``.

    ``base`` is a condition on the statistics that rejects before the list does. Labels that are NULL, or of unknown keys, are
    left out; a key that is labelled twice counts twice. Without labels of both classes the list is empty and rejects nothing. An empty
    table gives an empty one. Other columns of ``docs`` are ignored.
    """
    facts = written(with_statistics(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), "text").drop("text"), "statistics")
    marks = labels.where(F.col(good).isNotNull()).select(F.col(key).alias("key"), (F.col(good) == 0).alias("bad"))
    columns = features()
    grow = uniform(F.lit("grow"), F.coalesce(F.col("key").cast("string"), F.lit(""))) < F.lit(2 / 3)
    labelled = written(facts.join(marks, "key").select("bad", grow.alias("grow"), *[c.alias(n) for n, c in columns.items()]), "labelled")
    both = labelled.agg(F.max("bad"), F.min("bad")).first()
    rules = learn(labelled, list(columns)) if both[0] is True and both[1] is False else []
    base_failed = F.coalesce(base, F.lit(False)) if base is not None else F.lit(False)
    out = facts.withColumn("base_failed", base_failed).withColumn("rule", decision(rules, columns))
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull()).withColumnRenamed("key", key)
