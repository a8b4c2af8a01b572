"""Operators over the whole corpus: mixing, sharding, quality, rules, decontamination, near-duplicates, the pipeline."""

import collections
import hashlib
import itertools
import math
import random
import re
import sys
import tracemalloc
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))
from helpers import DOCS, awkward_docs, bag, empty_docs, labels, read, with_clashes  # noqa: E402

from streamloom.llm import common, decontaminate, neardup, quality, rules  # noqa: E402
from streamloom.llm.components import components  # noqa: E402
from streamloom.llm.mixing import mix, mixed  # noqa: E402
from streamloom.llm.queries import QUERIES  # noqa: E402
from streamloom.llm.sharding import fisher_yates, shuffle_into_shards, write_shards  # noqa: E402


def words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


# --- mixing -----------------------------------------------------------------------------------------------------


def filled(sizes, weights, share, most):
    """Targets by repeated resharing."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_, rest = {}, set(sizes), share * sum(sizes.values())
    while open_:
        level = rest / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > most * sizes[s]}
        if not full:
            return target | {s: level * weight[s] for s in open_}
        for s in full:
            target[s] = most * sizes[s]
            rest -= target[s]
        open_ -= full
    return target


def test_mix_meets_its_targets(spark, sf):
    docs = read(sf, "documents")
    got = QUERIES["op2_pareto_mix"](spark, sf).toPandas().set_index("doc_id")
    assert len(got) == len(docs)
    source = dict(zip(docs.doc_id, docs.source))
    size = {r.doc_id: len(words(r.text)) for r in docs.itertuples()}
    assert got["size"].to_dict() == size
    total, taken = collections.Counter(), collections.Counter()
    for d, s in source.items():
        total[s] += size[d]
        taken[s] += got.taken[d]
        assert got.taken[d] <= 2 * size[d] and got.taken[d] % max(1, size[d]) == 0
    want = filled(dict(total), (5, 2, 1), 1.5, 2.0)
    longest = {s: max(size[d] for d in size if source[d] == s) for s in total}
    for s in total:
        assert got.target[[d for d in source if source[d] == s]].to_numpy() == pytest.approx(want[s])
        assert abs(taken[s] - want[s]) <= longest[s] / 2 + 1
    again = QUERIES["op2_pareto_mix"](spark, sf).toPandas().set_index("doc_id")
    assert got.taken.to_dict() == again.taken.to_dict()


def test_mix_of_awkward_rows(spark):
    docs = with_clashes(awkward_docs(spark))
    got = mix(docs, (5, 2, 1))
    assert got.count() == docs.count()
    assert got.where("copies < 0 OR copies > 2 OR copies IS NULL").count() == 0
    assert got.where("target > 2 * source_size + 1e-6").count() == 0
    nothing = got.where("source IS NULL").select("source_size", "target").distinct().collect()
    assert [tuple(r) for r in nothing] == [(0, 0.0)]
    whole = mixed(docs, (5, 2, 1))
    assert whole.columns == docs.columns and whole.where("size <> 'own'").count() == 0
    assert whole.count() == got.agg(F.sum("copies")).first()[0]
    assert mix(empty_docs(spark), (5, 2, 1)).collect() == [] == mixed(empty_docs(spark), (1,)).collect()


def test_odds_favour_documents(spark):
    rows = [(i, "w " * 10, "en", "a", 3.0 if i % 2 else 1 / 3) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, odds double")
    got = mix(docs, (1,), share=0.5, odds="odds").groupBy("odds").agg(F.sum("copies").alias("n")).orderBy("odds").collect()
    assert sum(r.n for r in got) == 1000 and got[1].n > 2 * got[0].n


def test_chances_grow_with_size_and_sum_to_the_words_wanted(spark):
    """Sources of the same sizes, 40 % of whose words are wanted: documents come in about as often as scale times size, the largest always."""
    random.seed(6)
    sizes, sources = [300] + [random.randint(1, 30) for _ in range(120)], range(30)
    docs = spark.createDataFrame([(1000 * s + i, "w " * n, "", f"s{s}", 1) for s in sources for i, n in enumerate(sizes)], DOCS)
    want, certain = 0.4 * sum(sizes), set()
    while True:
        rest = [n for i, n in enumerate(sizes) if i not in certain]
        scale = (want - sum(sizes[i] for i in certain)) / sum(n * n for n in rest)
        more = {i for i, n in enumerate(sizes) if i not in certain and scale * n >= 1}
        if not more:
            break
        certain |= more
    assert 0 in certain
    got, seen = {r.doc_id: r.copies for r in mix(docs, (1,), share=0.4, seed=6).collect()}, collections.Counter()
    assert set(got.values()) <= {0, 1} and all(got[1000 * s + i] == 1 for s in sources for i in certain)
    for s in sources:
        assert abs(sum(got[1000 * s + i] * n for i, n in enumerate(sizes)) - want) <= 15
        seen.update(i for i in range(len(sizes)) if got[1000 * s + i])
    for low, high in ((1, 8), (9, 16), (17, 30)):
        own = [i for i, n in enumerate(sizes) if low <= n <= high and i not in certain]
        expected = sum(scale * sizes[i] for i in own) * len(sources)
        assert abs(sum(seen[i] for i in own) - expected) < 5 * expected**0.5 + 5


def test_without_words_nothing_is_taken(spark):
    docs = spark.createDataFrame([(1, None, "en", "a", 0), (2, "", "en", None, 0)], DOCS)
    assert mix(docs, (1,)).agg(F.sum(F.col("copies") * F.col("size"))).first()[0] == 0


# --- sharding ---------------------------------------------------------------------------------------------------


def test_shards_hold_every_row_once(spark, sf):
    docs = read(sf, "documents")
    got = QUERIES["op8_external_shuffle"](spark, sf).toPandas()
    assert sorted(got.doc_id) == sorted(docs.doc_id) and set(got.law) == {"rows"}
    for r in got.merge(docs, on="doc_id").itertuples():
        assert (r.size, r.text_crc32) == (len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode()))
    counts = got.groupby("shard").slot.agg(["count", "min", "max"])
    assert list(counts.index) == list(range(8)) and counts["count"].max() - counts["count"].min() <= 1
    assert (counts["min"] == 0).all() and (counts["max"] + 1 == counts["count"]).all() and not got.duplicated(["shard", "slot"]).any()
    place = got.sort_values(["shard", "slot"]).doc_id.tolist()
    assert place != sorted(place)


@pytest.mark.parametrize("bucket_bytes", [200, 1 << 20])
def test_shards_of_awkward_rows(spark, bucket_bytes):
    docs = with_clashes(awkward_docs(spark)).repartition(3)
    got = shuffle_into_shards(docs, 5, seed=1, bucket_bytes=bucket_bytes)
    assert set(got.columns) == set(docs.columns)
    assert bag(got, "doc_id", "text", "lang", "source", "size") == bag(docs, "doc_id", "text", "lang", "source", "size")
    rows = got.groupBy("shard").agg(F.count("*").alias("n"), F.max("slot").alias("m")).collect()
    assert {r.n for r in rows} <= {2, 3} and all(r.m == r.n - 1 for r in rows)
    assert shuffle_into_shards(empty_docs(spark), 5).collect() == []


def test_copies_of_one_row_are_scattered(spark):
    docs = spark.range(0, 4000, 1, 8).select(F.lit(1).cast("long").alias("doc_id"), F.lit("same text").alias("text"))
    got = shuffle_into_shards(docs, 4, bucket_bytes=40_000)
    assert sorted(r["count"] for r in got.groupBy("shard").count().collect()) == [1000] * 4


def test_shuffle_orders_are_uniform_and_repeat():
    assert fisher_yates(50, 3, 1) == fisher_yates(50, 3, 1) != fisher_yates(50, 3, 2)
    seen = collections.Counter(tuple(fisher_yates(3, s, 0)) for s in range(6000))
    assert len(seen) == 6 and all(850 < n < 1150 for n in seen.values())


def test_shards_as_files(spark, tmp_path):
    placed = shuffle_into_shards(spark.range(100).select(F.col("id").alias("doc_id"), F.lit("x").alias("text")), 4)
    write_shards(placed, str(tmp_path / "s"))
    assert sorted(p.name for p in (tmp_path / "s").glob("shard=*")) == [f"shard={k}" for k in range(4)]
    assert spark.read.parquet(str(tmp_path / "s")).count() == 100


# --- quality ----------------------------------------------------------------------------------------------------


def test_resample_separates_held_out_labels(spark, sf):
    sf = sf.replace("sf0.001", "sf0.01")
    marks = spark.read.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = quality.resample(docs, marks.where("doc_id % 2 = 0"), seed=3).toPandas()
    assert len(got) == 1000
    held = got.merge(read(sf, "labels"), on="doc_id").query("doc_id % 2 == 1")
    assert held[held.quality == 1].kept.mean() > 0.98 and held[held.quality == 0].kept.mean() < 0.1
    again = quality.resample(docs.repartition(5), marks.where("doc_id % 2 = 0"), seed=3).toPandas()
    assert dict(zip(got.doc_id, got.kept)) == dict(zip(again.doc_id, again.kept))


def plain_grams(text):
    """The buckets of a text's n-grams, word by word in whole numbers."""
    odd, ones = 0x9E3779B97F4A7C15, (1 << 64) - 1
    kinds = [r"[^\w]+", r"[^\W\d_]+[^\w\s]?", r"\W*\d[\d\W]*", r"\w+\W{2,}", r"\w+(\W\w+)+\W?"]
    w, had, states, grams = text.split(), set(), [], []
    for i, word in enumerate(w):
        kind = next((k for k, p in enumerate(kinds) if re.fullmatch(p, word)), 5)
        capital = word.upper() == word and word.lower() != word
        kind = {(1, True): 7 if len(word) > 2 else 1, (3, True): 6}.get((kind, capital), kind)
        run = tuple(w[i - 2:i + 1]) if i > 1 else None
        seen = 3 if run in had else 0
        had |= {run} if run else set()
        if any(i >= d and w[i - d] == word for d in (2, 3)):
            seen = 2
        if i and w[i - 1] == word:
            seen = 1
        states.append(kind * 4 + seen + 1)
        code, last = zlib.crc32(word.encode()), zlib.crc32(w[i - 1].encode()) if i else 0
        grams.append(code * odd)
        if i:
            grams.append((last * odd + code) * odd + 1)
        grams.append(states[i] * odd + 2)
        grams.append(sum(states[i - d] << 6 * d for d in range(min(i, 2) + 1)) * odd + 3)
    grams = [g & ones for g in grams]
    return [((g ^ g >> 29) * odd & ones) >> 48 for g in grams]


def test_resample_against_plain_python(spark, sf):
    docs = read(sf, "documents")
    texts = {d: t or "" for d, t in zip(docs.doc_id, docs.text)}
    marks = read(sf, "labels").dropna(subset=["quality"])
    good = {d: int(q) for d, q in zip(marks.doc_id, marks.quality) if d in texts}
    grams = {d: plain_grams(t) for d, t in texts.items()}
    raw, target = collections.Counter(), collections.Counter()
    for d, g in grams.items():
        raw.update(g)
        target.update(g if good.get(d) == 1 else [])
    model = lambda c, g: (c[g] + 1) / (c.total() + 65536)
    ratio = {g: math.log(model(target, g)) - math.log(model(raw, g)) for g in raw}
    weight = {d: 60 * sum(ratio[x] for x in g) / len(g) if g else 0.0 for d, g in grams.items()}
    at = lambda values, share: sorted(values)[max(0, math.ceil(share * len(values)) - 1)]
    middle = (at([weight[d] for d, q in good.items() if q], 0.005) + at([weight[d] for d, q in good.items() if not q], 0.995)) / 2
    key = {}
    for d, t in texts.items():
        tie = xxhash.xxh64_intdigest(t.encode(), 42)
        tie -= (tie >> 63) << 64
        draw = int(hashlib.md5(f"3|{d}|{tie}".encode()).hexdigest()[:12], 16)
        key[d] = weight[d] - math.log(-math.log((draw + 0.5) / 2**48))
    k = round(sum(1 / (1 + math.exp(middle - x)) for x in weight.values()))
    kept = set(sorted(key, key=key.get, reverse=True)[:k])
    assert 0 < k < len(texts)
    got = QUERIES["op3_importance_resampling"](spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        assert r.log_weight == pytest.approx(weight[r.doc_id], abs=1e-6) and r.gumbel_key == pytest.approx(key[r.doc_id], abs=1e-6)
        assert r.kept == (r.doc_id in kept)


def test_top_k_is_exact(spark):
    random.seed(1)
    keys = [random.choice([random.random(), 0.5, 0.25 + random.random() * 1e-9]) for _ in range(3000)]
    rows = spark.createDataFrame([(k,) for k in keys], "rank_key double")
    for k in (1, 7, 500, 1500, 3000):
        assert quality.top_k(rows, k) == sorted(keys, reverse=True)[k - 1]


def test_resample_of_awkward_rows(spark):
    docs = with_clashes(awkward_docs(spark))
    mixed_labels = labels(spark, [(1, 1, 0), (9, 0, 0), (9, 1, 0), (None, 1, 0), (2, None, 0), (77, 1, 1)])
    for marks in (labels(spark), mixed_labels, labels(spark, [(1, 1, 0)])):
        got = quality.resample(docs, marks)
        assert got.count() == docs.count() and got.where("kept IS NULL OR log_weight IS NULL").count() == 0
        assert got.where("doc_id IN (3, 4, 5) AND log_weight <> 0").count() == 0
        kept = quality.keep_good(docs, marks)
        assert kept.columns == docs.columns and kept.count() == got.where("kept").count()
    assert quality.resample(docs, labels(spark)).where("NOT kept").count() == 0
    assert quality.keep_good(empty_docs(spark), mixed_labels).collect() == []


# --- rules ------------------------------------------------------------------------------------------------------


def plain_statistics(text):
    w = words(text)
    count = collections.Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i in range(len(w) - 2) if count[w[i], w[i + 1], w[i + 2]] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_statistics_and_verdicts(spark, sf):
    sf = sf.replace("sf0.001", "sf0.01")
    docs = read(sf, "documents").set_index("doc_id").text
    got = QUERIES["op7_decision_list"](spark, sf).toPandas()
    assert len(got) == len(docs)
    for r in got.itertuples():
        stats = plain_statistics(docs[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == stats
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed and r.rule is None)
    both = got.merge(read(sf, "labels"), on="doc_id")
    both = both[~both.base_failed]
    assert both[both.quality == 1].kept.mean() > 0.97 and both[both.quality == 0].kept.mean() < 0.2


def test_rules_hold_on_labels_they_have_not_seen(spark, sf):
    sf = sf.replace("sf0.001", "sf0.1")
    docs, marks = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = rules.judge(docs, marks.where("doc_id % 2 = 0")).toPandas()
    held = got.merge(read(sf, "labels"), on="doc_id").query("doc_id % 2 == 1")
    assert held[held.quality == 1].kept.mean() > 0.98 and held[held.quality == 0].kept.mean() < 0.1


def test_rules_need_both_conditions(spark):
    """Bad rows are those with large a and small b; a rule of one condition does not do."""
    random.seed(2)
    rows = [(a, b, a > 0.5 and b < 0.3, random.random() < 0.67) for a, b in ((random.random(), random.random()) for _ in range(3000))]
    found = rules.learn(spark.createDataFrame(rows, "a double, b double, bad boolean, grow boolean"), ["a", "b"])
    assert found and {f for f, _, _ in found[0]} == {"a", "b"}
    for f, sign, t in found[0]:
        assert (f, sign) in (("a", ">"), ("b", "<=")) and abs(t - {"a": 0.5, "b": 0.3}[f]) < 0.1


def test_a_very_long_text_of_different_words_repeats_nothing(spark):
    long = spark.range(1).select(F.lit(1).alias("doc_id"), F.array_join(F.transform(F.sequence(F.lit(1), F.lit(4_500_000)), lambda i: i.cast("string")), " ").alias("text"))
    got = rules.with_statistics(long).first()
    assert (got.n_words, got.n_repeat_words) == (4_500_000, 0)


def test_statistics_of_awkward_rows(spark):
    docs = with_clashes(awkward_docs(spark))
    got = rules.with_statistics(docs)
    assert got.count() == docs.count() and "size" in got.columns
    for r in got.collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain_statistics(r.text)
    for marks in (labels(spark), labels(spark, [(1, 1, 0), (9, 0, 0), (9, 0, 0), (None, 0, 0), (2, None, 0)])):
        assert rules.judge(docs, marks).count() == docs.count()
    assert rules.judge(docs, labels(spark)).where("NOT kept").count() == 0
    assert rules.judge(empty_docs(spark), labels(spark, [(1, 1, 0)])).collect() == []


# --- decontamination --------------------------------------------------------------------------------------------

ITEM = "if Anna walks 5 km in the morning and 7 km in the evening how far does Anna walk on a day with 5 km more than usual"


def bench(spark, *items):
    return spark.createDataFrame(list(enumerate(items)), "item_id long, text string")


def found(spark, texts, *items):
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in enumerate(texts)], DOCS)
    return {r.doc_id: r.item_id for r in decontaminate.judge_contamination(docs, bench(spark, *items)).collect() if r.contaminated}


def test_changed_parameters_are_caught_if_consistent(spark):
    changed = ITEM.replace("Anna", "Bob").replace("5", "11").replace("7", "23").replace("km", "mi")
    crossed = ITEM.replace("Anna", "Bob", 1).replace("5", "11", 1).replace("7", "11").replace("Anna", "Carl")
    other = "nothing of the kind is asked here but a long enough sentence is written all the same to have windows"
    texts = [ITEM, f"some words before {ITEM} and some after", changed, crossed, other, ITEM.replace(" ", "\n"), "", None]
    assert found(spark, texts, ITEM, None, "", "zzz") == {0: 0, 1: 0, 2: 0, 5: 0}


def test_short_items_and_repeats(spark):
    got = found(spark, ["we ask what color is water here", "WHAT COLOR", "what color is water", ITEM], "what color is water", "what color is water", "Name Name")
    assert got == {0: 0, 2: 0}


def test_copies_in_other_case_are_caught(spark):
    title = "The Heatou Ononat Of Erblein Whas Into Thed Reresh And Tisher"
    texts = [f"some words before {ITEM.upper()} and some after", ITEM.title(), ITEM, f"here {title.lower()} ends", title.upper(), "NOTHING OF THE KIND IS ASKED HERE"]
    assert found(spark, texts, ITEM, title) == {0: 0, 1: 0, 2: 0, 3: 1, 4: 1}
    assert found(spark, [ITEM, "WIE VIELE STRASSEN LIEGEN IN DER STADT DORT"], ITEM.upper(), "wie viele straßen liegen in der stadt dort") == {0: 0, 1: 1}


def test_items_with_a_word_more_or_quoted_in_part_are_caught(spark):
    w = ITEM.split()
    half = len(w) // 2
    more, other = " ".join([*w[:half], "zebra", *w[half:]]), " ".join([*w[:half], "zebra", *w[half + 1 :]])
    names = ITEM.replace("Anna", "the girl")
    quoted, few = f"we quote {' '.join(w[:14])} and leave it", f"we quote {' '.join(w[:9])} and leave it"
    crossed = names.replace("5", "11", 1).replace("7", "11")
    assert found(spark, [more, other, names, quoted, few, crossed], ITEM) == {0: 0, 1: 0, 2: 0, 3: 0}
    short = "how many of the red apples in this basket are left once nine have gone away".split()
    more = " ".join([*short[:8], "zebra", *short[8:]])
    assert found(spark, [more, " ".join(short[:10])], " ".join(short)) == {0: 0}


def test_items_without_plain_words_are_caught_whole(spark):
    sums, names, short = "12 + 15 = 27 and 31 + 44 = 75 and 8 + 9 = 17 so 3 + 4 = 7", "Anna Berta Carla", "3.5 x 7"
    texts = [f"we see {sums} there", sums.replace("27", "28"), f"then {names.upper()} came", "then Anna and Berta came", f"take {short} now", "1 2 3 4 5 6 7 8 9"]
    assert found(spark, texts, sums, names, "3.5 7", short) == {0: 0, 1: 0, 2: 1, 4: 3}
    assert found(spark, ["a 3.5 7 b", "a 3.5 8 b"], "3.5 7") == {0: 0}


def test_whole_items_in_documents(spark, sf):
    docs, items = read(sf, "documents"), read(sf, "benchmark").text
    got = QUERIES["op9_template_decontamination"](spark, sf).toPandas()
    assert len(got) == len(docs)
    want = {r.doc_id for r in docs.itertuples() if any(x in (r.text or "") for x in items)}
    assert set(got[got.contaminated].doc_id) == want


def test_decontamination_of_awkward_rows(spark):
    docs = with_clashes(awkward_docs(spark))
    item = bench(spark, "the quick brown fox jumps over the lazy dog and runs far away from here today")
    kept = decontaminate.keep_uncontaminated(docs, item)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 2
    assert decontaminate.judge_contamination(docs, item).count() == docs.count()
    assert decontaminate.keep_uncontaminated(docs, bench(spark, None)).count() == docs.count()
    assert decontaminate.keep_uncontaminated(docs, bench(spark, "x").where("false")).count() == docs.count()
    assert decontaminate.keep_uncontaminated(empty_docs(spark), item).collect() == []


# --- near-duplicates --------------------------------------------------------------------------------------------


def plain_sets(texts, size):
    out = []
    for t in texts:
        w = words((t or "").translate({o: o + 32 for o in range(65, 91)}))
        out.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    return out


def plain_components(ids, texts, size, share):
    sets, parent = plain_sets(texts, size), list(range(len(ids)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both * share[1] >= len(sets[i] | sets[j]) * share[0]:
                a, b = sorted((root(i), root(j)), key=lambda k: ids[k])
                parent[b] = a
    return {ids[i]: (len(sets[i]), ids[root(i)]) for i in range(len(ids))}


def near_copies(n, length, edits, seed):
    random.seed(seed)
    base = [f"w{random.randint(0, 10_000)}" for _ in range(length)]
    out = []
    for _ in range(n):
        text = list(base)
        for _ in range(random.randint(0, edits)):
            text[random.randrange(length)] = f"x{random.randint(0, 10**9)}"
        out.append(" ".join(text))
    return out


@pytest.mark.parametrize("size, share", [(3, (85, 100)), (5, (80, 100))])
def test_components_equal_brute_force(spark, size, share):
    texts = [t for k in range(12) for t in near_copies(9, 120, 8, k)] + ["", None, "a", "A", "b c", "B  c", "b c d"] + near_copies(40, 200, 1, 99)
    texts += [t + " some more words at the end" for t in texts[:20]]
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in enumerate(texts)], DOCS)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(docs, size, share).collect()}
    want = plain_components(list(range(len(texts))), texts, size, share)
    assert got == {i: (n, c, c == i) for i, (n, c) in want.items()}


@pytest.mark.parametrize("levels", [2, 0])
def test_large_nodes_lose_no_link(spark, monkeypatch, levels):
    """Nodes far over the limit: a group of near copies, and a passage that many other texts share."""
    monkeypatch.setattr(neardup, "SMALL", 40)
    monkeypatch.setattr(neardup, "MOST_LEVELS", levels)
    random.seed(3)
    passage = " ".join(f"p{i}" for i in range(60))
    shared = [passage + " " + " ".join(f"u{random.randint(0, 10**6)}" for _ in range(random.randint(20, 60))) for _ in range(150)]
    texts = near_copies(150, 100, 6, 7) + shared
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in enumerate(texts)], DOCS)
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs, 3, (85, 100)).collect()}
    want = plain_components(list(range(len(texts))), texts, 3, (85, 100))
    assert got == {i: c for i, (_, c) in want.items()}


def test_trees_keep_the_promise_at_every_depth():
    for share in (0.8, 0.85, 0.9):
        for large in range(neardup.MOST_LEVELS + 1):
            assert neardup.missed(share, large) ** neardup.trees_for(share, large) <= 1e-6
    assert neardup.trees_for(0.85, 0) == 4 and neardup.trees_for(0.8, 0) == 5 and neardup.trees_for(1.0, 0) == 2


def test_pairs_under_large_nodes_get_more_trees(spark, monkeypatch):
    """Texts of one template, so that nodes stay large on many levels, with a near copy of each."""
    monkeypatch.setattr(neardup, "SMALL", 8)
    begun = []
    monkeypatch.setattr(neardup, "roots", lambda signatures, trees, real=neardup.roots: begun.append(trees) or real(signatures, trees))
    random.seed(5)
    template, texts = [f"p{i}" for i in range(120)], []
    for i in range(30):
        own = [f"u{i}x{k}" for k in range(60)]
        texts += [" ".join(template + own), " ".join(template + own + [f"v{i}x{k}" for k in range(25)])]
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in enumerate(texts)], DOCS)
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs, 3, (85, 100)).collect()}
    want = plain_components(list(range(len(texts))), texts, 3, (85, 100))
    assert got == {i: c for i, (_, c) in want.items()} and len(set(got.values())) == 30
    assert begun[:2] == [range(1), range(1, 4)] and len(begun) > 2 and begun[2].start == 4


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 200), (200, 100), (5, 5), (300, 100)]
    random.shuffle(edges)
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {i: 0 for i in range(1, 61)} | {200: 100, 300: 100}


def test_near_duplicates_of_awkward_rows(spark):
    docs = with_clashes(awkward_docs(spark).union(spark.createDataFrame([(None, "single", "en", "a", 1), (11, "a text WITHOUT any key at all", "en", "a", 1)], DOCS)))
    got = neardup.near_duplicates(docs)
    assert got.count() == docs.count()
    by = collections.defaultdict(list)
    for r in got.collect():
        by[r.doc_id].append((r.n_shingles, r.component_id, r.kept))
    assert by[1] == [(12, 1, True)] and by[2] == [(12, 1, False)] and by[3] == by[4][:0] + [(0, 3, True)] and by[5] == [(0, 5, True)]
    assert by[7] == [(1, 7, True)] * 2 and sorted(by[None], key=repr) == sorted([(3, 11, False), (0, None, True), (1, 7, False)], key=repr)
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == got.where("kept").count()
    assert neardup.near_duplicates(empty_docs(spark)).collect() == [] == neardup.keep_one(empty_docs(spark)).collect()


class OneTask:
    """A frame whose whole work is one task of this process."""

    def __init__(self, table):
        self.table = table

    def repartition(self, *_):
        return self

    sortWithinPartitions = repartition

    def mapInArrow(self, run, _):
        return OneTask(pa.Table.from_batches(list(run(iter(self.table.to_batches())))))

    def distinct(self):
        return self.table


@pytest.mark.parametrize("held", [neardup.MOST_HELD, 1])
def test_a_group_of_near_copies_needs_little_memory(monkeypatch, held):
    """500 near copies are 125,000 pairs of like signatures; a task that listed them all took 20 MB and more, and 16 times that for 2,000."""
    monkeypatch.setattr(neardup, "MOST_HELD", held)
    texts = near_copies(500, 60, 2, 4) + near_copies(3, 60, 0, 5)
    shingles, factors, least = neardup.shingler(3), neardup.multipliers(), neardup.least_agreement(0.8)
    short = [neardup.signature(shingles(t), factors).view("uint8")[::4].tobytes() for t in texts]
    keys = [b"%04d" % i for i in range(len(texts))]
    tracemalloc.start()
    group = {"key": pa.array(keys), "label": pa.array(keys), "short": pa.array(short)}
    clusters = neardup.compare_parts(OneTask(pa.table({"part": [1] * len(texts), **group})), least)
    compared = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    links = neardup.confirm(OneTask(pa.table({"cluster": [1] * len(texts), **group, "text": texts})), 3, (80, 100), least)
    confirmed = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert max(compared, confirmed) < 12e6, (compared, confirmed)
    assert sorted(collections.Counter(clusters["cluster"].to_pylist()).values()) == [3, 500]
    root = list(range(len(texts)))
    for a, b in zip(links["a"].to_pylist(), links["b"].to_pylist()):
        root = [root[int(b)] if r == root[int(a)] else r for r in root]
    found = collections.defaultdict(set)
    for i, r in enumerate(root):
        found[r].add(i)
    want = plain_components(list(range(len(texts))), texts, 3, (80, 100))
    whole = collections.defaultdict(set)
    for i, (_, c) in want.items():
        whole[c].add(i)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, whole.values()))


def test_texts_are_hashed_together_as_one_by_one(monkeypatch):
    """Word limits, texts that end in a word, words far over the length that is hashed with others, and slices of a few bytes."""
    random.seed(8)
    signs = " \t\n\x0b\x0c\r\x1c\x85abAB\xe9\u3000z"
    texts = ["".join(random.choice(signs) for _ in range(random.choice([0, 1, 3, 10, 40]))) for _ in range(400)]
    texts += [None, "", "ab", "AB ba", "q" * 257 + " b " + "Q" * 257, "y" * 70_000 + " A b", "x " * 40_000 + "y", "end"]

    def plain(text, size):
        words = (text or "").encode().lower().split()
        run = min(size, len(words))
        return {tuple(words[i : i + run]) for i in range(len(words) - run + 1)} if run else set()

    for slice_bytes in (neardup.SLICE, 7):
        monkeypatch.setattr(neardup, "SLICE", slice_bytes)
        for size in (3, 5):
            one, want = neardup.shingler(size), [plain(t, size) for t in texts]
            got = [s.tolist() for s in neardup.all_shingles(pa.array(["cut off", *texts]).slice(1), size)]
            assert got == [one(t or "").tolist() for t in texts]
            assert [len(s) for s in got] == [len(w) for w in want] and all(s == sorted(set(s)) for s in got)
            assert len(set().union(*got)) == len(set().union(*want))
            for (x, a), (y, b) in itertools.combinations([*zip(got, want)][-40:], 2):
                if x and y:
                    assert neardup.overlap(np.array(x, np.uint64), np.array(y, np.uint64)) == len(a & b)


def test_texts_of_one_row_group_are_dealt_out(spark, monkeypatch, tmp_path):
    """A row group is read by one task: its texts are dealt out before they are described, and the table of them is removed again."""
    monkeypatch.setattr(common, "DEALT_FROM", 50)
    texts = [t for k in range(20) for t in near_copies(10, 80, 4, 100 + k)]
    rows = [(i, t, "en", "a", 1) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, DOCS).coalesce(1).write.parquet(str(tmp_path / "one"))
    docs, described = spark.read.parquet(str(tmp_path / "one")), []

    def describe(rows, size, real=neardup.describe):
        described.append((rows.groupBy(F.spark_partition_id()).count().count(), rows.inputFiles()[0]))
        return real(rows, size)

    monkeypatch.setattr(neardup, "describe", describe)
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs, 3, (85, 100)).collect()}
    assert got == {i: c for i, (_, c) in plain_components(list(range(len(texts))), texts, 3, (85, 100)).items()}
    ((tasks, file),) = described
    assert tasks >= spark.sparkContext.defaultParallelism and "dealt-" in file and not Path(file.removeprefix("file://")).exists()
    many = docs.repartition(4 * spark.sparkContext.defaultParallelism)
    with common.evenly(many, "doc_id") as same:
        assert same is many


# --- the pipeline -----------------------------------------------------------------------------------------------


def test_pipeline_stages_keep_what_they_should(spark, sf):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    quality_of = read(sf, "labels").set_index("doc_id").quality
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, sf)
        path = f"{corpus_pipeline.written(docs, name).inputFiles()[0].rsplit('/', 1)[0]}"
        docs = spark.read.parquet(path)
        if name != "shard":
            assert docs.columns == columns
        ids = [r.doc_id for r in docs.collect()]
        if name == "quality":
            kept = set(ids)
            good = [i for i in quality_of.index if quality_of[i] == 1]
            assert sum(i in kept for i in good) > 0.97 * len(good)
        if name == "near_dedup":
            rows = before.collect()
            want = plain_components([r.doc_id for r in rows], [r.text for r in rows], 5, (80, 100))
            assert sorted(ids) == sorted(i for i, (_, c) in want.items() if c == i)
        if name == "decontaminate":
            items = read(sf, "benchmark").text
            assert sorted(ids) == sorted(r.doc_id for r in before.collect() if not any(x in r.text for x in items))
        if name == "mix_sources":
            assert max(collections.Counter(ids).values()) <= 2 and set(ids) <= {r.doc_id for r in before.collect()}
        if name == "shard":
            assert bag(docs, *columns) == bag(before, *columns) and sorted({r.shard for r in docs.collect()}) == list(range(8))


def test_stages_take_awkward_rows(spark, sf):
    import corpus_pipeline

    for docs in (awkward_docs(spark), empty_docs(spark), with_clashes(awkward_docs(spark))):
        for _, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.written(stage(spark, docs, sf), "stage")
        assert docs.count() >= 0
