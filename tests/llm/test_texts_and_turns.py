"""Spelling variants, conversation repair and exact duplicates against plain Python, and on awkward rows."""

import collections
import hashlib
import itertools
import random
import re
import sys
import zlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))
from helpers import DOCS, awkward_docs, bag, empty_docs, with_clashes  # noqa: E402

from streamloom.llm import exact, spelling, turns  # noqa: E402

# --- spelling ---------------------------------------------------------------------------------------------------


def shorter(word):
    return {word[:i] + word[i + 1 :] for i in range(len(word))}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return a in shorter(b) or b in shorter(a)


def forms(docs, letters=6, least=5, times=5):
    """The whole operator in plain Python."""
    n = collections.Counter()
    for d, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            n[run if h % 199 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    n = {w: k for w, k in n.items() if len(w) >= letters and k >= least}
    out = {}
    for w in n:
        around = [v for v in n if v != w and near(v, w)]
        best = min(around, key=lambda v: (-n[v], v), default=None)
        form = best if best is not None and n[best] >= times * n[w] else None
        out[w] = (n[w], len(around), form, n[form] if form else None)
    root = lambda w: w if out[w][2] is None else root(out[w][2])
    return {w: (*out[w], root(w)) for w in out}


def spelled(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = spelling.spelling_forms(docs, **options).collect()
    assert len(got) == len({r.word for r in got})
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in got}


@pytest.mark.parametrize("block", [6, 16_384])
def test_spelling_against_all_pairs(spark, block):
    random.seed(block)
    rows = []
    for d in range(250):
        words = []
        for _ in range(120):
            w = "".join(random.choice("aéb") for _ in range(random.randint(5, 8)))
            words.append(random.choice([w, w[:3] + "é" + w[4:], "aaaaaa" + w[:2], w.upper()]))
        rows.append((d, random.choice([" ", ", ", " 1.-"]).join(words)))
    rows += [(d, "zzzzzz " * 9 + "zzzzzy ") for d in range(400, 440)] + [(d, "zzzzxy " * 3) for d in (441, 442)]
    want = forms(rows)
    assert spelled(spark, rows, block_letters=block) == want
    assert len(want) > 500 and any(w[2] for w in want.values()) and any(w[2] and w[4] != w[2] for w in want.values())


def test_the_index_finds_one_error_and_no_other():
    words = ["".join(w) for k in range(1, 6) for w in itertools.product("ab", repeat=k)]
    index = spelling.Index(words)
    for word in words:
        got = {words[i] for i in spelling.members_of(index.near(word))}
        assert got == {w for w in words if len(w) >= len(word) and w != word and near(w, word)}


def test_spelling_of_awkward_rows(spark):
    long = "x" * 30_000
    rows = [(1, None), (2, ""), (None, "wordly wordly wordly"), (None, "wordly wordly"), (3, (long + " ") * 5 + (long + "y ") * 5), (3, "ÀÀÀÀÀÀ " * 6), (3, "àÀÀÀÀÀ " * 40), (4, "straße " * 5 + "中文中文中文 " * 9)]
    assert spelled(spark, rows) == forms(rows)
    assert spelled(spark, []) == {}
    got = spelling.spelling_forms(with_clashes(awkward_docs(spark)))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert bag(got, "word") == [] and spelling.spelling_forms(awkward_docs(spark), least_letters=4).where("word = 'word'").first().n > 59_000


# --- turns ------------------------------------------------------------------------------------------------------


def damaged(rows):
    """Rows (conv, turn, role, text) after the faults, by plain Python."""
    out = []
    sp = lambda x: " " if x is None else x
    for conv, turn, role, text in rows:
        fault = zlib.crc32(f"{sp(conv)}:{sp(turn)}".encode()) % 20
        role, text = sp(role), sp(text)
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return out


def judged(rows):
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    seen, out = set(), []
    for _, _, role, text in rows:
        body = text.rstrip(" \t\n\x0b\x0c\r")
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None)
        seen.add((role, text))
    return rows, out


def all_repairs(rows, faults, most_inserts):
    """Every sequence of edits, by trying all: (cost, letters, lines)."""
    fits = re.compile("(s?(ua)+)?")
    best = None

    def go(i, cost, letters, lines, initials, inserts):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        if i == len(rows) and fits.fullmatch(initials):
            best = min(best or (cost, letters, lines), (cost, letters, lines))
        if inserts < most_inserts:
            for name in ("user", "assistant"):
                go(i, cost + 3, letters + "I", [*lines, f"{name}:"], initials + name[0], inserts + 1)
        if i < len(rows):
            _, _, role, text = rows[i]
            go(i + 1, cost + 4, letters + "D", lines, initials, inserts)
            if faults[i] not in ("blank", "duplicate"):
                late = 3 if faults[i] == "truncated" else 0
                go(i + 1, cost + late, letters + "K", [*lines, f"{role}:{text}"], initials + (role[:1] or "?"), inserts)
                for name in ("user", "assistant"):
                    go(i + 1, cost + late + 3, letters + "R", [*lines, f"{name}:{text}"], initials + name[0], inserts)

    go(0, 0, "", [], "", 0)
    return best


CONVERSATION = "conv_id long, turn long, role string, text string"


def test_repairs_against_all_sequences(spark):
    random.seed(12)
    rows = []
    for conv in range(120):
        for turn in range(random.randint(1, 4)):
            rows.append((conv, random.choice([turn, turn, turn + 3, None]), random.choice(["user", "assistant", "system", "tool", "", None]), random.choice(["Yes.", "No!", "but then", " \n", None, "Why?  "])))
    got = {r.conv: r for r in turns.summaries(turns.damage(spark.createDataFrame(rows, CONVERSATION))).collect()}
    lines = collections.defaultdict(list)
    for r in sorted(turns.repaired(turns.damage(spark.createDataFrame(rows, CONVERSATION))).collect(), key=lambda r: (r.conv, r.place)):
        assert r.place == len(lines[r.conv])
        lines[r.conv].append(f"{r.role}:{r.text}")
    assert set(got) == {r[0] for r in rows}
    for conv in got:
        own, faults = judged([r for r in damaged(rows) if r[0] == conv])
        cost, letters, text = all_repairs(own, faults, 3)
        at = sorted({r[1] for r in own if r[1] is not None})
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        r = got[conv]
        assert (r.cost, r.audit, r.gaps, r.illegal) == (cost, letters, at[-1] - at[0] + 1 - len(at) if at else 0, illegal), own
        assert (r.blank, r.duplicate, r.truncated) == tuple(faults.count(f) for f in ("blank", "duplicate", "truncated"))
        assert lines[conv] == text and r.repaired_sha256 == hashlib.sha256("\n".join(text).encode()).hexdigest()


def test_final_edits_are_given_out_early():
    """Memory: of a long conversation only unresolved edits are held, and they are the edits of the whole."""
    random.seed(3)
    for _ in range(20):
        repair, out, most = turns.Repair(), [], 0
        for i in range(3000):
            role = random.choice(["user", "assistant", "user", "assistant", "system", "tool"])
            out += repair.push(role, str(i), random.random() < 0.1, random.random() < 0.1)
            nodes = {id(n) for _, leaf in repair.live.values() for n in chain(leaf)}
            most = max(most, len(nodes))
        out += repair.finish()
        assert len([e for e, _ in out if e != "I"]) == 3000 and most < 200


def chain(node):
    while node is not None:
        yield node
        node = node.parent


def test_conversations_of_awkward_rows(spark):
    rows = [(None, None, None, None), (None, 1, "user", "Hi."), (7, 0, "user", "x " * 60_000), (7, 0, "user", "x " * 60_000), (8, None, "user", "A."), (8, None, "assistant", "B.")]
    df = spark.createDataFrame(rows, CONVERSATION)
    for name in ("conv", "dropped", "again", "fault", "audit", "cost", "place"):
        df = df.withColumn(name, F.lit("own"))
    got = {r.conv: r for r in turns.summaries(turns.damage(df)).collect()}
    assert set(got) == {None, 7, 8}
    for conv in got:
        own, faults = judged([r for r in damaged(rows) if r[0] == conv])
        cost, letters, text = all_repairs(own, faults, 3)
        assert (got[conv].cost, got[conv].audit) == (cost, letters)
    assert turns.summaries(turns.damage(spark.createDataFrame([], CONVERSATION))).collect() == []
    lost = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    row = turns.summaries(turns.damage(spark.createDataFrame([(lost, 0, "user", "Hi.")], CONVERSATION))).first()
    assert tuple(row)[1:8] == (0, 0, 0, 0, 0, 0, "") and row.repaired_sha256 == hashlib.sha256(b"").hexdigest()


# --- exact duplicates -------------------------------------------------------------------------------------------


def copies(docs):
    groups = collections.defaultdict(list)
    for d, text in docs:
        groups[text or ""].append(d)
    out = []
    for d, text in docs:
        own = groups[text or ""]
        keep = max((x for x in own if x is not None), default=None)
        out.append((d, keep, len(own), keep is None or d == keep, hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bits,capacity", [(64, 512), (64, 2), (9, 3), (6, 1)])
def test_copies_against_plain_python(spark, bits, capacity):
    """Few bits make many different texts share a key, so that chains decide."""
    random.seed(bits + capacity)
    rows = [(d, random.choice([None, "", "hot", f"text {random.randint(0, 900)}", "é" * random.randint(0, 4)])) for d in range(3000)]
    got = exact.exact_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), capacity=capacity, bits=bits)
    assert bag(got) == copies(rows)


def test_the_directory_doubles_and_splits():
    random.seed(1)
    directory, keys = exact.Directory(4, 3), [0xA << 60 | random.getrandbits(60) for _ in range(500)]
    for i, key in enumerate(keys * 2):
        directory.add(key, b"%d" % (i % 500), 1, i)
    assert len(directory.slots) == 2**directory.depth > 128
    entries = {}
    for depth, prefix, chains in directory.buckets():
        assert len(chains) <= 3 and all((k & (1 << 60) - 1) >> (60 - depth) == prefix for k in chains)
        entries |= {k: c for k, c in chains.items()}
    assert {k: c for k, c in entries.items()} == {k: [[b"%d" % i, 2, i + 500]] for i, k in enumerate(keys)}
    directory.add(keys[0], b"another text of this key", 1, 7)
    assert len(directory.slots[directory._bits(keys[0], directory.depth)][2][keys[0]]) == 2


def test_an_index_grows_with_later_rows(spark):
    rows = [(d, f"text {d % 70}") for d in range(200)]
    make = lambda part: spark.createDataFrame(part, "doc_id long, text string")
    first = exact.build_index(make(rows[:90]), capacity=4)
    both = exact.build_index(make(rows[90:]), earlier=first, capacity=4)
    whole = exact.build_index(make(rows), capacity=4)
    assert bag(both, "text_sha256", "n", "top") == bag(whole, "text_sha256", "n", "top")
    assert both.count() == 70 and both.agg(F.sum("n")).first()[0] == 200


def test_copies_of_awkward_rows(spark):
    docs = with_clashes(awkward_docs(spark))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert bag(exact.exact_duplicates(docs)) == copies(rows)
    kept = exact.keep_last(docs)
    assert kept.columns == docs.columns
    assert bag(kept, "doc_id", "text") == sorted([(d, t) for (d, t) in rows if next(c for c in copies(rows) if c[0] == d and c[4] == hashlib.sha256((t or "").encode()).hexdigest())[3]], key=repr)
    assert exact.exact_duplicates(empty_docs(spark)).collect() == []
    folded = exact.exact_duplicates(spark.createDataFrame([(1, "A b", "", "", 1), (2, "a B", "", "", 1)], DOCS), normalise=F.lower)
    assert bag(folded, "doc_id", "keep_id", "kept") == [(1, 2, False), (2, 2, True)]
