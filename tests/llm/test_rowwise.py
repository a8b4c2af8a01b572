"""Operators that map rows to rows: token counts, URL filter, toxicity, archives."""

import hashlib
import random
import sys
import zlib
from pathlib import Path

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parent))
from helpers import awkward_docs, bag, empty_docs, labels, read, with_clashes  # noqa: E402

from streamloom.llm import toxicity, warc  # noqa: E402
from streamloom.llm.queries import LISTED_HOSTS, QUERIES, URL_RULES  # noqa: E402
from streamloom.llm.tokens import count_tokens, counter, read_merges  # noqa: E402
from streamloom.llm.urls import build_filter, canonical, judge_urls  # noqa: E402

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def test_token_counts_equal_the_library(library):
    count = counter(*read_merges(VOCABULARY))
    random.seed(5)
    parts = [" ", "  ", "\n", "\t", "\r\n", "a", "B", "é", "1", "٣", "中", "'s", "'ll", "<|endoftext|>", "<|endof", "###", "\u00a0", "\u2003", "\x1c", "\x85", "\u180e", "\u200b", "😀", "don't", "the", "ing", ".", "\x00", "½", "\ufeff", "\u3000"]
    for _ in range(3000):
        text = "".join(random.choice(parts) for _ in range(random.randint(0, 14)))
        assert count(text) == len(library.encode(text, add_special_tokens=False).ids), repr(text)
    for text in ("a" * 3000, " " * 2000, "ab" * 1500, "\n" * 1500):
        assert count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_token_counts_of_a_whole_table(spark, sf, library):
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in QUERIES["op5_token_counts"](spark, sf).collect()}
    docs = read(sf, "documents")
    assert len(got) == len(docs)
    for r in docs.itertuples():
        n = len(library.encode(r.text or "", add_special_tokens=False).ids)
        assert got[r.doc_id] == (len((r.text or "").encode()), n, n > 512)


def test_token_counts_of_awkward_rows(spark, library):
    docs = with_clashes(awkward_docs(spark))
    got = count_tokens(docs, VOCABULARY, 512)
    assert got.count() == docs.count() and "size" in got.columns
    by = {r.doc_id: r for r in got.collect() if r.doc_id is not None}
    assert (by[3].n_bytes, by[3].n_tokens, by[4].n_tokens) == (0, 0, 0)
    assert by[6].n_tokens == 60_001 and by[6].over_limit
    assert count_tokens(empty_docs(spark), VOCABULARY, 512).collect() == []


def urls(spark, rows):
    return spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")


ODD_URLS = [None, "", "no scheme", "http://", "HTTP://Example.ORG/en/1x?y#z", "http://org/es/", "http://a.b.example.org/es/x", "x://notexample.org/es/", "http://h.com/de/?a://b/fr/", "http://h.com/fr/\n", "ftp://xn--com/fr/", "http://www.l.net/p/", "http://l.net/p.html#x", "http://l.net/P"]


def test_urls_against_plain_python(spark):
    listed = urls(spark, ["https://m.l.net/p", None, "junk"])
    got = {r.page_id: r for r in judge_urls(with_clashes(urls(spark, ODD_URLS * 2)), listed, URL_RULES).collect()}
    assert len(got) == 2 * len(ODD_URLS)
    for i, url in enumerate(ODD_URLS * 2):
        rest = url.partition("://")[2] if url and "://" in url else ""
        host = path = ""
        for k, c in enumerate(rest + "#"):
            if c in "/?#":
                host, path = rest[:k].translate({o: o + 32 for o in range(65, 91)}), rest[k:].split("?")[0].split("#")[0]
                break
        fits = [h + p for h, p, _ in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule = max(fits, key=len, default=None)
        verdict = {h + p: v for h, p, v in URL_RULES}.get(rule) or ("block" if host in ("www.l.net", "l.net") and path in ("/p/", "/p.html") else "allow")
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, rule, verdict), url


def test_url_tables_may_be_empty(spark):
    none = urls(spark, []).where("false")
    assert judge_urls(none, urls(spark, ["http://a/b"]), URL_RULES).collect() == []
    assert {r.verdict for r in judge_urls(urls(spark, ["http://a.net/b"]), none, URL_RULES).collect()} == {"allow"}


def test_the_list_decides_on_hosts_that_no_pattern_knows(spark, sf):
    rows = QUERIES["op4_url_filter"](spark, sf).where("rule IS NULL").toPandas()
    usual = rows[~rows.host.str.contains(LISTED_HOSTS)]
    blocked = usual[usual.verdict == "block"]
    assert 0 < len(blocked) < len(usual) and blocked.listed.all() and set(blocked.host) & set(usual[usual.verdict == "allow"].host)


def test_filter_passes_every_listed_url_and_few_others(spark):
    listed = spark.range(4000).select(F.concat(F.lit("h.net/"), "id").alias("canonical"))
    blocks, n = build_filter(listed, 4000)
    assert n == 250 and blocks.count() <= n
    pages = spark.range(20_000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h.net/"), "id").alias("url"))
    got = judge_urls(pages, listed.select(F.concat(F.lit("http://"), "canonical").alias("url")), [("none", "/", "allow")])
    assert got.where("listed").count() == 4000 == got.where("listed AND page_id < 4000").count()
    assert spark.range(1).select(canonical(F.lit("http://www.A.net/x/?q"))).first()[0] == "a.net/x"


def test_toxic_words_are_found_in_held_out_documents(spark, sf):
    sf = sf.replace("sf0.001", "sf0.1")
    got = QUERIES["op1_toxic_spans"](spark, sf).toPandas()
    documents = read(sf, "documents")
    texts = dict(zip(documents.doc_id, documents.text))
    for r in got.itertuples():
        assert len(r.offsets) == r.n_spans
        words = [texts[r.doc_id][start:end] for start, end in r.offsets]
        assert all(w and not any(c.isspace() for c in w) for w in words)
    assert got.n_spans.sum() > 0
    assert len(got) == len(read(sf, "documents")) and got.score.between(0, 1).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got.doc_id]).all()
    both = got.merge(read(sf, "labels"), on="doc_id")
    held = both[both.held_out]
    assert (held[held.toxic == 0].predicted == 0).mean() > 0.98
    assert (held[held.toxic == 1].predicted == 1).mean() > 0.8  # some labels mark texts without such words
    assert ((both.score >= 0.7) == (both.predicted == 1)).all()


def toy_model():
    clean = [f"alpha beta gamma delta w{i} w{i + 1} w{i + 7}" for i in range(300)]
    bad = [f"alpha beta x{i} nastyword gamma x{i + 1} x{i + 9} delta" for i in range(40)]
    return toxicity.train(clean + bad, [False] * 300 + [True] * 40)


def test_marginals_equal_enumeration():
    """The collapsed recursion against a sum over all labellings."""
    import itertools
    import math

    model = {"features": {"w=bad": 2.5, "w=odd": 0.7}, "bias": -1.3, "moves": [[0.6, -0.4], [-0.2, 0.5]]}
    tag = toxicity.tagger(model)
    for text in ("bad", "a bad b", "bad bad odd", "a b c bad d e odd f g", "odd a b c d e f bad"):
        words = text.split()
        weight = [model["bias"] + model["features"].get("w=" + w, 0.0) for w in words]
        total, ones = 0.0, [0.0] * len(words)
        for labels_ in itertools.product((0, 1), repeat=len(words)):
            p = math.exp(sum(x for x, y in zip(weight, labels_) if y) + sum(model["moves"][a][b] for a, b in zip(labels_, labels_[1:])))
            total += p
            for i, y in enumerate(labels_):
                ones[i] += p * y
        spared = math.prod(1 - ones[i] / total for i, w in enumerate(words) if w in ("bad", "odd"))
        score, spans = tag(text)
        assert score == pytest.approx(1 - spared, abs=1e-9)
        assert [(text[a:b], round(m, 9)) for a, b, m in spans] == [(w, round(o / total, 9)) for w, o in zip(words, ones) if w in ("bad", "odd") and o / total >= 0.5]


def test_spans_point_at_the_words():
    tag = toxicity.tagger(toy_model())
    text = "ünï alpha  nastyword, 中文 nastyword"
    score, spans = tag(text)
    assert score > 0.9 and [text[a:b] for a, b, _ in spans] == ["nastyword,", "nastyword"]
    assert tag("alpha beta w5")[0] < 0.3 and tag("")[0] == 0.0


def test_toxicity_of_awkward_rows(spark):
    docs = with_clashes(awkward_docs(spark).drop("tie"))
    for model in (toy_model(), toxicity.fit(docs, labels(spark)), toxicity.fit(docs, labels(spark, [(1, 1, 1), (1, None, None), (None, 0, 1), (99, 1, 0)]))):
        got = toxicity.score(docs, model)
        assert got.count() == docs.count() and got.where("score IS NULL OR score < 0 OR score > 1").count() == 0
        assert got.where("doc_id IN (3, 4, 5) AND score <> 0").count() == 0
    assert toxicity.score(empty_docs(spark), toy_model()).collect() == []


PAGES = [
    (5, "http://a", "x" * 100), (3, "http://b", "x" * 100), (9, None, "x" * 100), (3, "http://b", "x" * 100), (None, "http://n", "x" * 100),
    (1, "http://c\r\nX: y", "x" * 99), (2, "http://d", "x" * 99), (4, "", None), (6, "http://e", ""), (7, "http://é", "é\r\n\r\nWARC/1.1\r\n" * 50), (8, "http://f", "long " * 100_000),
]


def expected_records(pages):
    out = []
    for key, _, html in pages:
        body = (html or "").encode()
        first = min((k for k, _, h in pages if k is not None and h == html), default=None) if len(body) >= 100 else key
        revisit = first is not None and key != first
        out.append((key, len(body), hashlib.sha256(body).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=repr)


def test_archives_round_trip(spark):
    pages = with_clashes(spark.createDataFrame(PAGES, "page_id long, url string, html string"))
    back = warc.read_archives(warc.write_archives(pages.repartition(3)))
    assert bag(back, "key", "payload_bytes", "payload_digest", "record_type", "refers_to") == expected_records(PAGES)
    want = sorted(((k, (h or "").encode()) for k, _, h in PAGES), key=repr)
    got = [(r.key, bytes(r.payload)) for r in back.where("record_type = 'response'").collect()]
    assert set(got) <= set(want) and {g[1] for g in got} == {w[1] for w in want}


def test_archives_stand_alone_and_roll(spark, tmp_path, monkeypatch):
    import struct

    import zstandard

    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 150_000)
    pages = spark.range(0, 6000, 1, 1).select(F.col("id").alias("page_id"), F.lit("http://u").alias("url"), F.concat(F.lit("<p>some common words of a page "), F.sha2(F.col("id").cast("string"), 256)).alias("html"))
    manifest = warc.write_archives(pages, str(tmp_path / "w")).collect()
    assert len(manifest) > 1 and sum(m.records for m in manifest) == 6000
    data = Path(manifest[0].archive).read_bytes()
    magic, size = struct.unpack("<II", data[:8])
    assert magic == warc.DICTIONARY_FRAME
    dictionary = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(data[8 : 8 + size]))
    first = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
    record = first.decompress(data[8 + size :])  # one frame is one record
    assert record.startswith(b"WARC/1.1\r\n") and record.count(b"WARC-Type") == 1 and first.unused_data


def test_no_pages_make_no_archives(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    manifest = warc.write_archives(none)
    assert manifest.collect() == [] and warc.read_archives(manifest).collect() == []
