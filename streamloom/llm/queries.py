"""The operators of this subpackage as named queries over the given tables, with their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from streamloom.llm.common import table
from streamloom.llm.decontaminate import COVER, CONFLICTS, PLAIN, TOKEN, UNITS, WINDOW, judge_contamination
from streamloom.llm.exact import exact_duplicates
from streamloom.llm.mixing import mix
from streamloom.llm.neardup import near_duplicates
from streamloom.llm.quality import resample
from streamloom.llm.rules import judge
from streamloom.llm.sharding import shuffle_into_shards
from streamloom.llm.spelling import spelling_forms
from streamloom.llm.tokens import count_tokens
from streamloom.llm.toxicity import fit, score
from streamloom.llm.turns import damage, summaries
from streamloom.llm.urls import host_of, judge_urls
from streamloom.llm.warc import read_archives, write_archives

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return add


URL_RULES = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"), ("com", "/de/", "block"),
]
#: The list of the URL filter: pages on these hosts, and pages whose payload's MD5 begins so (one in 16, on any host: they stand for reported payloads).
REPORTED = "0"
LISTED_HOSTS = r"(^|\.)(casino-win|free-bets|ads-track|spam-farm|cheap-pills|adult-x)\."


@query("op4_url_filter", r"""
WITH parts AS (
    SELECT page_id,
        translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path, coalesce(md5(html) LIKE '0%', false) AS reported
    FROM pages),
keyed AS (
    SELECT *, CASE WHEN host <> '' THEN regexp_replace(host, '^(www|m)\.', '') || regexp_replace(path, '(\.html|/)+$', '') END AS canonical FROM parts),
listed AS (SELECT DISTINCT canonical FROM keyed WHERE canonical IS NOT NULL
    AND (reported OR regexp_matches(host, '(^|\.)(casino-win|free-bets|ads-track|spam-farm|cheap-pills|adult-x)\.'))),
ruled AS (
    SELECT page_id, host, path, canonical,
        CASE WHEN ('.' || host) LIKE '%.example.org' AND path LIKE '/en/1%' THEN 'example.org/en/1'
             WHEN ('.' || host) LIKE '%.example.org' AND path LIKE '/es/%' THEN 'example.org/es/'
             WHEN ('.' || host) LIKE '%.com' AND path LIKE '/de/%' THEN 'com/de/'
             WHEN ('.' || host) LIKE '%.com' AND path LIKE '/fr/%' THEN 'com/fr/'
             WHEN ('.' || host) LIKE '%.org' AND path LIKE '/%' THEN 'org/' END AS rule
    FROM keyed)
SELECT page_id, host, path, rule, l.canonical IS NOT NULL AS listed,
    CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
         WHEN l.canonical IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM ruled LEFT JOIN listed l USING (canonical)""")
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL against the rules, and against the URLs of pages on listed hosts and of reported payloads."""
    pages = table(spark, sf_dir, "pages")
    reported = F.md5(F.col("html").cast("binary")).startswith(REPORTED)
    listed = pages.where(host_of(F.col("url")).rlike(LISTED_HOSTS) | reported).select("url")
    return judge_urls(pages.select("page_id", "url"), listed, URL_RULES).select("page_id", "host", "path", "rule", "listed", "verdict")


@query("op5_token_counts")
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole text under the 50k byte-level vocabulary."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), 512)


@query("op1_toxic_spans")
def op1_toxic_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every whole text; labels are learned from rows whose checksum of the id leaves no remainder 1. ``offsets``: start and end of the offending words, in code points."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    scored = score(docs, fit(docs, labels.where(~held_out)))
    return scored.select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"), F.size("spans").cast("long").alias("n_spans"),
        F.transform("spans", lambda s: F.array(s["start"], s["end"])).alias("offsets"),
    )


MIX_WEIGHTS = (5, 2, 1)
MIX_SEED = 20240601


@query("op2_pareto_mix", r"""
WITH docs AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
        (('0x' || substr(md5('20240601|' || coalesce(CAST(doc_id AS VARCHAR), md5(text), '')), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0 AS u,
        coalesce(CAST(doc_id AS VARCHAR), md5(text), '') AS tie
    FROM documents),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
weighed AS (
    SELECT *, [5.0::DOUBLE, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight, source_size * 2.0::DOUBLE AS cap FROM sizes),
levels AS (
    SELECT *, ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE - coalesce(sum(cap) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM weighed WINDOW w AS (ORDER BY cap / weight, source NULLS LAST)),
level AS (SELECT level FROM levels WHERE level * weight <= cap ORDER BY cap / weight, source NULLS LAST LIMIT 1),
targets AS (SELECT source, source_size, least(cap, coalesce((SELECT level FROM level) * weight, cap)) AS target FROM levels),
plan AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM targets),
budgets AS (
    SELECT *, target - whole * source_size AS budget, source_size > 0 AND target / source_size > whole AS sampled FROM plan),
bysize AS (SELECT source, size, count(*) AS n FROM docs WHERE size > 0 GROUP BY ALL),
scaled AS (
    SELECT b.source, size, coalesce(sum(size * n) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS certain,
        (budget - coalesce(sum(size * n) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
            / (sum(size * size * n) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS scale
    FROM bysize b JOIN budgets p ON b.source IS NOT DISTINCT FROM p.source AND sampled WINDOW w AS (PARTITION BY b.source ORDER BY size DESC)),
scales AS (SELECT source, max_by(scale, size) AS scale, max_by(certain, size) AS certain FROM scaled WHERE scale * size < 1.0 GROUP BY source),
chances AS (
    SELECT d.*, p.source_size, p.target, p.whole, budget - certain AS rest, scale * size AS chance
    FROM docs d JOIN budgets p ON d.source IS NOT DISTINCT FROM p.source LEFT JOIN scales c ON d.source IS NOT DISTINCT FROM c.source),
ranked AS (
    SELECT *, sum(CASE WHEN chance > 0 AND chance < 1.0 THEN size END) OVER (
        PARTITION BY source ORDER BY CASE WHEN chance > 0 AND chance < 1.0 THEN (u / (1.0::DOUBLE - u)) / (chance / (1.0::DOUBLE - chance)) END NULLS LAST, tie) AS through
    FROM chances)
SELECT doc_id, size, source_size, target,
    (whole * size + CASE WHEN chance >= 1.0 OR chance > 0 AND (through <= rest OR (through - size < rest AND through - rest <= rest - (through - size))) THEN size ELSE 0 END)::BIGINT AS taken
FROM ranked""")
def op2_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to weights 5, 2, 1 of the sources in turn, 150 % of the words, twice a source at most."""
    mixed = mix(table(spark, sf_dir, "documents"), MIX_WEIGHTS, share=1.5, most=2.0, seed=MIX_SEED)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


@query("op3_importance_resampling")
def op3_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's importance weight and whether the resample keeps it."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return resample(docs, labels, seed=3).select("doc_id", "log_weight", "gumbel_key", "kept")


@query("op6_warc_dictionary", """
WITH rows AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
digests AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha256(payload) AS payload_digest FROM rows),
firsts AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM digests)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first THEN first END AS refers_to
FROM firsts""")
def op6_warc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page archived, and what the archives say when read again."""
    manifest = write_archives(table(spark, sf_dir, "pages"))
    back = read_archives(manifest, with_payload=False)
    return back.select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op7_decision_list")
def op7_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of every whole text, the base rules, and the list learned from the quality labels."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    base = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    return judge(docs, labels, base)


@query("op8_external_shuffle")
def op8_external_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards of one random order, read back from what the shuffle wrote."""
    placed = shuffle_into_shards(table(spark, sf_dir, "documents"), 8, seed=8)
    text = F.coalesce("text", F.lit(""))
    return placed.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


_TEMPLATE = """list_transform(raw, lambda x, i: CASE WHEN x >= '0' AND x < ':' THEN '<num>' WHEN lower(x) <> x THEN '<name>'
    WHEN i > 1 AND raw[i - 1] >= '0' AND raw[i - 1] < ':' AND list_contains([{units}], lower(x)) THEN '<unit>' ELSE lower(x) END)""".format(
    units=", ".join(f"'{u}'" for u in UNITS))
_TOKEN_SQL = TOKEN.replace("'", "''")


@query("op9_template_decontamination", f"""
WITH items AS (
    SELECT item, raw, {_TEMPLATE} AS t FROM (
        SELECT min(item_id) AS item, regexp_extract_all(text, '{_TOKEN_SQL}') AS raw FROM benchmark WHERE text IS NOT NULL GROUP BY text)
    WHERE len(raw) > 0),
grams AS (
    SELECT item, q, least(len(t), {WINDOW}) AS length, array_to_string(t[q + 1 : q + least(len(t), {WINDOW})], ' ') AS h
    FROM (SELECT item, t, unnest(range(0, len(t) - least(len(t), {WINDOW}) + 1)) AS q FROM items)
    WHERE len(list_filter(t[q + 1 : q + least(len(t), {WINDOW})], lambda x: x[1] <> '<')) >= CASE WHEN len(t) < {WINDOW} THEN 1 ELSE {PLAIN} END),
counts AS (SELECT item, count(*) AS n FROM grams GROUP BY item),
docs AS (
    SELECT body, raw, {_TEMPLATE} AS t FROM (
        SELECT text AS body, regexp_extract_all(text, '{_TOKEN_SQL}') AS raw FROM documents WHERE text IS NOT NULL GROUP BY text)),
spread AS (
    SELECT body, length, p, array_to_string(t[p + 1 : p + length], ' ') AS h
    FROM (SELECT body, t, length, unnest(range(0, len(t) - length + 1)) AS p FROM docs, (SELECT DISTINCT length FROM grams))),
runs AS (
    SELECT body, item, p - q AS shift, any_value(g.length) AS length, list(DISTINCT q) AS qs, count(DISTINCT q) / any_value(n) AS share
    FROM spread s JOIN grams g ON s.h = g.h AND s.length = g.length JOIN counts USING (item) GROUP BY 1, 2, 3
    HAVING count(DISTINCT q) / any_value(n) >= {COVER}),
slots AS (
    SELECT r.body, r.item, r.shift, r.share, unnest(list_concat([NULL], list_distinct([
        {{'i': i.raw[j + 1], 'd': d.raw[j + 1 + r.shift]}} FOR j IN range(0, len(i.t))
        IF i.t[j + 1][1] = '<' AND len(list_filter(r.qs, lambda q: q <= j AND j < q + r.length)) > 0]))) AS slot
    FROM runs r JOIN items i USING (item) JOIN docs d USING (body)),
leaks AS (
    SELECT body, item, share FROM slots GROUP BY body, item, shift, share
    HAVING 2 * count(slot) - count(DISTINCT slot.i) - count(DISTINCT slot.d) <= {CONFLICTS} * count(slot)),
found AS (SELECT body, min(item) AS item_id, count(DISTINCT item) AS n_items, max(share) AS share FROM leaks GROUP BY body)
SELECT doc_id, f.body IS NOT NULL AS contaminated, item_id, coalesce(n_items, 0) AS n_items, coalesce(share, 0.0::DOUBLE) AS share
FROM documents LEFT JOIN found f ON text = f.body""")
def op9_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document against the templates of the benchmark."""
    return judge_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op10_chosen_path", r"""
WITH RECURSIVE split AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
    FROM split),
counts AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (
    SELECT a, b FROM pairs JOIN counts p ON p.doc_id = a JOIN counts q ON q.doc_id = b WHERE 100 * i >= 85 * (p.n + q.n - i)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
    SELECT a, b FROM both_ways
    UNION
    SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a),
lowest AS (SELECT a AS doc_id, min(b) AS low FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(c.n, 0) AS n_shingles, least(d.doc_id, coalesce(l.low, d.doc_id)) AS component_id,
    d.doc_id = least(d.doc_id, coalesce(l.low, d.doc_id)) AS kept
FROM documents d LEFT JOIN counts c USING (doc_id) LEFT JOIN lowest l USING (doc_id)""")
def op10_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents whose three-word shingles overlap by 85 %."""
    found = near_duplicates(table(spark, sf_dir, "documents"), 3, (85, 100))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


#: SQL of a CRC-32: the table of its 256 steps, and the checksum of a text's bytes by that table.
_CRC_TABLE = """SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS steps"""


def _crc(text: str) -> str:
    octets = f"list_transform(range(octet_length(encode({text}))), lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT)"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {octets}), lambda c, b: xor(steps[xor(c, b) % 256 + 1], c // 256)), 4294967295)"


@query("op11_spelling_index", rf"""
WITH RECURSIVE crc AS ({_CRC_TABLE}),
runs AS (
    SELECT doc_id, run, count(*) AS k FROM (
        SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents)
    GROUP BY ALL),
hashed AS (SELECT run, k, {_crc("(coalesce(doc_id::VARCHAR, '') || ':' || run)")} AS h FROM runs, crc),
words AS (
    SELECT * FROM (SELECT word, sum(k)::BIGINT AS n FROM (
        SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, k FROM hashed)
        GROUP BY word) WHERE length(word) >= 6 AND n >= 5),
shorter AS (SELECT word, i, substr(word, 1, i::INT) || substr(word, i::INT + 2) AS rest FROM (SELECT word, unnest(range(length(word))) AS i FROM words)),
near AS (
    SELECT s.word AS a, w.word AS b FROM shorter s JOIN words w ON s.rest = w.word
    UNION SELECT w.word, s.word FROM shorter s JOIN words w ON s.rest = w.word
    UNION SELECT x.word, y.word FROM shorter x JOIN shorter y ON x.rest = y.rest AND x.i = y.i AND x.word <> y.word),
counted AS (SELECT a, count(*) AS n_near, min({{'less': -n, 'b': b}}) AS best FROM near JOIN words ON b = word GROUP BY a),
forms AS (
    SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.less >= 5 * n THEN best.b END AS form, CASE WHEN -best.less >= 5 * n THEN -best.less END AS form_n
    FROM words LEFT JOIN counted ON word = a),
ways AS (
    SELECT word, word AS stop, 0 AS steps FROM forms
    UNION ALL SELECT w.word, f.form, steps + 1 FROM ways w JOIN forms f ON w.stop = f.word WHERE f.form IS NOT NULL),
roots AS (SELECT word, arg_max(stop, steps) AS root FROM ways GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)""")
def op11_spelling_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all texts, misspelt now and then, with the frequent words next to them."""
    return spelling_forms(table(spark, sf_dir, "documents"))


def _edit(state: str, cost: str, letter: str, line: str | None = None) -> str:
    """SQL of a survivor (cost, edits, lines) after one edit."""
    lines = f"list_append({state}.lines, {line})" if line else f"{state}.lines"
    return f"{{'cost': {state}.cost + {cost}, 'edits': {state}.edits || '{letter}', 'lines': {lines}}}"


_NONE = "{'cost': 1000000000000::BIGINT, 'edits': '', 'lines': []::VARCHAR[]}"


def _turn(states: list[str], initial: str | None, name: str | None) -> list[str]:
    """SQL of the survivors that a turn leads to from some states: kept, or called ``name``."""
    out = []
    for state in states:
        keep = _edit(state, "late", "K", "role || ':' || text")
        out.append(f"CASE WHEN NOT useless AND substr(role, 1, 1) = '{initial}' THEN {keep} ELSE {_NONE} END")
        if name:
            rerole = _edit(state, "late + 3", "R", f"'{name}:' || text")
            out.append(f"CASE WHEN NOT useless THEN {rerole} ELSE {_NONE} END")
    return out


def _least(options: list[str]) -> str:
    return f"list_min([{', '.join(options)}])"


_USER = _least(["u", *[_edit(state, "3", "I", "'user:'") for state in ("z", "s", "a")]])
_ASSISTANT = _least(["a", _edit("iu", "3", "I", "'assistant:'")])


@query("op12_survivor_viterbi", rf"""
WITH RECURSIVE crc AS ({_CRC_TABLE}),
faults AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        {_crc("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS f FROM conversations, crc),
turns AS (
    SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
        CASE f WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
    FROM faults, generate_series(1, CASE WHEN f = 3 THEN 2 ELSE 1 END) WHERE f <> 0),
numbered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, again) AS i,
        rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body
    FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) > 1 AS again FROM turns)),
judged AS (
    SELECT *, body = '' AS blank, body <> '' AND again AS duplicate, body <> '' AND NOT again AND right(body, 1) NOT IN ('.', '!', '?') AS truncated,
        substr(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1, 1) || substr(role, 1, 1) AS step FROM numbered),
ready AS (SELECT *, blank OR duplicate AS useless, CASE WHEN truncated THEN 3 ELSE 0 END AS late FROM judged),
counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
        count(*) FILTER (truncated) AS truncated, count(*) FILTER (i > 1 AND step NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
    FROM ready GROUP BY conv_id),
paths AS (
    SELECT conv_id, 0::BIGINT AS i, {{'cost': 0::BIGINT, 'edits': '', 'lines': []::VARCHAR[]}} AS z, {_NONE} AS s, {_NONE} AS u, {_NONE} AS a FROM (SELECT DISTINCT conv_id FROM conversations)
    UNION ALL
    SELECT conv_id, i, {_edit("z", "4", "D")}, {_least([_edit("s", "4", "D"), *_turn(["z"], "s", None)])},
        {_least([_edit("iu", "4", "D"), *_turn(["z", "s", "ia"], "u", "user")])}, {_least([_edit("ia", "4", "D"), *_turn(["iu"], "a", "assistant")])}
    FROM (
        SELECT *, {_ASSISTANT} AS ia FROM (
            SELECT p.conv_id, r.i, z, s, u, a, {_USER} AS iu, r.role, r.text, r.useless, r.late
            FROM paths p JOIN ready r ON p.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = p.i + 1))),
ends AS (
    SELECT conv_id, i, {_least(["z", "ia"])} AS best FROM (SELECT conv_id, i, z, {_ASSISTANT} AS ia FROM (SELECT *, {_USER} AS iu FROM paths)))
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
    coalesce(illegal, 0) AS illegal, best.cost AS cost, best.edits AS audit, sha256(array_to_string(best.lines, chr(10))) AS repaired_sha256
FROM ends e LEFT JOIN counts c ON e.conv_id IS NOT DISTINCT FROM c.conv_id WHERE e.i = coalesce(n, 0)""")
def op12_survivor_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest repair and repaired text of every conversation, after its turns were damaged."""
    return summaries(damage(table(spark, sf_dir, "conversations"))).withColumnRenamed("conv", "conv_id")


@query("op13_extendible_hash", """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, coalesce(doc_id = max(doc_id) OVER same, max(doc_id) OVER same IS NULL) AS kept,
    sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""")
def op13_extendible_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the last one of its text."""
    return exact_duplicates(table(spark, sf_dir, "documents"))
