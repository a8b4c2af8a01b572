"""Benchmark decontamination by template canonicalisation.

Numbers, names and units of a text become typed placeholders. Windows of the resulting templates are hash-joined with those of the benchmark,
so a question whose parameters were changed still matches. The same is done with the text in lower case, where names are words like any other,
so a copy in other letters' case matches too. Items whose templates and whose equal slots are the same are one class, whatever their values: windows, matches and
the check of slots are those of classes, so thousands of variants of one question cost what one costs. Matches of one alignment are then checked for slot
consistency: equal values in the question must stand for equal values in the document and the other way round. DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from streamloom.llm.common import bounded, fresh, passing_tables, written

#: Tokens in a window, and how many of them must be plain words.
WINDOW, PLAIN = 8, 5
#: Share of an item's windows that a document must have in neighbouring alignments, and the share of conflicting slots one of these may have.
COVER, CONFLICTS = 0.5, 0.1
#: Alignments that lie at most so many tokens apart are neighbours, as after a word put in; and tokens of an item that are a match if
#: they are in a row, or are ``COVER`` of its tokens.
SLACK, QUOTE = 8, 13
#: A number; a run of capitalised words; any other word.
TOKEN = r"[0-9]+(?:[.,:/][0-9]+)*|\p{Lu}[\p{L}\p{M}']*(?: \p{Lu}[\p{L}\p{M}']*)*|[\p{L}\p{M}']+"
#: Words that are a unit behind a number.
UNITS = (
    "mm cm m km in ft yd mi mg g kg t oz lb lbs ml cl l s sec min h hr hrs ms k c f w kw v a hz gb mb kb inch inches foot feet yard yards mile miles meter meters "
    "metre metres kilometer kilometers kilometre kilometres gram grams kilogram kilograms ounce ounces pound pounds ton tons liter liters litre litres second seconds "
    "minute minutes hour hours day days week weeks month months year years percent degrees dollar dollars cent cents euro euros"
).split()
#: Readings of a text: as it stands, and in lower case (by way of upper case, as some letters have one of two only there). Items that have
#: windows in neither are read in lower case without placeholders.
TYPED, FOLDED, EXACT = 0, 1, 2
#: Windows of the benchmark, and documents to check, that are broadcast at most (40 bytes each); more are joined by shuffle.
MOST_WINDOWS, MOST_CHECKED = 500_000, 500_000


def raw_tokens(text: Column, mode: int) -> Column:
    """The tokens of a text in a reading."""
    # Catalyst takes lower(upper(x)) for lower(x), which it is not where one letter has two in upper case; concat keeps them apart.
    body = text if mode == TYPED else F.lower(F.concat(F.upper(text), F.lit("")))
    return F.regexp_extract_all(F.coalesce(body, F.lit("")), F.lit(TOKEN), F.lit(0))


def slots(raw: Column, mode: int, of=lambda x: x) -> Column:
    """``of`` of each token of a template: ``<num>``, ``<name>``, ``<unit>`` or the word in lower case; tokens in lower case have no names, exact ones no slots."""
    number = lambda x: (x >= "0") & (x < ":")  # noqa: E731  the tokens that begin with a digit

    def slot(x: Column, i: Column) -> Column:
        unit = x.isin(*UNITS) & F.coalesce(number(F.get(raw, i - 1)), F.lit(False))
        kind = F.when(number(x), "<num>")
        return of((kind.when(F.lower(x) != x, "<name>") if mode == TYPED else kind).when(unit, "<unit>").otherwise(x))

    return F.transform(raw, of if mode == EXACT else slot)


def pairs(hashes: Column) -> Column:
    """Hashes of neighbouring tokens; the last token has none."""
    starts = F.when(F.size(hashes) > 0, F.sequence(F.lit(0), F.size(hashes) - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(F.get(hashes, i), F.get(hashes, i + 1)))


def windows(hashes: Column, pairs: Column, length: Column, lengths: list[int]) -> Column:
    """Hashes of all windows of an array of token hashes, put together from those of pairs. Both arrays must be columns, not expressions, or they are made for every window again."""

    def of(n: int) -> Column:
        starts = F.when(F.size(hashes) >= n, F.sequence(F.lit(0), F.size(hashes) - n)).otherwise(F.array().cast("array<int>"))
        last = [lambda i: F.get(hashes, i + (n - 1))] if n % 2 else []
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(pairs, i + k) for k in range(0, n - 1, 2)], *[get(i) for get in last]))

    return F.coalesce(*[F.when(length == n, of(n)) for n in lengths])


def keyed(h: Column, mode: Column, length: Column) -> Column:
    """The hash of a window as the one join key of its reading and length."""
    return h.bitwiseXOR((mode * (WINDOW + 1) + length).cast("long"))


def tie_of(text: Column) -> Column:
    """What stands for a text: two hashes of different kinds and its length, more than 100 bits."""
    return F.struct(F.xxhash64(text).alias("a"), F.hash(text).alias("b"), F.octet_length(text).alias("c"))


def benchmark_classes(benchmark: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Classes of items (``class``, ``mode``, ``raw``, ``template``, ``length`` of windows, ``n_tokens``, ``n_windows``, ``item_id``, the smallest, and ``n_of`` items)
    and their windows (``h``, ``class``, ``mode``, ``length``, ``n_tokens``, ``n_windows``, ``q``), both written.

    Windows with fewer than ``PLAIN`` plain words are left out, as they fit too much; an item shorter than a window is one window of its own
    length, if it has a plain word. An item that has no windows then, of numbers or names mostly, has all windows of its exact tokens.
    """
    items = benchmark.where(F.col(text).isNotNull()).groupBy(F.col(text).alias("body")).agg(F.min(key).alias("item_id"))
    raws = items.select("item_id", *[raw_tokens(F.col("body"), mode).alias(f"raw{mode}") for mode in (TYPED, FOLDED, EXACT)])
    each = [F.struct(F.lit(mode).alias("mode"), F.col(f"raw{mode}").alias("raw"), slots(F.col(f"raw{mode}"), mode).alias("template")) for mode in (TYPED, FOLDED, EXACT)]
    readings = raws.select("item_id", F.explode(F.array(F.array(*each))).alias("readings"))

    def starts(template: Column, exact: bool = False) -> Column:
        length = F.least(F.size(template), F.lit(WINDOW))
        all_ = F.when(F.size(template) > 0, F.sequence(F.lit(0), F.size(template) - length)).otherwise(F.array().cast("array<int>"))
        plain = lambda q: F.size(F.filter(F.slice(template, q + 1, length), lambda x: ~x.startswith("<")))
        return all_ if exact else F.filter(all_, lambda q: plain(q) >= F.when(length < WINDOW, 1).otherwise(PLAIN))

    any_ = F.exists(F.slice("readings", 1, 2), lambda r: F.size(starts(r.template)) > 0)
    rows = readings.select("item_id", F.explode(F.filter("readings", lambda r: (r.mode == EXACT) != any_)).alias("r")).select("item_id", "r.*")
    rows = rows.withColumn("qs", F.when(F.col("mode") == EXACT, starts(F.col("template"), True)).otherwise(starts(F.col("template")))).where(F.size("qs") > 0)
    # Which slots have equal values decides whether a document's are consistent, and not what the values are.
    equal = F.transform("raw", lambda x, i: F.when(F.get("template", i).startswith("<"), F.array_position("raw", x)).otherwise(F.lit(0)))
    rows = rows.withColumn("class", F.unhex(F.md5(F.concat_ws("\n", "mode", F.concat_ws(" ", "template"), F.concat_ws(" ", equal.cast("array<string>"))))))
    same = {c: F.first(c).alias(c) for c in ("mode", "template", "qs")}
    classes = rows.groupBy("class").agg(*same.values(), F.min_by("raw", "item_id").alias("raw"), F.min("item_id").alias("item_id"), F.count("*").alias("n_of"))
    sizes = [F.least(F.size("template"), F.lit(WINDOW)).alias("length"), F.size("template").alias("n_tokens"), F.size("qs").alias("n_windows")]
    classes = written(classes.select("class", "mode", "raw", "template", "qs", "item_id", "n_of", *sizes), "benchmark-classes")
    of_class = ["class", "mode", "length", "n_tokens", "n_windows"]
    grams = classes.select(*of_class, "qs", F.explode(F.array(F.transform("template", lambda x: F.xxhash64(x)))).alias("hashes"))
    grams = grams.select("*", F.explode(F.array(pairs(F.col("hashes")))).alias("pairs"))
    grams = grams.select(*of_class, "qs", F.posexplode(windows(F.col("hashes"), F.col("pairs"), F.col("length"), list(range(1, WINDOW + 1)))).alias("q", "h"))
    grams = grams.where(F.array_contains("qs", F.col("q"))).withColumn("h", keyed(F.col("h"), F.col("mode"), F.col("length"))).drop("qs")
    return classes, written(grams, "benchmark-windows")


def shared(runs: Column) -> Column:
    """The share of an item's windows that neighbouring alignments (``shift``, ``qs``) have together."""
    return F.size(F.array_distinct(F.flatten(F.transform(runs, lambda r: r.qs)))) / F.col("n_windows")


def enough(runs: Column) -> Column:
    """Whether neighbouring alignments have ``COVER`` of the windows or, ``QUOTE`` at least, of the tokens, or one of them ``QUOTE`` tokens in a row.

    Tokens in a row are those of windows that overlap or adjoin; there are ``QUOTE`` where two of these begin so far apart as asked below.
    """
    quoted = lambda r: F.exists(r.qs, lambda q: F.arrays_overlap(r.qs, F.sequence(q + (QUOTE - WINDOW), q + WINDOW)))
    tokens = F.flatten(F.transform(F.flatten(F.transform(runs, lambda r: r.qs)), lambda q: F.sequence(q, q + F.col("length") - 1)))
    covered = F.size(F.array_distinct(tokens)) >= F.greatest(F.lit(QUOTE), F.col("n_tokens") * COVER)
    return (shared(runs) >= COVER) | covered | (F.col("length") == WINDOW) & F.exists(runs, quoted)


def consistent(run: Column) -> Column:
    """Whether the slots of an alignment stand for equal values in ``raw`` and ``doc_raw``, but for ``CONFLICTS`` of them."""
    places = F.filter(F.sequence(F.lit(0), F.size("template") - 1), lambda j: F.exists(run.qs, lambda q: (q <= j) & (j < q + F.col("length"))) & F.get("template", j).startswith("<"))
    pairs = F.array_distinct(F.transform(places, lambda j: F.struct(F.get("raw", j).alias("of_item"), F.get("doc_raw", j + run.shift).alias("of_doc"))))
    values = lambda name: F.size(F.array_distinct(F.transform(pairs, lambda x: x[name])))
    return F.size(pairs) * 2 - values("of_item") - values("of_doc") <= F.size(pairs) * CONFLICTS


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per contaminated text, written: ``tie`` (of the text), ``item_id`` (the smallest of its items), ``n_items`` (in the reading that finds most), ``share`` (the
    largest share of an item's windows).

    NULL and empty texts, and texts without a letter or digit, of documents or items, match nothing. Equal texts are one row, whatever their number. Items of equal text count once, with the
    smallest id. Empty tables give an empty result. Documents are scanned once for windows of all readings and lengths, and once more for the texts with matches.
    """
    with passing_tables(docs.sparkSession):
        classes, grams = benchmark_classes(benchmark, item_key, item_text)
        kinds = {r["mode"]: sorted(r.lengths) for r in grams.groupBy("mode").agg(F.collect_set("length").alias("lengths")).collect()}  # readings, and lengths from 1 to WINDOW
        rows = docs.where(F.col(text).isNotNull()).select(tie_of(F.col(text)).alias("tie"), F.col(text).alias("body"))
        if not kinds:
            none = F.lit(None).cast
            empty = rows.select("tie", none(benchmark.schema[item_key].dataType).alias("item_id"), F.lit(0).cast("long").alias("n_items"), F.lit(0.0).alias("share"))
            return written(empty.limit(0), "leaks", stays=True)
        raws = rows.select("tie", *[raw_tokens(F.col("body"), mode).alias(f"raw{mode}") for mode in kinds])
        each = [F.struct(F.lit(mode).alias("mode"), F.array(*map(F.lit, lengths)).alias("lengths"), slots(F.col(f"raw{mode}"), mode, lambda x: F.xxhash64(x)).alias("hashes")) for mode, lengths in kinds.items()]
        read = raws.select("tie", F.explode(F.array(*each)).alias("r")).select("tie", "r.*", F.explode(F.array(pairs(F.col("r.hashes")))).alias("pairs"))
        read = read.select("tie", "mode", "hashes", "pairs", F.explode("lengths").alias("length"))
        every = windows(F.col("hashes"), F.col("pairs"), F.col("length"), sorted({n for lengths in kinds.values() for n in lengths}))
        found = read.select("tie", "mode", "length", F.posexplode(every).alias("p", "h"))
        found = found.select("tie", "p", keyed(F.col("h"), F.col("mode"), F.col("length")).alias("_h"))
        of_class = ["length", "n_tokens", "n_windows"]
        hits = found.join(bounded(grams, MOST_WINDOWS), F.col("h") == F.col("_h"))
        hits = hits.select("tie", "class", (F.col("p") - F.col("q")).alias("shift"), "q", *of_class)
        of = ["tie", "class"]
        runs = hits.groupBy(*of, "shift").agg(F.collect_set("q").alias("qs"), *[F.first(c).alias(c) for c in of_class])
        # Two bands for each alignment, so that any neighbours share one.
        bands = F.explode(F.array(F.floor(F.col("shift") / SLACK), F.floor(F.col("shift") / SLACK) - 1)).alias("band")
        runs = runs.select(*of, bands, F.struct("shift", "qs").alias("run"), *of_class)
        runs = runs.groupBy(*of, "band").agg(F.collect_list("run").alias("runs"), *[F.first(c).alias(c) for c in of_class])
        runs = written(runs.withColumn("share", shared(F.col("runs"))).where(enough(F.col("runs"))).select(*of, "runs"), "runs")

        # Slot consistency needs the values: only texts with a run are read for them, each once.
        checked = bounded(written(runs.select(F.col("tie").alias("_tie")).distinct(), "checked"), MOST_CHECKED)
        bodies = rows.join(checked, F.col("tie") == F.col("_tie"), "left_semi").groupBy("tie").agg(F.first("body").alias("body"))
        each = [F.struct(F.lit(mode).alias("mode"), raw_tokens(F.col("body"), mode).alias("raw")) for mode in kinds]
        bodies = bodies.select(F.col("tie").alias("_tie"), F.explode(F.array(*each)).alias("r")).select("_tie", F.col("r.mode").alias("_mode"), F.col("r.raw").alias("doc_raw"))
        both = runs.join(classes.withColumnRenamed("class", "_class"), F.col("class") == F.col("_class"))
        both = both.join(bodies, (F.col("tie") == F.col("_tie")) & (F.col("mode") == F.col("_mode")))
        leaks = both.withColumn("runs", F.filter("runs", consistent)).withColumn("share", shared(F.col("runs"))).where(enough(F.col("runs")))
        leaks = leaks.groupBy(*of).agg(F.first("mode").alias("mode"), F.min("item_id").alias("item_id"), F.first("n_of").alias("n_of"), F.max("share").alias("share"))
        leaks = leaks.groupBy("tie", "mode").agg(F.min("item_id").alias("item_id"), F.sum("n_of").alias("n_of"), F.max("share").alias("share"))
        return written(leaks.groupBy("tie").agg(F.min("item_id").alias("item_id"), F.max("n_of").alias("n_items"), F.max("share").alias("share")), "leaks", stays=True)


def judge_contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``contaminated``, ``item_id``, ``n_items`` and ``share`` for every row of ``docs``; other columns are ignored."""
    found = contaminated(docs, benchmark, key, text).withColumnRenamed("tie", "_tie")
    rows = docs.select(F.col(key).alias("_key"), tie_of(F.col(text)).alias("_own"), F.col(text).isNotNull().alias("_any"))
    out = rows.join(bounded(found, MOST_CHECKED), F.col("_any") & (F.col("_own") == F.col("_tie")), "left")
    return out.select(F.col("_key").alias(key), F.col("_tie").isNotNull().alias("contaminated"), "item_id", F.coalesce("n_items", F.lit(0)).alias("n_items"), F.coalesce("share", F.lit(0.0)).alias("share"))


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without a benchmark item, with all their columns."""
    tie = fresh(*docs.columns)
    found = contaminated(docs, benchmark, key, text).select(F.col("tie").alias(tie))
    return docs.join(bounded(found, MOST_CHECKED), F.col(text).isNotNull() & (tie_of(F.col(text)) == F.col(tie)), "left_anti")
