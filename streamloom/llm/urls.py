"""URL filters: a blocked Bloom filter of listed canonical URLs, then an exact hash join.

Each listed URL sets one bit in each of the eight words of one block, so a look-up touches one block. The
filter is a table of blocks that a grouped ``bit_or`` builds; pages look their block up in a broadcast of at
most ``MOST_BLOCKS`` rows, or by a join on the block if the list needs more. Only possible hits go to the exact join
with the listed URLs, which removes the false positives.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from streamloom.llm.common import ascii_lower, bounded, fresh, written

#: A block has 8 words of 32 bits; at 16 bits a URL about one in 600 unlisted URLs passes.
WORDS, WORD_BITS, BITS_PER_URL = 8, 32, 16
#: Blocks that are broadcast at most (40 bytes each as columns: 10 MB). A larger filter is joined by shuffle.
MOST_BLOCKS = 1 << 18

#: (host, path, verdict)
Rule = tuple[str, str, str]


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; empty for NULL and without ``://``."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to ``? #`` or the end."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without ``www.`` or ``m.``, and path without a last slash or ``.html``; scheme, query and fragment go. NULL if there is no host."""
    host = F.regexp_replace(host_of(url), r"^(www|m)\.", "")
    path = F.regexp_replace(path_of(url), r"(\.html|/)+$", "")
    return F.when(host != "", F.concat(host, path))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule], value: Column | None = None) -> Column:
    """The longest rule that fits, as host and path, or its verdict if ``value`` is asked for. Ties: the first by text."""
    ordered = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1]))
    fits = [((host == h) | host.endswith("." + h)) & path.startswith(p) for h, p, _ in ordered]
    pick = [r[2] if value is not None else r[0] + r[1] for r in ordered]
    return reduce(lambda rest, k: F.when(fits[k], F.lit(pick[k])).otherwise(rest), reversed(range(len(ordered))), F.lit(None).cast("string"))


def _block(key: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(1), key), F.lit(n_blocks))


def _bits(key: Column) -> list[Column]:
    """For each word of the block the one bit that a URL sets: five bits of a second hash."""
    h = F.xxhash64(F.lit(2), key)
    place = lambda w: F.shiftrightunsigned(h, 5 * w).bitwiseAND(F.lit(WORD_BITS - 1)).cast("int")
    return [F.call_function("shiftleft", F.lit(1), place(w)) for w in range(WORDS)]


def build_filter(listed: DataFrame, n_listed: int) -> tuple[DataFrame, int]:
    """The filter of ``listed`` (column ``canonical``): a row for each block that has a bit, and the number of blocks."""
    n_blocks = max(1, -(-n_listed * BITS_PER_URL // (WORDS * WORD_BITS)))
    key = F.col("canonical")
    blocks = listed.select(_block(key, n_blocks).alias("block"), *[b.alias(f"w{w}") for w, b in enumerate(_bits(key))])
    return blocks.groupBy("block").agg(*[F.bit_or(f"w{w}").alias(f"w{w}") for w in range(WORDS)]), n_blocks


def judge_urls(pages: DataFrame, listed: DataFrame, rules: Sequence[Rule], url: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``listed`` and ``verdict``, a row for each row.

    ``listed`` has a column ``url``. A rule decides if one fits; else a page is blocked if its canonical URL is
    listed, and allowed if not. NULL and hostless URLs have empty host and path, fit no rule and are never
    listed. Repeated URLs, in either table, get the same verdict each time. Columns of ``pages`` with the
    names made here are replaced. An empty list blocks nothing.
    """
    made = ["host", "path", "rule", "listed", "verdict"]
    key, joined = fresh(*pages.columns), fresh(*pages.columns)
    names = written(listed.select(canonical(F.col("url")).alias("canonical")).where("canonical IS NOT NULL").distinct(), "listed")
    blocks, n_blocks = build_filter(names, names.count())
    own = {c: fresh(*pages.columns) for c in blocks.columns}  # the user's columns may be called like these
    blocks = bounded(written(blocks.withColumnsRenamed(own), "blocks"), MOST_BLOCKS)

    rows = pages.withColumn(key, canonical(F.col(url)))
    own_block = F.when(F.col(key).isNotNull(), _block(F.col(key), n_blocks))
    probed = rows.withColumn(joined, own_block).join(blocks, F.col(joined) == F.col(own["block"]), "left")
    possible = F.coalesce(reduce(lambda a, b: a & b, [F.col(own[f"w{w}"]).bitwiseAND(b) != 0 for w, b in enumerate(_bits(F.col(key)))]), F.lit(False))
    probed = probed.withColumn("listed", possible).select(*[F.col(f"`{c}`") for c in pages.columns if c not in made], key, "listed")
    # The exact join sees possible hits alone. A URL is once in the list, so hits map to one row each and a
    # URL that many pages share is a skewed left side, which adaptive execution splits.
    hits = probed.where("listed").drop("listed").join(names.withColumnRenamed("canonical", joined).withColumn("listed", F.lit(True)), F.col(key) == F.col(joined), "left")
    hits = hits.withColumn("listed", F.coalesce("listed", F.lit(False))).drop(joined)
    judged = hits.unionByName(probed.where("NOT listed")).drop(key)

    host, path = host_of(F.col(url)), path_of(F.col(url))
    judged = judged.withColumn("host", host).withColumn("path", path)
    fits = lambda value=None: matching_rule(F.col("host"), F.col("path"), rules, value)
    by_list = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    return judged.withColumn("rule", fits()).withColumn("verdict", F.coalesce(fits(F.lit(1)), by_list))
