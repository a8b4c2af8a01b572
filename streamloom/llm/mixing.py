"""Mixing sources to target weights by Pareto order sampling.

A source whose target is r times its size takes ``floor(r)`` whole copies of each document for certain. The rest is a sample in which a document's chance
of inclusion grows with its size: ``scale × size``, and 1, one more whole copy, where that is more. The scale is such that the words expected are
the words wanted. Documents that aren't certain are ranked by the odds of a random number over the odds of inclusion, and the first
in that order are taken up to the fixed size, measured in words. Everything is DataFrame operations.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from streamloom.llm.common import bounded, fresh, uniform, word_count, written

#: Bins of either of the two histograms that find the place of the cut.
BINS = 4096
#: Sources that are broadcast at most (about 100 bytes each); more are joined by shuffle.
MOST_SOURCES = 50_000


def targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """``sizes`` (``source``, ``source_size``) with ``target``.

    Sources in code-point order, NULL last, weigh ``weights`` in turn and share ``share`` of all words. No target exceeds ``most``
    times its source; the excess goes to the others by weight until none does. That fixed point is
    ``min(most × size, level × weight)``: in order of ``size / weight`` the first sources are full, and the level
    is what is left over the weight that is left. The windows run over one row per source.
    """
    everything = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(everything) - 1, F.lit(len(weights))) + 1).cast("int"))
    weighed = sizes.withColumn("weight", turn).withColumn("full", F.col("source_size") * F.lit(float(most)))
    by_full = Window.orderBy(F.col("full") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = by_full.rowsBetween(Window.unboundedPreceding, -1), by_full.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy()) * F.lit(float(share))
    level = (total - F.coalesce(F.sum("full").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    levels = weighed.withColumn("level", level)
    # The first source that its own level does not fill sets the level for itself and all after it.
    levels = levels.withColumn("open", F.min(F.when(F.col("level") * F.col("weight") <= F.col("full"), F.struct(F.col("full") / F.col("weight"), F.col("source").isNull(), F.col("source"), "level"))).over(Window.partitionBy()))
    target = F.least(F.col("full"), F.coalesce(F.col("open")["level"] * F.col("weight"), F.col("full")))
    return levels.select("source", "source_size", target.alias("target"))


def _scales(thin: DataFrame, budgets: DataFrame) -> DataFrame:
    """``_src``, ``scale`` and ``certain`` (words of the documents that are certain) of each source of ``budgets`` (``_src``, ``budget``).

    Documents are certain from the largest on, until the scale that the other ones need gives the next less than 1. The window runs over the distinct
    sizes of a source, whose sums are exact, so reruns agree.
    """
    sizes = thin.where("size > 0").groupBy("s", "size").agg(F.count("*").alias("n"))
    sizes = sizes.join(bounded(budgets, MOST_SOURCES), F.col("s").eqNullSafe(F.col("_src")))
    exact = lambda c: c.cast("decimal(38,0)")
    order = Window.partitionBy("_src").orderBy(F.col("size").desc())
    larger = F.coalesce(F.sum(exact(F.col("size") * F.col("n"))).over(order.rowsBetween(Window.unboundedPreceding, -1)), exact(F.lit(0))).cast("double")
    squares = F.sum(exact(F.col("size") * F.col("size")) * F.col("n")).over(order.rowsBetween(0, Window.unboundedFollowing)).cast("double")
    scaled = sizes.select("_src", "size", larger.alias("certain"), ((F.col("budget") - larger) / squares).alias("scale"))
    least = scaled.where(F.col("scale") * F.col("size") < 1.0).groupBy("_src").agg(F.max_by(F.struct("scale", "certain"), "size").alias("found"))
    return least.select("_src", "found.scale", "found.certain")


def _crossing(rows: DataFrame, key: Column, name: str) -> DataFrame:
    """Of ``rows`` (``s``, ``size``, ``budget``, ``key``) those in the bin of their source in which the budget runs out, what comes before it taken off."""
    bins = rows.groupBy("s", key.alias(name)).agg(F.sum("size").alias("n"), F.first("budget").alias("budget"))
    through = F.sum("n").over(Window.partitionBy("s").orderBy(name).rowsBetween(Window.unboundedPreceding, 0))
    bins = bins.withColumn("through", through).where("through >= budget AND through - n < budget")
    return bins.select(F.col("s").alias("_s"), F.col(name).alias("_bin"), (F.col("budget") - F.col("through") + F.col("n")).alias("_budget"))


def mix(docs: DataFrame, weights: Sequence[float], share: float = 1.5, most: float = 2.0, seed: int = 0, source: str = "source", key: str = "doc_id", text: str = "text", odds: str | None = None) -> DataFrame:
    """``docs`` with ``size`` (words), ``source_size``, ``target`` and ``copies``, a row for each row; ``copies × size`` is what the mix takes.

    A document has ``floor(r)`` or one more copies, r being its source's target over its size. ``odds`` names a column of positive factors on
    the odds of inclusion that its size gives a document. The sample
    of a source ends where its words come nearest to the target: half a document off at most. Rows without words are not sampled. Rows rank by an MD5 of
    seed and key, or of the text where the key is NULL, so reruns agree; rows alike in key and odds are taken together. NULL
    texts have size 0 and NULL sources are one source. An empty source gets target 0 and as many copies as the rank says, of no words. An empty table gives an empty
    one; columns with the names made here are replaced.
    """
    made = ["size", "source_size", "target", "copies"]
    kept = [c for c in docs.columns if c not in made]
    s, draw, tie = (fresh(*kept) for _ in range(3))
    name = F.coalesce(F.col(key).cast("string"), F.md5(F.col(text)), F.lit(""))
    drawn = uniform(F.lit(seed), name)
    factor = F.col(odds).cast("double") if odds else F.lit(1.0)
    rows = docs.select(*[F.col(f"`{c}`") for c in kept]).withColumn("size", word_count(F.col(text)))
    rows = rows.withColumn(draw, drawn / (F.lit(1.0) - drawn) / factor).withColumn(tie, name)

    thin = written(rows.select(F.col(source).alias("s"), "size", F.col(draw).alias("draw"), F.col(tie).alias("tie")), "mix-rows")
    sizes = thin.groupBy(F.col("s").alias("source")).agg(F.sum("size").alias("source_size"))
    plan = written(targets(sizes, weights, share, most), "targets")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(ratio)
    plan = plan.withColumn("whole", whole).withColumn("part", ratio - whole).withColumn("budget", F.col("target") - whole * F.col("source_size"))

    # Odds of a document's number over odds of its inclusion. Bins of rank / (1 + rank) keep the search for the cut distributed.
    wanted = plan.where("part > 0").select(F.col("source").alias("_src"), "budget")
    scales = written(_scales(thin, wanted), "mix-scales")
    plan = written(plan.join(scales, F.col("source").eqNullSafe(F.col("_src")), "left").drop("_src"), "mix-budgets")

    def rank_of(draw: Column, chance: Column) -> Column:
        return draw / (chance / (F.lit(1.0) - chance))

    wanted = bounded(plan.where("scale IS NOT NULL").select(F.col("source").alias("_src"), (F.col("budget") - F.col("certain")).alias("budget"), "scale"), MOST_SOURCES)
    left = thin.where("size > 0").join(wanted, F.col("s").eqNullSafe(F.col("_src"))).where(F.col("scale") * F.col("size") < 1.0)
    left = left.select("s", "size", rank_of(F.col("draw"), F.col("scale") * F.col("size")).alias("rank"), "tie", "budget")
    spread = F.col("rank") / (F.lit(1.0) + F.col("rank")) * BINS
    for depth, bin_ in enumerate((F.floor(spread), F.floor((spread - F.floor(spread)) * BINS))):
        found = written(_crossing(left, bin_, "bin"), f"cut-{depth}")
        left = left.drop("budget").join(bounded(found, MOST_SOURCES), F.col("s").eqNullSafe(F.col("_s")) & (bin_ == F.col("_bin"))).drop("_s", "_bin").withColumnRenamed("_budget", "budget")
    order = Window.partitionBy("s").orderBy("rank", "tie")
    through = left.withColumn("through", F.sum("size").over(order))
    ends = through.withColumn("rank_of_end", F.row_number().over(order))
    near = F.col("through") - F.col("budget") <= F.col("budget") - (F.col("through") - F.col("size"))
    cut = ends.where((F.col("through") <= F.col("budget")) | near & (F.col("through") - F.col("size") < F.col("budget")))
    cut = cut.groupBy("s").agg(F.max(F.struct("rank", "tie")).alias("cut"))
    # Where no row of the last bin fits, the sample ends before that bin.
    floor_ = left.groupBy("s").agg(F.min(F.struct("rank", "tie")).alias("start"))
    cuts = floor_.join(cut, floor_["s"].eqNullSafe(cut["s"]), "left").select(floor_["s"].alias("_s"), "cut", "start")
    plan = written(plan.join(cuts, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s"), "mix-plan")

    whole_, scale, cut, start = (fresh(*kept) for _ in range(4))  # the user's columns may be called like the plan's
    own = plan.select(F.col("source").alias(s), "source_size", "target", F.col("whole").alias(whole_), F.col("scale").alias(scale), F.col("cut").alias(cut), F.col("start").alias(start))
    out = rows.join(bounded(own, MOST_SOURCES), F.col(source).eqNullSafe(F.col(s)))
    chance = F.col(scale) * F.col("size")
    at = F.struct(rank_of(F.col(draw), chance).alias("rank"), F.col(tie).alias("tie"))
    drawn_in = F.coalesce(F.when(F.col(cut).isNotNull(), at <= F.col(cut)).otherwise(at < F.col(start)), F.lit(False))
    sampled = (F.col("size") > 0) & F.coalesce((chance >= 1.0) | drawn_in, F.lit(False))
    copies = (F.col(whole_) + F.when(sampled, 1).otherwise(0)).cast("long")
    return out.withColumn("copies", copies).select(*[F.col(f"`{c}`") for c in kept], *made)


def mixed(docs: DataFrame, weights: Sequence[float], **options) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as ``mix`` says, with its columns alone."""
    copy = fresh(*docs.columns)
    # ``mix`` replaces columns of its names, so the user's own are carried under other ones.
    own = {c: fresh(*docs.columns) for c in docs.columns if c in ("size", "source_size", "target", "copies")}
    chosen = mix(docs.withColumnsRenamed(own), weights, **options).where("copies > 0")
    chosen = chosen.withColumn(copy, F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))))
    return chosen.select(*[F.col(f"`{own.get(c, c)}`").alias(c) for c in docs.columns])
