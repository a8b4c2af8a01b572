"""Running aggregates in arrival order that split a hot key over many tasks.

A plain window partitioned by key sends a whole key to one task. Here the rows of a key are cut into
stretches of the arrival order. Each stretch is aggregated on the map side, the few
stretch results per key are accumulated, and what is carried into a stretch is put before its rows as one more
row, so a window over the stretch gives the running value. The rows are shuffled once and nothing is joined.

Stretches follow the rows, not the span of their numbers: ``cuts_for`` takes quantiles of the arrival numbers, between which rows
are equally many wherever gaps lie, and cuts each part into equal widths until stretches have about the root of all rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from streamloom.functions.clock import window_floor

SMALLEST_CHUNK = 1024
#: Parts between quantiles at most: however unevenly numbers lie inside a part, no stretch has more rows than about a 1,024th of all.
MOST_PARTS = 1024
#: Error of a quantile, as one over a share of the rows: a tenth of a part.
_ACCURACY = 10 * MOST_PARTS
_STRETCH = "__stretch"


@dataclass(frozen=True)
class Cuts:
    """Where stretches of arrival numbers begin: part ``i`` starts at ``lows[i]`` and is cut into stretches ``widths[i]`` long."""

    lows: tuple[int, ...]
    widths: tuple[int, ...]

    def start(self, seq: Column) -> Column:
        """The first number of the stretch that holds ``seq``; numbers below all parts belong to the first one."""
        if len(self.lows) == 1:
            return F.lit(self.lows[0]) + window_floor(seq - F.lit(self.lows[0]), self.widths[0])
        lows, widths = F.lit(list(self.lows)), F.lit(list(self.widths))
        steps = [1 << b for b in reversed(range((len(self.lows) - 1).bit_length()))]
        # Binary search: the last part that starts at or below the number, as a place from 0.
        part = F.aggregate(
            F.lit(steps), F.lit(0),
            lambda at, step: F.when(F.get(lows, at + step) <= seq, at + step).otherwise(at),
        )
        return F.transform(F.array(part), lambda at: F.get(lows, at) + window_floor(seq - F.get(lows, at), F.get(widths, at)))[0]


def cuts_for(df: DataFrame, seq: str) -> Cuts:
    """Stretches of about the root of the number of rows (``SMALLEST_CHUNK`` at least), by quantiles of the arrival numbers: one job, a small sketch per task."""
    shares = [i / MOST_PARTS for i in range(MOST_PARTS + 1)]
    rows, marks = df.agg(F.count(seq), F.percentile_approx(seq, shares, _ACCURACY)).first()
    if not rows:
        return Cuts((0,), (SMALLEST_CHUNK,))
    target = max(SMALLEST_CHUNK, int(rows ** 0.5))
    parts = max(1, min(MOST_PARTS, rows // target))
    bounds = sorted({marks[round(i * MOST_PARTS / parts)] for i in range(parts + 1)})
    bounds = [*bounds[:-1], bounds[-1] + 1] if len(bounds) > 1 else [bounds[0], bounds[0] + 1]
    pieces = max(1, -(-rows // (parts * target)))
    # Neighbouring parts about as dense as each other become one, with the width of the densest: numbers without gaps need no search.
    lows, widths, low, least, most = [], [], bounds[0], None, None
    for at, end in zip(bounds, bounds[1:]):
        width = end - at
        if least and max(most, width) > 2 * min(least, width):
            lows, widths, low, least = [*lows, low], [*widths, -(-least // pieces)], at, None
        least, most = (min(least, width), max(most, width)) if least else (width, width)
    return Cuts((*lows, low), (*widths, -(-least // pieces)))


def running(
    df: DataFrame,
    keys: list[str],
    seq: str,
    values: dict[str, tuple[str, Column]],
    chunk: int | Cuts | None = None,
    earlier_only: bool = False,
) -> DataFrame:
    """Add running aggregates to every row of ``df``.

    ``seq`` is a unique whole number giving the arrival order; rows without one are dropped. ``values`` maps a new column to
    ``(kind, expression)`` with kind ``sum``, ``count``, ``max``, ``min`` or ``first``. With
    ``earlier_only`` the row itself is left out. ``chunk`` is a stretch length in arrival numbers, or where
    stretches begin; by default ``cuts_for`` finds that.
    """
    df = df.filter(F.col(seq).isNotNull())
    chunk = chunk or cuts_for(df, seq)
    start = chunk.start(F.col(seq)) if isinstance(chunk, Cuts) else window_floor(F.col(seq), chunk)
    groups = [*keys, _STRETCH]
    inputs = {f"__x_{name}": _input(kind, expr) for name, (kind, expr) in values.items()}
    cut = df.withColumns({_STRETCH: start, **inputs})

    kinds = {name: kind for name, (kind, _) in values.items()}
    stretches = cut.groupBy(*groups).agg(*[_total(kind, f"__x_{name}", seq).alias(f"__x_{name}") for name, kind in kinds.items()])
    before = Window.partitionBy(*keys).orderBy(_STRETCH).rowsBetween(Window.unboundedPreceding, -1)
    carried = stretches.select(*groups, *[_over(kind, f"__x_{name}", before).alias(f"__x_{name}") for name, kind in kinds.items()])

    # A carried row has no arrival number, so it sorts before the rows of its stretch.
    last = -1 if earlier_only else Window.currentRow
    inside = Window.partitionBy(*groups).orderBy(F.col(seq).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, last)
    together = cut.unionByName(carried, allowMissingColumns=True)
    results = together.withColumns({f"__r_{name}": _over(kind, f"__x_{name}", inside) for name, kind in kinds.items()})
    return results.filter(F.col(seq).isNotNull()).select(
        *df.columns, *[_output(kind, F.col(f"__r_{name}")).alias(name) for name, kind in kinds.items()]
    )


def _input(kind: str, expr: Column) -> Column:
    if kind == "first":
        return F.struct(expr.alias("v"))
    return expr.isNotNull().cast("bigint") if kind == "count" else expr


def _total(kind: str, column: str, seq: str) -> Column:
    if kind == "first":
        return F.min_by(column, seq)
    return {"sum": F.sum, "count": F.sum, "max": F.max, "min": F.min}[kind](column)


def _over(kind: str, column: str, window) -> Column:
    if kind == "first":
        return F.first(column, ignorenulls=True).over(window)
    return {"sum": F.sum, "count": F.sum, "max": F.max, "min": F.min}[kind](column).over(window)


def _output(kind: str, result: Column) -> Column:
    if kind == "first":
        return result["v"]
    return F.coalesce(result, F.lit(0)) if kind == "count" else result


def running_sum_keep_first(df: DataFrame, key: str, value: str, keep: list[str], seq: str = "seq", chunk: int | Cuts | None = None) -> DataFrame:
    """Running sum of ``value`` per key; the columns in ``keep`` stay at the key's first record."""
    return _with_first(df, key, ("sum", value), keep, seq, chunk)


def running_max_keep_first(df: DataFrame, key: str, value: str, keep: list[str], seq: str = "seq", chunk: int | Cuts | None = None) -> DataFrame:
    """Running maximum of ``value`` per key; the columns in ``keep`` stay at the key's first record."""
    return _with_first(df, key, ("max", value), keep, seq, chunk)


def _with_first(df, key, aggregate, keep, seq, chunk):
    kind, value = aggregate
    values = {f"__r_{value}": (kind, F.col(value))}
    values |= {f"__r_{c}": ("first", F.col(c)) for c in keep}
    out = running(df.select(key, *keep, value, seq), [key], seq, values, chunk)
    return out.select(F.col(seq), F.col(key), *[F.col(f"__r_{c}").alias(c) for c in [*keep, value]])


def running_pair_sum(df: DataFrame, key: str, value: Column, seq: str = "seq", chunk: int | Cuts | None = None) -> DataFrame:
    """``(key, value)`` pairs reduced by adding: one updated pair per record."""
    pairs = df.select(F.col(seq), F.col(key), value.alias("one"))
    return running(pairs, [key], seq, {"total": ("sum", F.col("one"))}, chunk).drop("one")


def running_reduce_latest(df: DataFrame, key: str, value: str, latest: list[str], seq: str = "seq", chunk: int | Cuts | None = None) -> DataFrame:
    """Running sum of ``value`` per key; the columns in ``latest`` come from the record itself."""
    out = running(df.select(seq, key, *latest, value), [key], seq, {"__sum": ("sum", F.col(value))}, chunk)
    return out.select(F.col(seq), F.col(key), *latest, F.col("__sum").alias(value))


def count_window(
    df: DataFrame, key: str, size: int, every: int, aggs: dict[str, tuple[str, str]],
    seq: str = "seq", chunk: int | Cuts | None = None,
) -> DataFrame:
    """Aggregate the last ``size`` rows of each key at every ``every``-th row of the key.

    ``aggs`` maps an output column to ``(kind, column)`` with kind ``sum``, ``count``, ``max`` or ``min``.
    Rows are numbered per key, collapsed to panes of ``every`` rows, and each pane is handed to the
    firings that cover it, so a hot key is spread over its panes. The first firings see fewer rows.
    """
    if size % every:
        raise ValueError("size must be a multiple of every")
    cols = sorted({col for _, col in aggs.values()})
    ranked = running(df.select(seq, key, *[c for c in cols if c != key]), [key], seq, {"__n": ("count", F.lit(1))}, chunk)
    panes = (
        ranked.withColumn("__pane", (window_floor(F.col("__n") - 1, every) / every).cast("bigint"))
        .groupBy(key, "__pane")
        .agg(F.count(F.lit(1)).alias("__rows"), F.max(seq).alias("fired_at"),
             *[_plain(kind, col).alias(name) for name, (kind, col) in aggs.items()])
    )
    covers = F.sequence(F.col("__pane"), F.col("__pane") + (size // every - 1))
    again = {"sum": F.sum, "count": F.sum, "max": F.max, "min": F.min}
    return (
        panes.withColumn("fire", F.explode(covers))
        .groupBy(key, "fire")
        .agg(
            F.max(F.when((F.col("__pane") == F.col("fire")) & (F.col("__rows") == every), F.col("fired_at"))).alias("fired_at"),
            F.sum("__rows").alias("rows"),
            *[again[kind](name).alias(name) for name, (kind, _) in aggs.items()],
        )
        .filter("fired_at IS NOT NULL")
        .withColumn("fire", F.col("fire") + 1)
    )


def _plain(kind: str, col: str) -> Column:
    return {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min}[kind](col)
