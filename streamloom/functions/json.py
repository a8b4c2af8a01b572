"""Reading JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def parsed(text: str, fields: dict[str, str]) -> Column:
    """The fields of a JSON text as columns, for use in ``select``.

    As a generator's output the fields cannot be traded for the text by a filter pushed down later, so every text
    is parsed once, and only the fields named are read from it.
    """
    schema = ", ".join(f"`{name}` {kind}" for name, kind in fields.items())
    return F.inline(F.array(F.from_json(text, schema)))


#: How many levels an object may have inside it for a pattern to find its end; deeper ones are found by a scan over the text's tokens.
DEPTH = 8

_STRING = r'"(?:[^"\\]++|\\[\s\S])*+"'


def _nested(depth: int) -> str:
    inner = f"|{_nested(depth - 1)}" if depth else ""
    return rf'[{{\[](?:[^{{}}\[\]"]++|{_STRING}{inner})*+[}}\]]'


def raw_object(text: Column, name: str) -> Column:
    """The object or list under a top-level name of a JSON text, character for character and nested to any depth; NULL if there is none.

    A parsed and rewritten object would lose digits and closing zeros of its numbers. A pattern finds an object with ``DEPTH`` levels
    inside at most; only a text in which it finds nothing is scanned.
    """
    value = _nested(DEPTH)
    member = rf'\s*+{_STRING}\s*+:\s*+(?:{_STRING}|{value}|[^,{{}}\[\]"]++)\s*+,'
    found = F.regexp_extract(text, rf'^\s*+\{{(?:{member})*?\s*+"{name}"\s*+:\s*+({value})', 1)
    return F.when(found != "", found).when(text.contains(f'"{name}"'), _scanned_object(text, name))


#: Tokens of a JSON text: strings, marks, and anything between them; together they are the text.
_TOKEN = rf'{_STRING}|[{{}}\[\]:,"]|[^{{}}\[\]:,"]++'


def _scanned_object(text: Column, name: str) -> Column:
    """``raw_object`` by one fold over the tokens, which counts open brackets and notes where the value begins and ends."""
    tokens = F.regexp_extract_all(text, F.lit(_TOKEN), 0)
    # `before`: what the last mark at the top was: 'name' after the wanted name, 'open' after its colon.
    state = F.struct(F.lit(0).alias("at"), F.lit(0).alias("depth"), F.lit("").alias("before"), F.lit(-1).alias("first"), F.lit(-1).alias("last"))

    def step(s: Column, token: Column) -> Column:
        opens, closes = token.isin("{", "["), token.isin("}", "]")
        depth = s["depth"] + opens.cast("int") - closes.cast("int")
        top, blank = s["depth"] == 1, F.regexp_replace(token, r"\s", "") == ""
        begins = top & opens & (s["before"] == "open") & (s["first"] < 0)
        ends = closes & (depth == 1) & (s["first"] >= 0) & (s["last"] < 0)
        member = (s["depth"] == 0) & (token == "{")
        before = (
            F.when(blank | (~top & ~member), s["before"])
            .when(member | (token == ","), "member")
            .when((token == f'"{name}"') & (s["before"] == "member"), "name")
            .when((token == ":") & (s["before"] == "name"), "open")
            .otherwise("")
        )
        return F.struct(
            (s["at"] + 1).alias("at"), depth.alias("depth"), before.alias("before"),
            F.when(begins, s["at"]).otherwise(s["first"]).alias("first"), F.when(ends, s["at"]).otherwise(s["last"]).alias("last"),
        )

    cut = lambda f: F.when(f["last"] >= 0, F.array_join(F.slice(tokens, f["first"] + 1, f["last"] - f["first"] + 1), ""))
    return F.aggregate(tokens, state, step, cut)


def to_rows(df: DataFrame, text: str, fields: dict[str, str], raw: tuple[str, ...] = ()) -> DataFrame:
    """Replace the ``text`` column by the fields of its JSON; a broken text gives NULL fields.

    The fields named in ``raw`` are text and come as they stand in it.
    """
    others, kept = [c for c in df.columns if c != text], [n for n in raw if n in fields]
    if not kept:
        return df.select(*others, parsed(text, fields))
    rows = df.select(*others, F.col(text).alias("__text"), parsed(text, fields))
    # A plain value is not looked for in the text.
    exact = {n: F.when(F.col(n).rlike(r"^\s*[{\[]"), F.coalesce(raw_object(F.col("__text"), n), n)).otherwise(F.col(n)) for n in kept}
    return rows.withColumns(exact).drop("__text")
