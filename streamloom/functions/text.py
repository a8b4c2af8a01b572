"""Text expressions; all of them run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Digits of Chinese numerals.
DIGITS = {
    "零": 0.0,
    "一": 1.0, "壹": 1.0,
    "二": 2.0, "贰": 2.0,
    "三": 3.0, "叁": 3.0,
    "四": 4.0, "肆": 4.0,
    "五": 5.0, "伍": 5.0,
    "六": 6.0, "陆": 6.0,
    "七": 7.0, "柒": 7.0,
    "八": 8.0, "捌": 8.0,
    "九": 9.0, "玖": 9.0,
    "十": 10.0, "拾": 10.0,
}
# Units. Ten counts as a digit above, so it never scales.
UNITS = {
    "分": 0.01,
    "角": 0.1, "毛": 0.1,
    "元": 1.0, "圆": 1.0,
    "百": 100.0, "佰": 100.0,
    "千": 1000.0, "仟": 1000.0,
    "万": 10000.0, "萬": 10000.0,
    "亿": 100000000.0,
}
# Fixed patterns: target tables of a script.
CREATED_OR_OVERWRITTEN = (
    r"(?i)\b(?:create|insert\s+overwrite)\s+table\s+(?:if\s+not\s+exists\s+)?(\w+(?:\.\w+)?)"
)
OVERWRITTEN = r"(?i)\binsert\s+overwrite\s+table\s+(\w+(?:\.\w+)?)"


def words(line: Column) -> Column:
    """Words of one line, split on single spaces.

    Leading and inner empty words stay, trailing ones go; an empty line is one empty word,
    a line of spaces has none.
    """
    body = F.rtrim(line)
    return (
        F.when(line == "", F.array(F.lit("")))
        .when(body == "", F.array().cast("array<string>"))
        .otherwise(F.split(body, " "))
    )


def lines(text: Column) -> Column:
    """Lines of a whole text."""
    return F.split(text, "\n")


def equal_ignore_case(a: Column, b: Column) -> Column:
    return F.lower(a) == F.lower(b)


def equal_ignore_space_case(a: Column, b: Column) -> Column:
    """``yes`` if the texts agree once spaces and case are ignored, else ``no``."""
    def plain(c: Column) -> Column:
        return F.lower(F.replace(c, F.lit(" "), F.lit("")))

    return F.when(plain(a) == plain(b), "yes").otherwise("no")


def upper_name(prefix: str, table: Column, suffix: Column) -> Column:
    """``prefix_TABLE_suffix``."""
    return F.concat(F.lit(prefix), F.lit("_"), F.upper(table), F.lit("_"), suffix)


def _looked_up(char: Column, values: dict[str, float]) -> Column:
    """Value of a character; NULL for one that has none."""
    place = F.instr(F.lit("".join(values)), char)
    return F.try_element_at(F.array(*[F.lit(v) for v in values.values()]), F.nullif(place, F.lit(0)))


# A digit, characters that mean nothing (zero among them), then a unit or the end of the text.
_TELLING = "".join(d for d, value in DIGITS.items() if value) + "".join(UNITS)
SCALED_DIGIT = "[{digits}][^{telling}]*(?:[{units}]|$)".format(
    digits=_TELLING[: -len(UNITS)], units="".join(UNITS), telling=_TELLING
)


def numeral_to_number(text: Column) -> Column:
    """Chinese numeral text → number text; characters that mean nothing are passed over.

    A unit scales the last digit since the unit before it, the last digit after the last unit counts once,
    and all of them are added from left to right. Zero is no digit here: it never waits for a unit.
    """
    def scaled(part: Column) -> Column:
        unit = _looked_up(F.right(part, F.lit(1)), UNITS)
        return _looked_up(F.left(part, F.lit(1)), DIGITS) * F.coalesce(unit, F.lit(1.0))

    parts = F.regexp_extract_all(text, F.lit(SCALED_DIGIT), 0)
    return F.aggregate(parts, F.lit(0.0), lambda total, part: total + scaled(part)).cast("string")


def script_tables(script: Column) -> Column:
    """Tables a script creates or overwrites, in order, repeats kept."""
    return F.regexp_extract_all(script, F.lit(CREATED_OR_OVERWRITTEN), 1)


def script_overwrites(script: Column) -> Column:
    """Tables a script overwrites, in order, repeats kept."""
    return F.regexp_extract_all(script, F.lit(OVERWRITTEN), 1)
