"""Arithmetic held as text, evaluated with an Arrow-batched function."""

from __future__ import annotations

import math
import re
from decimal import Decimal

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from streamloom.shipping import ship_by_value

ship_by_value(__name__)

_TOKEN = re.compile(r"\d+\.?\d*(?:[eE][+-]?\d+)?|\.\d+(?:[eE][+-]?\d+)?|[-+*/%()]|\S", re.ASCII)
_RANK = {"+": 1, "-": 1, "*": 2, "/": 2, "%": 2, "neg": 3}


def _divide(a: float, b: float) -> float:
    if b == 0:
        return math.nan if a == 0 or math.isnan(a) else math.copysign(math.inf, a) * math.copysign(1.0, b)
    return a / b


def _remainder(a: float, b: float) -> float:
    return math.nan if b == 0 or math.isinf(a) else math.fmod(a, b)


_APPLY = {
    "+": lambda a, b: a + b,
    "-": lambda a, b: a - b,
    "*": lambda a, b: a * b,
    "/": _divide,
    "%": _remainder,
}


def evaluate(text: str | None) -> float | None:
    """Value of ``+ - * / % ( )`` over decimals; NULL for NULL, empty or any other text."""
    if not text:
        return None
    values: list[float] = []
    pending: list[str] = []

    def settle() -> None:
        op = pending.pop()
        right = values.pop()
        values.append(-right if op == "neg" else _APPLY[op](values.pop(), right))

    want_value = True
    for symbol in _TOKEN.findall(text):
        if symbol[0] in "0123456789" or symbol[0] == "." and len(symbol) > 1:
            if not want_value:
                return None
            values.append(float(symbol))
            want_value = False
        elif symbol not in "+-*/%()":
            return None
        elif symbol == "(" or (want_value and symbol in "+-"):
            if not want_value:
                return None
            if symbol != "+":
                pending.append("neg" if symbol == "-" else "(")
        elif want_value:
            return None
        elif symbol == ")":
            while pending and pending[-1] != "(":
                settle()
            if not pending:
                return None
            pending.pop()
        else:
            while pending and pending[-1] != "(" and _RANK[pending[-1]] >= _RANK[symbol]:
                settle()
            pending.append(symbol)
            want_value = True
    if want_value or "(" in pending:
        return None
    while pending:
        settle()
    return values[0]


def number_text(value: float | None) -> str | None:
    """The text a Java script engine gives a number: whole ones of 32 bits as integers, others as ``Double.toString`` does.

    That is plain from a thousandth to ten millions, and with an exponent (``5.0E-4``, ``1.0E10``) beyond.
    """
    if value is None:
        return None
    if math.isnan(value):
        return "NaN"
    if math.isinf(value):
        return "Infinity" if value > 0 else "-Infinity"
    if value == int(value) and abs(value) < 2**31:
        return str(int(value))
    sign, digits, exponent = Decimal(repr(value)).normalize().as_tuple()
    text, place = "".join(map(str, digits)), len(digits) + exponent  # 0.text times ten to the place
    if 1e-3 <= abs(value) < 1e7:
        text = text.ljust(max(place, 0), "0").rjust(len(text) - min(place, 0), "0")
        whole, part, power = text[: max(place, 0)] or "0", text[max(place, 0) :] or "0", ""
    else:
        whole, part, power = text[0], text[1:] or "0", f"E{place - 1}"
    return f"{'-' * sign}{whole}.{part}{power}"


@F.pandas_udf(StringType())
def calculate(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: number_text(evaluate(t)) if isinstance(t, str) else None)
