"""Epoch-millisecond and calendar expressions (session zone is UTC)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def epoch_ms(ntz: Column | str) -> Column:
    """Milliseconds since 1970 of a zone-less timestamp, whatever the session zone."""
    ntz = F.col(ntz) if isinstance(ntz, str) else ntz
    return F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ntz)


def window_floor(ms: Column, size_ms: int) -> Column:
    """Start of the tumbling window that holds ``ms``."""
    return ms - F.pmod(ms, F.lit(size_ms))


def day_of(ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd")


def hour_of(ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(ms), "HH")


def date_text_part(text: Column) -> Column:
    """``yyyy-MM-dd`` of a ``yyyy-MM-dd HH:mm:ss`` text."""
    return F.split_part(text, F.lit(" "), F.lit(1))


def hour_text_part(text: Column) -> Column:
    """``HH`` of a ``yyyy-MM-dd HH:mm:ss`` text."""
    return F.split_part(F.split_part(text, F.lit(" "), F.lit(2)), F.lit(":"), F.lit(1))


def age_years(birthday: Column, today: Column) -> Column:
    """Completed calendar years; a 29 February birthday completes on 1 March in other years."""
    not_yet = F.date_format(today, "MMdd") < F.date_format(birthday, "MMdd")
    return F.year(today) - F.year(birthday) - not_yet.cast("int")
