"""Numbers that arrive as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


NUMBER = r"^\s*[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?\s*$"


def try_int(text: Column) -> Column:
    """Integer from text: blanks trimmed, fractions rounded half away from zero, anything else gives null."""
    text = text.cast("string")
    return F.round(F.when(text.rlike(NUMBER), text).try_cast("double")).try_cast("int")


def id_text(value: Column) -> Column:
    """One spelling for an id stored as text, whole number or float (`12`, `12.0`). Whole numbers keep all digits."""
    return F.coalesce(value.try_cast("bigint"), value.try_cast("double").try_cast("bigint")).cast("string")


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """`part` of `whole` in percent, 0 when there is nothing to count."""
    return F.bround(F.lit(100.0) * part / F.greatest(whole, F.lit(1)), digits)


def share(part: Column, whole: Column) -> Column:
    """Ratio with two decimals, null for an empty whole."""
    return F.round(part / F.nullif(whole, F.lit(0)), 2)
