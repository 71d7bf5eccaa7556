"""Optional predicates and their conjunction.

Each builder returns a Column, or None when its parameter is unset, so a page lists all its
predicates and `keep` applies the ones that are in force. Range bounds stay on the bare column
where the type allows it, which lets the parquet reader use them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hemicycle.functions.numbers import try_int
from hemicycle.functions.text import contains_any

LEGISLATURE = "_legislatura"


def conjunction(predicates: Iterable[Column | None]) -> Column | None:
    live = [p for p in predicates if p is not None]
    return reduce(lambda a, b: a & b, live) if live else None


def keep(df: DataFrame, *predicates: Column | None) -> DataFrame:
    """Rows that satisfy every predicate in force."""
    condition = conjunction(predicates)
    return df if condition is None else df.filter(condition)


def in_legislature(value: str | None) -> Column | None:
    return None if value is None else F.col(LEGISLATURE) == F.lit(value)


def one_of(column: str, values: Sequence | None) -> Column | None:
    return F.col(column).isin(list(values)) if values else None


def within_or_null(df: DataFrame, column: str, bounds: tuple[date, date] | None) -> Column | None:
    """Null or between two days, both included whole.

    Timestamps compare against the half-open interval, so a time on the last day counts; text is
    read as a date and unreadable text fails the test.
    """
    if bounds is None or bounds[0] is None or bounds[1] is None:
        return None
    low, high = bounds
    kind = df.schema[column].dataType
    value = F.col(column)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        end = F.lit(high + timedelta(days=1)).cast(kind)
        inside = (value >= F.lit(low).cast(kind)) & (value < end)
    elif isinstance(kind, T.DateType):
        inside = value.between(F.lit(low), F.lit(high))
    else:
        inside = value.try_cast("date").between(F.lit(low), F.lit(high))
    return value.isNull() | inside


def search(columns: Sequence[str], text: str | None, null_safe: bool = False) -> Column | None:
    return contains_any([F.col(c) for c in columns], text, null_safe) if text else None


def at_least(column: str, threshold: int | None) -> Column | None:
    """Numeric threshold on a text column; off at zero."""
    return try_int(F.col(column)) >= F.lit(threshold) if threshold and threshold > 0 else None


def flagged(column: str, mode: str, value: str) -> Column | None:
    """`all`, `only` rows carrying the flag, or `without` it (a null counts as without)."""
    if mode == "all":
        return None
    if mode == "only":
        return F.col(column) == F.lit(value)
    if mode == "without":
        return ~F.col(column).eqNullSafe(F.lit(value))
    raise ValueError(f"unknown flag mode {mode!r}")


def visible(df: DataFrame) -> DataFrame:
    """Without technical (`_*`) and raw JSON (`*_json`) columns."""
    return df.select([c for c in df.columns if not c.startswith("_") and not c.endswith("_json")])


@dataclass(frozen=True)
class Facet:
    """One option list in a cascade.

    `restrict` narrows a frame to the chosen values of this facet; it may be a plain predicate or
    a semi join against another table.
    """

    column: str
    restrict: Callable[[DataFrame, Sequence], DataFrame]

    @staticmethod
    def on(column: str) -> Facet:
        return Facet(column, lambda df, values: keep(df, one_of(column, values)))


def facet_options(df: DataFrame, chain: Sequence[Facet], k: int, chosen: Sequence[Sequence | None]) -> DataFrame:
    """Option list of facet `k`, narrowed by the choices made in the facets before it."""
    for facet, values in zip(chain[:k], chosen[:k]):
        if values:
            df = facet.restrict(df, values)
    return options(df, chain[k].column)


def options(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct non-null values of one column."""
    return (
        df.filter(F.col(column).isNotNull())
        .select(F.col(column).alias("option"))
        .distinct()
        .orderBy(F.col("option").asc_nulls_last())
    )
