"""Wide-to-long, open-ended intervals and union by name."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hemicycle.functions.dates import as_date
from hemicycle.functions.text import without_prefix
from hemicycle.operators.ordering import up


def unpivot_counters(df: DataFrame, keys: Sequence[str], prefix: str = "n_") -> DataFrame:
    """One row per counter column, named without its prefix, largest first within a key."""
    counters = [c for c in df.columns if c.startswith(prefix)]
    long = df.unpivot(list(keys), counters, "categoria", "n")
    named = long.withColumn("categoria", without_prefix(F.col("categoria"), prefix))
    return named.orderBy(*[up(k) for k in keys], F.col("n").desc_nulls_last(), "categoria")


def timeline(df: DataFrame, start: str, end: str, today: date | None = None) -> DataFrame:
    """Intervals as dates, an open end running to today, in order of their start."""
    now: Column = F.current_date() if today is None else F.lit(today)
    dated = df.withColumns(
        {start: as_date(F.col(start)), end: F.coalesce(as_date(F.col(end)), now)}
    )
    return dated.orderBy(up(start), up(end))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames matched by column name; a column a frame lacks is null there.

    A column whose types differ is widened to text first, because a plain union would narrow text
    to the numeric type and fail on the values that are not numbers.
    """
    types: dict[str, set[str]] = {}
    for frame in frames:
        for column in frame.schema:
            types.setdefault(column.name, set()).add(column.dataType.simpleString())
    mixed = {name for name, seen in types.items() if len(seen) > 1}
    aligned = [
        f.withColumns({c: F.col(c).cast("string") for c in f.columns if c in mixed}) if mixed else f
        for f in frames
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), aligned)
