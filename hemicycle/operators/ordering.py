"""Sort orders, top rows and the latest row per key. Nulls sort last in both directions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hemicycle.functions.numbers import try_int


def down(column: str) -> Column:
    return F.col(column).desc_nulls_last()


def up(column: str) -> Column:
    return F.col(column).asc_nulls_last()


def number_down(column: str) -> Column:
    """Descending by the number a text column holds."""
    return try_int(F.col(column)).desc_nulls_last()


def number_up(column: str) -> Column:
    return try_int(F.col(column)).asc_nulls_last()


def top(df: DataFrame, order: Sequence[Column], n: int, tie_break: Sequence[str] = ()) -> DataFrame:
    """First `n` rows in a total order: each task keeps its own `n`, one task merges them."""
    return df.orderBy(*order, *[up(c) for c in tie_break]).limit(n)


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in the given order.

    Filtering on the row number makes Spark keep one row per key in every map task before it
    shuffles, so a key with very many rows costs no more than any other.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).filter(F.col("__rank") == 1).drop("__rank")


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """First `n` rows per key with their position in `rank`."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("rank", rank).filter(F.col("rank") <= n)
