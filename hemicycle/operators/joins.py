"""Joins in the forms the queries need.

Existence tests reduce the other side to its distinct keys first. The reduction starts inside
each map task, so a key that holds a large part of that side reaches the shuffle once per task,
and the join reuses the partitioning the reduction produced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hemicycle.operators.ordering import top

Key = str | tuple[str, str]


def _pairs(on: Sequence[Key]) -> list[tuple[str, str]]:
    return [(k, k) if isinstance(k, str) else k for k in on]


def _ids(other: DataFrame, columns: Sequence[str]) -> DataFrame:
    return other.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(columns)]).distinct()


def _matching(df: DataFrame, ids: DataFrame, columns: Sequence[str], how: str) -> DataFrame:
    same = [F.col(c) == F.col(f"__k{i}") for i, c in enumerate(columns)]
    return df.join(ids, same, how)


def having(df: DataFrame, other: DataFrame, on: Sequence[Key], where: Column | None = None) -> DataFrame:
    """Rows of `df` for which `other` has a row with the same key that satisfies `where`."""
    ours, theirs = zip(*_pairs(on))
    return _matching(df, _ids(other if where is None else other.filter(where), theirs), ours, "left_semi")


def lacking(df: DataFrame, other: DataFrame, on: Sequence[Key], where: Column | None = None) -> DataFrame:
    """Rows of `df` for which `other` has no such row."""
    ours, theirs = zip(*_pairs(on))
    return _matching(df, _ids(other if where is None else other.filter(where), theirs), ours, "left_anti")


def page_ids(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], limit: int) -> DataFrame:
    """Keys of the first `limit` rows, for `among`.

    Filters and semi joins run here, on the key and order columns alone. The limit gives the
    result a proven bound, so every use of it is a broadcast, and since all uses share one plan
    Spark evaluates it once and reuses the broadcast.
    """
    return _ids(top(rows, order, limit, keys), keys)


def among(df: DataFrame, ids: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is on the page."""
    return _matching(df, ids, keys, "left_semi")


def attach(df: DataFrame, other: DataFrame, on: Sequence[str], aggregates: Sequence[Column]) -> DataFrame:
    """Left join to per-key aggregates; the aggregation happens before the join."""
    return df.join(other.groupBy(*on).agg(*aggregates), list(on), "left")
