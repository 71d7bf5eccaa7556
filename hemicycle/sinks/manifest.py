"""Manifests: one record per key, the last one written in force.

A manifest is an append-only table. Appending needs no read of what is there and two writers do
not undo each other; `current` gives the latest record per key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hemicycle.operators.ordering import down, latest

TABLE_KEY = ["table", "legislatura"]
FILE_KEY = ["filename"]


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """`old` with the records of `new` in place of those that have the same key, in key order.

    Nulls in a key are equal to each other and sort as ''.
    """
    named = new.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
    same = reduce(lambda a, b: a & b, [old[k].eqNullSafe(named[f"__{k}"]) for k in keys])
    kept = old.join(named, same, "left_anti")
    merged = kept.unionByName(new, allowMissingColumns=True)
    return merged.orderBy(*[F.coalesce(F.col(k), F.lit("")) for k in (order or keys)])


def append(records: DataFrame, path: str) -> None:
    records.coalesce(1).write.mode("append").parquet(path)


def current(spark: SparkSession, path: str, keys: Sequence[str], stamp: str = "generated_at") -> DataFrame:
    """The latest record per key, in key order."""
    rows = latest(spark.read.parquet(path), keys, [down(stamp)])
    return rows.orderBy(*[F.coalesce(F.col(k), F.lit("")) for k in keys])
