"""Named queries over the given tables, each with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hemicycle.driver.roles import CivicTables, with_roles

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def portable(df: DataFrame) -> DataFrame:
    """Whole numbers as bigint and dates as text, so both engines print the same values."""
    whole = (T.ByteType, T.ShortType, T.IntegerType)
    dates = (T.DateType, T.TimestampType, T.TimestampNTZType)
    casts = {}
    for column in df.schema:
        if isinstance(column.dataType, whole):
            casts[column.name] = F.col(column.name).cast("bigint")
        elif isinstance(column.dataType, dates):
            casts[column.name] = F.col(column.name).cast("string")
    return df.withColumns(casts) if casts else df


def add(name: str, query: Query, check: str | None = None) -> None:
    if name in QUERIES:
        raise ValueError(f"query {name} is registered twice")
    QUERIES[name] = lambda spark, sf_dir: portable(query(spark, sf_dir))
    if check is not None:
        CHECKS[name] = with_roles(check)


def add_civic(name: str, query: Callable[[CivicTables], DataFrame], check: str | None = None) -> None:
    """Register a query over the civic tables."""
    add(name, lambda spark, sf_dir: query(CivicTables(spark, sf_dir)), check)
