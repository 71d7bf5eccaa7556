"""Aggregates. All of them combine inside map tasks before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hemicycle.functions.dates import as_date, month_of
from hemicycle.functions.numbers import share


def ordered_text_list(expression: str, separator: str = ", ") -> Column:
    """Distinct non-null values of a group joined in ascending order; null for a group without any.

    `expression` is SQL, evaluated per row. Each map task sends the distinct values of a key once,
    so a key with very many rows is no larger in the shuffle than its list of values.
    """
    values = F.collect_set(F.expr(expression))
    return F.when(F.size(values) > 0, F.array_join(F.array_sort(values), separator))


def text_lists(df: DataFrame, keys: Sequence[str], expression: str, name: str, separator: str = ", ") -> DataFrame:
    """`ordered_text_list` per key for keys with very many values: only the finished text of a key is one row.

    Distinct (key, value) pairs are dealt by range, so a hot key's values lie in several partitions, in order. Each
    partition joins its part of the list, and a key's parts are joined in order of their first values.
    """
    pairs = df.select(*keys, F.expr(expression).cast("string").alias("value")).distinct()
    order = [F.col(k).asc_nulls_last() for k in keys] + [F.col("value").asc_nulls_last()]
    dealt = pairs.repartitionByRange(*order).withColumn("segment", F.spark_partition_id())
    values = F.array_sort(F.collect_list("value"))  # of one partition; nulls are left out
    parts = dealt.groupBy(*keys, "segment").agg(F.array_join(values, separator).alias("text"), F.count("value").alias("n"))
    parts = parts.groupBy(*keys).agg(F.array_sort(F.collect_list(F.when(F.col("n") > 0, F.struct("segment", "text")))).alias("parts"))
    text = F.array_join(F.transform("parts", lambda p: p["text"]), separator)
    return parts.select(*keys, F.when(F.size("parts") > 0, text).alias(name))


SUMMARY_ID = "_levels"


def summary_levels(df: DataFrame, columns: Sequence[str], levels: Sequence[Sequence[str]], aggregates: Sequence[Column]) -> DataFrame:
    """Aggregates at several levels from one scan: each level groups by some of the columns, the others are null.

    `_levels` tells levels apart from nulls in the data: bit i, from the last column on, is set where column i is not grouped by.
    """
    sets = [[F.col(c) for c in level] for level in levels]
    grouped = df.groupingSets(sets, *[F.col(c) for c in columns])
    return grouped.agg(F.grouping_id().alias(SUMMARY_ID), *aggregates)


def distinct_levels(
    df: DataFrame, columns: Sequence[str], levels: Sequence[Sequence[str]], counted: str, n: str = "n", distinct: str = "n_distinct"
) -> DataFrame:
    """`summary_levels` with two aggregates, the rows and the distinct non-null values of a column.

    Rows are shuffled without their levels: equal rows become one with a count, and all that have one value go to one
    task. That task knows the groups of the value at every level, so what is shuffled after it are groups alone.
    """
    known = df.select(F.col(counted).alias("__value"), *columns).groupBy("__value", *columns).agg(F.count("*").alias("__rows"))
    known = known.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "__value")
    cells = []
    for at, level in enumerate(levels):
        left_out = sum(1 << i for i, c in enumerate(reversed(columns)) if c not in level)
        own = [(F.col(c) if c in level else F.lit(None).cast(df.schema[c].dataType)).alias(c) for c in columns]
        cells.append(F.struct(F.lit(at).alias("__level"), *own, F.lit(left_out).cast("long").alias(SUMMARY_ID)))
    group = ["__level", *columns, SUMMARY_ID]
    rows = known.select("__value", "__rows", F.explode(F.array(*cells)).alias("__cell")).select("__value", "__rows", "__cell.*")
    rows = rows.groupBy("__value", *group).agg(F.sum("__rows").alias("__rows"))
    rows = rows.groupBy(*group).agg(F.sum("__rows").alias(n), F.count("__value").alias(distinct))
    return rows.drop("__level")


def rollup_levels(columns: Sequence[str]) -> list[list[str]]:
    """All columns, then without the last one, and so on to the grand total."""
    return [list(columns[:n]) for n in range(len(columns), -1, -1)]


def cube_levels(columns: Sequence[str]) -> list[list[str]]:
    """Every choice of columns."""
    return [[c for i, c in enumerate(columns) if choice >> i & 1] for choice in range(1 << len(columns))]


def count_by(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    """Rows per non-null value, most frequent first."""
    rows = df.filter(F.col(column).isNotNull())
    return rows.groupBy(column).agg(F.count("*").alias(name)).orderBy(F.desc(name), F.asc_nulls_last(column))


def distinct_by(df: DataFrame, group: str, counted: str, name: str = "n") -> DataFrame:
    """Distinct values per group, largest first; a null group stays a group."""
    return (
        df.groupBy(group)
        .agg(F.count_distinct(F.col(counted)).alias(name))
        .orderBy(F.desc(name), F.asc_nulls_last(group))
    )


def outcome_rates(df: DataFrame, outcomes: dict[str, Column]) -> DataFrame:
    """One row: the size of the frame and, per named condition, its count and share."""
    cells = [F.count("*").alias("n")]
    for name, condition in outcomes.items():
        hits = F.count_if(condition)
        cells += [hits.alias(f"n_{name}"), share(hits, F.count("*")).alias(f"share_{name}")]
    return df.agg(*cells)


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: the size of the frame and the number of distinct non-null values per column."""
    return df.agg(F.count("*").alias("n"), *[F.count_distinct(F.col(c)).alias(f"distinct_{c}") for c in columns])


def sum_and_median(df: DataFrame, column: str) -> DataFrame:
    """One row with the sum and the exact median, cut to a whole number, of an integer column; nulls left out.

    One aggregate counts the values. The counts are summed by the upper 16 bits of the value, so the
    window that finds the middle sees at most 65,536 rows, and only the one or two ranges that hold
    the middle are ranked value by value.
    """
    counted = df.select(F.col(column).cast("int").alias("x")).dropna().groupBy(F.shiftright("x", 16).alias("b"), "x")
    counted = counted.agg(F.count("*").alias("c"))
    ranges = counted.groupBy("b").agg(F.sum("c").alias("c"), F.sum(F.col("x").cast("long") * F.col("c")).alias("s"))
    running = ranges.select(
        "b",
        "c",
        "s",
        F.sum("c").over(Window.orderBy("b")).alias("upto"),
        F.sum("c").over(Window.partitionBy()).alias("total"),
    )
    low, high = F.floor((F.col("total") + 1) / 2), F.floor((F.col("total") + 2) / 2)
    before = F.col("upto") - F.col("c")
    middle = running.filter((low > before) & (low <= F.col("upto")) | (high > before) & (high <= F.col("upto")))
    middle = middle.select("b", before.alias("before"), low.alias("low"), high.alias("high"))
    rank = F.col("before") + F.sum("c").over(Window.partitionBy("b").orderBy("x"))
    ranked = counted.join(middle, "b").withColumn("rank", rank)
    cells = [F.when(F.col("rank") >= F.col(r), F.col("x")).alias(r) for r in ("low", "high")]
    parts = ranges.select(F.col("s"), F.lit(None).cast("int").alias("low"), F.lit(None).cast("int").alias("high"))
    parts = parts.unionByName(ranked.select(F.lit(None).cast("long").alias("s"), *cells))
    half = (F.min("low").cast("double") + F.min("high")) / 2
    return parts.agg(F.coalesce(F.sum("s"), F.lit(0)).alias("total"), half.cast("long").alias("median"))


def monthly(df: DataFrame, column: str, *by: str) -> DataFrame:
    """Rows per month, and per category where one is named. Null months and categories are left out."""
    return _series(df, month_of(F.col(column)).alias("mes"), "mes", by)


def daily(df: DataFrame, column: str, *by: str) -> DataFrame:
    """Rows per day, and per category where one is named. Null days and categories are left out."""
    return _series(df, as_date(F.col(column)).alias("dia"), "dia", by)


def _series(df: DataFrame, bucket: Column, name: str, by: Sequence[str]) -> DataFrame:
    rows = df.select(bucket, *by).dropna("any")
    return rows.groupBy(name, *by).agg(F.count("*").alias("n")).orderBy(name, *by)


def date_bounds(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("min_d"), F.max(column).alias("max_d"))
