"""What the JSON text columns of a table hold, per legislature."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hemicycle.functions.numbers import percent
from hemicycle.functions.variants import canonical_items, is_blank, members, parse
from hemicycle.operators.ordering import first_per_group
from hemicycle.plans.json_explode import LEGISLATURE, json_columns


def blank_json(text: Column) -> Column:
    """True for text that does not parse and for JSON null, '', [] and {}."""
    return is_blank(parse(text))


def long_values(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Non-null values of the JSON columns in long form, for all rows."""
    names = list(columns or json_columns(df))
    return df.select(LEGISLATURE, *names).unpivot([LEGISLATURE], names, "column", "value").filter("value IS NOT NULL")


def statistics(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column and legislature: rows, nulls, values, blank ones and the share with content.

    All columns are counted in one aggregation over all rows; only its small result is reshaped.
    """
    names = list(columns or json_columns(df))
    counts = []
    for i, name in enumerate(names):
        value = F.col(name)
        counts += [F.count(value).alias(f"v{i}"), F.count_if(value.isNotNull() & blank_json(value)).alias(f"b{i}")]
    wide = df.groupBy(LEGISLATURE).agg(F.count("*").alias("total"), *counts)
    cells = [
        F.struct(F.lit(name).alias("column"), F.col(f"v{i}").alias("non_null"), F.col(f"b{i}").alias("blank"))
        for i, name in enumerate(names)
    ]
    rows = wide.select(LEGISLATURE, "total", F.explode(F.array(*cells)).alias("c"))
    return rows.select(LEGISLATURE, "total", "c.*").select(
        LEGISLATURE,
        "column",
        "total",
        (F.col("total") - F.col("non_null")).alias("nulls"),
        "non_null",
        "blank",
        (F.col("non_null") - F.col("blank")).alias("significant"),
        percent(F.col("non_null") - F.col("blank"), F.col("non_null")).alias("pct_significant"),
    )


def top_keys(values: DataFrame, k: int = 15) -> DataFrame:
    """Most frequent keys per column and legislature, over objects and the objects inside lists."""
    parsed = values.select(LEGISLATURE, "column", parse(F.col("value")).alias("v"))
    items = canonical_items(F.col("v"))
    entries = parsed.select(LEGISLATURE, "column", F.explode(items).alias("item")).select(
        LEGISLATURE, "column", F.explode(F.map_keys(members(F.col("item")))).alias("key")
    )
    counted = entries.groupBy(LEGISLATURE, "column", "key").agg(F.count("*").alias("n"))
    return first_per_group(counted, [LEGISLATURE, "column"], [F.desc("n"), F.asc("key")], k)


def samples(values: DataFrame, n: int = 2, width: int = 180) -> DataFrame:
    """The first distinct values with content, in text order, cut to a display width."""
    parsed = values.select(LEGISLATURE, "column", parse(F.col("value")).alias("v")).filter(~is_blank(F.col("v")))
    shown = parsed.select(LEGISLATURE, "column", F.left(F.to_json("v"), F.lit(width)).alias("sample")).distinct()
    return first_per_group(shown, [LEGISLATURE, "column"], [F.asc("sample")], n)


def report(df: DataFrame, keys_shown: int = 8) -> DataFrame:
    """Statistics per column and legislature with the leading keys on one line."""
    values = long_values(df)
    leading = top_keys(values, keys_shown).groupBy(LEGISLATURE, "column").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "key"))), lambda e: e["key"]), ", ").alias(
            "keys_top"
        )
    )
    return statistics(df).join(leading, [LEGISLATURE, "column"], "left")


def column_samples(df: DataFrame, n: int = 3) -> DataFrame:
    """Up to `n` distinct samples per column over all legislatures."""
    found = samples(long_values(df))
    return first_per_group(found.select("column", "sample").distinct(), ["column"], [F.asc("sample")], n)
