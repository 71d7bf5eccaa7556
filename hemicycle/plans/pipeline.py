"""From raw files to stored tables, one category at a time."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession

from hemicycle.plans.categories import CATEGORIES
from hemicycle.plans.json_explode import explode_all, explode_all_long
from hemicycle.plans.normalise import Category, normalise
from hemicycle.sinks.tables import finalise, replace_partitions
from hemicycle.sources.raw import read_category, stage
from hemicycle.sources.store import partition_paths, read_table


def store_category(
    spark: SparkSession,
    category: Category,
    docs: DataFrame,
    store: str,
    hashes: DataFrame | None = None,
    run: str = "latest",
) -> dict[str, list[str]]:
    """Write every table of a category for the legislatures its documents belong to.

    Documents are parsed once into the store's staging area. Returns the legislatures replaced
    per table.
    """
    staged = stage(spark, docs, f"{store}/staging/{category.name}/{run}")
    legislatures = sorted(r["_legislatura"] for r in staged.select("_legislatura").distinct().collect())
    done: dict[str, list[str]] = {}
    if not legislatures:
        return done
    for name, rows in normalise(category, staged).items():
        finalise(rows, store, name, f"normalise_{category.name}", legislatures, hashes)
        done[name] = legislatures
    return done


def store_raw(
    spark: SparkSession,
    raw: str,
    store: str,
    categories: Sequence[str] = tuple(CATEGORIES),
    legislatures: Sequence[str] = (),
    hashes: DataFrame | None = None,
) -> dict[str, list[str]]:
    """Normalise raw files into the store; categories and legislatures without a file are skipped."""
    done: dict[str, list[str]] = {}
    for name in categories:
        category = CATEGORIES[name]
        done |= store_category(spark, category, read_category(spark, raw, category, legislatures), store, hashes)
    return done


def explode_store(
    spark: SparkSession, store: str, tables: Sequence[str], column: str | None = None, passes: int = 2, long: bool = False
) -> Iterator[dict]:
    """Write the satellites of every JSON column of the tables, pass by pass; with `long` in the long form, for any number of keys.

    A satellite covers all legislatures of its table, so those that no longer give rows are
    emptied.
    """

    def read(table: str) -> DataFrame:
        return read_table(spark, f"{store}/tables/{table}")

    def write(name: str, rows: DataFrame) -> None:
        path = f"{store}/tables/{name}"
        before = list(partition_paths(spark, path))
        replace_partitions(rows, path, before)

    return explode_all_long(read, write, tables, passes) if long else explode_all(read, write, tables, column, passes)
