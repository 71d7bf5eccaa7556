"""The catalogue of published files and what is still to be fetched from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hemicycle.functions.variants import elements, field, is_object
from hemicycle.operators.filters import keep, one_of
from hemicycle.operators.joins import lacking
from hemicycle.sources.raw import object_parts

# What is fetched unless something else is asked for.
DEFAULT_LEGISLATURES = ["17"]
DEFAULT_CATEGORIES = ["iniciativas", "atividade_dos_deputados", "intervencoes"]


def name_parts(filename: Column) -> list[Column]:
    """`16_iniciativas` as legislature and category; a name without `_` is all legislature."""
    parts = F.split(filename, "_", 2)
    return [
        F.try_element_at(parts, F.lit(1)).alias("legislatura"),
        F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit("")).alias("categoria"),
    ]


def read_catalogue(spark: SparkSession, root: str, name: str = "catalogue") -> DataFrame:
    """Entries of all files `<name>.json` under a folder; many tasks read one large file."""
    files = object_parts(spark, root, name, [("rows",)])
    entry = files.select(F.explode(elements(F.col("v"), "rows")).alias("r")).filter(is_object(F.col("r")))
    entry = entry.select(field(F.col("r"), "filename").alias("filename"), field(F.col("r"), "json").alias("url"))
    return entry.select(*name_parts(F.col("filename")), "url", "filename")


def select_entries(
    catalogue: DataFrame,
    legislatures: Sequence[str] | None = DEFAULT_LEGISLATURES,
    categories: Sequence[str] | None = DEFAULT_CATEGORIES,
) -> DataFrame:
    """Entries of the chosen legislatures and categories; None or empty means all."""
    return keep(catalogue, one_of("legislatura", legislatures), one_of("categoria", categories))


def pending(wanted: DataFrame, ingested: DataFrame, force: bool = False) -> DataFrame:
    """Entries that are not in the ingestion manifest yet, or all of them when forced."""
    return wanted if force else lacking(wanted, ingested, ["filename"])
