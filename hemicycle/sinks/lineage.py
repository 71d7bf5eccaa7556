"""Technical columns that say where a row came from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hemicycle.functions.dates import utc_now_text


def stamp(df: DataFrame, normalizer: str, hashes: DataFrame | None = None) -> DataFrame:
    """Add `_source_sha256`, `_normalizer` and `_normalized_at` to rows that carry their origin.

    `hashes` is the ingestion manifest (`path`, `sha256`); a source it does not list gets null.
    """
    if hashes is None:
        found = df.withColumn("_source_sha256", F.lit(None).cast("string"))
    else:
        known = hashes.groupBy(F.col("path").alias("_source_file")).agg(F.max("sha256").alias("_source_sha256"))
        found = df.join(known, "_source_file", "left")
    named = found.withColumns({"_normalizer": F.lit(normalizer), "_normalized_at": utc_now_text()})
    technical = ["_legislatura", "_source_file", "_source_sha256", "_normalizer", "_normalized_at"]
    return named.select(*[c for c in named.columns if c not in technical], *technical)


def stamp_satellite(df: DataFrame, table: str, column: str, normalizer: str = "json_explode") -> DataFrame:
    """Lineage of an exploded column: the table and column it was read from."""
    cells: dict[str, Column] = {
        "_source_table": F.lit(table),
        "_source_col": F.lit(column),
        "_normalizer": F.lit(normalizer),
        "_normalized_at": utc_now_text(),
    }
    return df.withColumns(cells)
