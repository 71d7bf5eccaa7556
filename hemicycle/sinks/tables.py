"""Writing tables: partition replacement, the dimension, catalogue registration and row counts."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hemicycle.functions.dates import utc_now_text
from hemicycle.sinks.lineage import stamp
from hemicycle.sinks.manifest import append
from hemicycle.sources.store import PARTITION, partition_files, read_table, record_schemas


def replace_partitions(df: DataFrame, path: str, legislatures: Sequence[str] = ()) -> set[str]:
    """Write a table, replacing only the partitions of the legislatures at hand.

    Rows are rebalanced on the partition column: small partitions become one file each and a
    partition holding much of the data is split over many tasks. A legislature named in
    `legislatures` that has no rows is left as an empty partition instead of its old content;
    these are returned. A rewritten partition has none of its old files, which is how the others
    are told apart without computing the rows a second time.
    """
    spark = df.sparkSession
    directories = {value: f"{path}/{PARTITION}={value}" for value in legislatures}
    before = partition_files(spark, path)
    (
        df.hint("rebalance", PARTITION)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(PARTITION)
        .parquet(path)
    )
    emptied = set()
    after = partition_files(spark, path)
    for value, where in directories.items():
        if not after[value] - before[value]:
            empty = df.drop(PARTITION).filter(F.lit(False))
            empty.coalesce(1).write.mode("overwrite").parquet(where)
            emptied.add(value)
    changed = emptied | {value for value, files in after.items() if files - before[value]}
    record_schemas(spark, path, df.schema, changed)
    return emptied


def finalise(
    df: DataFrame,
    store: str,
    table: str,
    normalizer: str,
    legislatures: Sequence[str],
    hashes: DataFrame | None = None,
) -> DataFrame:
    """Lineage, partition replacement and one manifest record per legislature, with all its source files; returns the records."""
    spark = df.sparkSession
    path = f"{store}/tables/{table}"
    stamped = stamp(df, normalizer, hashes)
    replace_partitions(stamped, path, legislatures)
    own = f"_source_file string, _source_sha256 string, {PARTITION} string"
    written = spark.read.schema(own).parquet(path).filter(F.col(PARTITION).isin(list(legislatures)))
    every = lambda c: F.when(F.count(c) > 0, F.array_join(F.array_sort(F.collect_set(c)), ",")).alias(c.removeprefix("_"))
    counted = written.groupBy(PARTITION).agg(F.count("*").alias("rows"), every("_source_file"), every("_source_sha256"))
    values = F.array(*[F.lit(v) for v in legislatures]).cast("array<string>")
    wanted = spark.range(1).select(F.explode(values).alias(PARTITION))
    records = wanted.join(counted, PARTITION, "left").select(
        F.lit(table).alias("table"),
        F.col(PARTITION).alias("legislatura"),
        F.concat(F.lit(f"{table}/{PARTITION}="), PARTITION).alias("path"),
        F.coalesce("rows", F.lit(0)).cast("long").alias("rows"),
        F.lit(len(stamped.columns)).alias("columns"),
        "source_file",
        "source_sha256",
        F.lit(normalizer).alias("normalizer"),
        utc_now_text().alias("generated_at"),
    )
    append(records, f"{store}/meta/tables")
    return records


def write_dimension(df: DataFrame, store: str, table: str, normalizer: str) -> DataFrame:
    """An unpartitioned table, replaced whole, with a manifest record that names no legislature."""
    spark = df.sparkSession
    path = f"{store}/tables/{table}"
    df.coalesce(1).write.mode("overwrite").parquet(path)
    records = spark.read.parquet(path).agg(F.count("*").alias("rows")).select(
        F.lit(table).alias("table"),
        F.lit(None).cast("string").alias("legislatura"),
        F.lit(table).alias("path"),
        "rows",
        F.lit(len(df.columns)).alias("columns"),
        F.lit(None).cast("string").alias("source_file"),
        F.lit(None).cast("string").alias("source_sha256"),
        F.lit(normalizer).alias("normalizer"),
        utc_now_text().alias("generated_at"),
    )
    append(records, f"{store}/meta/tables")
    return records


def load(spark: SparkSession, store: str, tables: Iterable[str], as_tables: bool = False) -> dict[str, DataFrame]:
    """Make stored tables available to SQL: as views over their files, or as managed copies."""
    frames = {}
    for name in tables:
        frame = read_table(spark, f"{store}/tables/{name}")
        if as_tables:
            frame.write.mode("overwrite").saveAsTable(name)
        else:
            frame.createOrReplaceTempView(name)
        frames[name] = frame
    return frames


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table, by name."""
    counts = [f.agg(F.count("*").alias("n")).select(F.lit(name).alias("tabela"), "n") for name, f in frames.items()]
    return reduce(DataFrame.unionByName, counts).orderBy("tabela")
