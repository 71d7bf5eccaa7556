"""The periodic refresh as a file stream.

New raw files are picked up once each; the legislatures they belong to are normalised again and
replace their partitions. A batch that is run twice after a failure replaces the same partitions
with the same rows, so nothing is lost or doubled. The run that a partition comes from is recorded,
and files of an earlier run that land later are passed over.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hemicycle.functions.variants import parse
from hemicycle.plans.categories import CATEGORIES
from hemicycle.plans.pipeline import store_category
from hemicycle.sinks.manifest import append
from hemicycle.sources.raw import list_items, object_files, origin
from hemicycle.sources.store import exists


def landed(spark: SparkSession, landing: str) -> DataFrame:
    """A stream of raw files under `<landing>/<run>/<legislature>/<category>.json`."""
    reader = spark.readStream.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json")
    files = reader.text(landing, wholetext=True)
    return files.select(*origin(F.col("_metadata.file_path")), F.col("_metadata.file_path").alias("__path"), "value")


def newest(files: DataFrame, recorded: DataFrame | None = None) -> DataFrame:
    """One file per legislature and category: the one from the last run by name, unless a later run is recorded."""
    files = files.withColumn("__run", F.regexp_extract("__path", r"([^/]+)/[^/]+/[^/]+$", 1))
    last = files.groupBy("_legislatura", "_categoria").agg(F.max("__path").alias("__path"))
    files = files.join(last, ["_legislatura", "_categoria", "__path"], "left_semi")
    if recorded is None:
        return files
    held = recorded.groupBy("_legislatura", "_categoria").agg(F.max("__run").alias("__held"))
    files = files.join(held, ["_legislatura", "_categoria"], "left")
    return files.where("__held IS NULL OR __run >= __held").drop("__held")


def _runs(spark: SparkSession, store: str) -> DataFrame | None:
    return spark.read.parquet(f"{store}/meta/runs") if exists(spark, f"{store}/meta/runs") else None


def start_refresh(spark: SparkSession, landing: str, store: str, checkpoint: str) -> StreamingQuery:
    """Process every file that landed since the last refresh, then stop."""

    def refresh(batch: DataFrame, batch_id: int) -> None:
        files = newest(batch, _runs(batch.sparkSession, store))
        known = files.filter(F.col("_categoria").isin(*CATEGORIES))
        for name in sorted(r["_categoria"] for r in known.select("_categoria").distinct().collect()):
            category = CATEGORIES[name]
            own = known.filter(F.col("_categoria") == name)
            docs = list_items(own) if category.root == "list" else object_files(own.withColumn("v", parse(F.col("value"))))
            store_category(batch.sparkSession, category, docs, store, run=f"batch-{batch_id}")
            append(own.select("_legislatura", "_categoria", "__run"), f"{store}/meta/runs")

    stream = landed(spark, landing)
    writer = stream.writeStream.foreachBatch(refresh).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
