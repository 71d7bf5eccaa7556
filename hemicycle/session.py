"""Session settings that every plan of the package may rely on for speed, never for correctness."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesce small partitions, split skewed ones even when that costs a shuffle.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Partition values are names ('01'), not numbers.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.aggregatePushdown": "true",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Add the recommended settings to a session builder; the caller adds master and memory."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def shared_dir(spark: SparkSession) -> str | None:
    """Folder all executors see, as the cluster names it; None where no such folder is set."""
    return spark.conf.get("spark.checkpoint.dir", None)


def work_dir(spark: SparkSession) -> str:
    """A new folder all executors reach: under the one the cluster names, or local in local mode."""
    base = shared_dir(spark)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors reach")
        base = tempfile.mkdtemp(prefix="hemicycle-")
    return f"{base}/hemicycle-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder, so that several steps read them and none works them out again."""
    path = work_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
