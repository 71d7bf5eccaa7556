"""The training-data pipeline, and the registered queries of its operators.

Each stage takes the documents that the stage before kept. All but the last return the columns of the documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hemicycle.llm import jaccard_join, mixing, quality, substring_dedup, word_bpe
from hemicycle.llm.queries import CHECKS, QUERIES, VOCABULARY
from hemicycle.llm.registry import table
from hemicycle.llm.storage import shared_folder

__all__ = ["CHECKS", "ORACLE_SQL", "QUERIES", "STAGES", "run"]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labelled ones among them."""
    return quality.accepted(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose five-word shingles are similar by 0.8 or more."""
    return jaccard_join.one_of_each(docs, jaccard_join.Similarity(words=5, percent=80))


def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without passages of 35 words that stand anywhere else; n_chars follows the text."""
    out = substring_dedup.with_kept_text(substring_dedup.remove_repeats(docs), docs.columns)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix of sources takes them."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of every document."""
    import public_tokenizers

    return word_bpe.encode(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", one_of_each),
    ("substring dedup", drop_passages),
    ("mixing sources", mix_sources),
    ("BPE encoding", encode),
]

#: A trained classifier decides the first stage, so SQL cannot give the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what a stage keeps is written to the shared folder and read by the next."""
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs


QUERIES["pipeline"] = run
