"""Raw JSON files laid out as `<root>/.../<legislature>/<category>.json`."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hemicycle.functions.dates import utc_now_text
from hemicycle.functions.variants import is_object, parse
from hemicycle.operators.filters import keep, one_of
from hemicycle.plans.normalise import Category
from hemicycle.sources.json_splits import cut_lists, fragments

_TAIL = r"([^/]+)/([^/]+)\.jsonl?$"


def origin(path: Column) -> list[Column]:
    """Legislature, category and short path of a raw file."""
    short = F.substring_index(path, "/", -2)  # by rows and not by files, so no regular expressions but for the rarer column
    named = short.endswith(".json") | short.endswith(".jsonl")
    return [
        F.when(named, F.substring_index(short, "/", 1)).otherwise("").alias("_legislatura"),
        F.regexp_extract(path, _TAIL, 2).alias("_categoria"),
        short.alias("_source_file"),
    ]


def read_files(spark: SparkSession, root: str, category: str = "*", lines: bool = False) -> DataFrame:
    """Documents as VARIANT: one per file, or one per line for splittable `.jsonl` files."""
    reader = spark.read.option("singleVariantColumn", "v").option("recursiveFileLookup", True)
    reader = reader.option("multiLine", not lines).option("pathGlobFilter", f"{category}.{'jsonl' if lines else 'json'}")
    return reader.json(root).select(*origin(F.col("_metadata.file_path")), "v")


def list_items(files: DataFrame) -> DataFrame:
    """Elements of files whose root is a list, each a VARIANT of its own.

    For files that are one text each, as a stream of files gives them; `list_files` reads large ones in parallel. A file
    with another root, or that is not JSON, stops the query. Elements that are not objects are passed over.
    """
    wrong = F.raise_error(F.concat(F.lit("expected a list in "), F.col("_source_file"))).cast("array<variant>")
    looks_like_list = F.startswith(F.ltrim(F.col("value")), F.lit("["))
    parsed = F.when(looks_like_list, F.from_json("value", "array<variant>"))
    items = files.select("_legislatura", "_source_file", F.explode(F.coalesce(parsed, wrong)).alias("v"))
    return items.filter(is_object(F.col("v")))


def object_files(files: DataFrame) -> DataFrame:
    """Files whose root is an object; one with another root stops the query."""
    v = F.col("v")
    wrong = F.raise_error(F.concat(F.lit("expected an object in "), F.col("_source_file"))).cast("variant")
    return files.select("_legislatura", "_source_file", F.when(is_object(v), v).otherwise(wrong).alias("v"))


def _parts(spark: SparkSession, root: str, category: str, lists: Sequence[Sequence[str]], legislatures: Sequence[str]) -> tuple[DataFrame, ...]:
    """The elements of lists of raw files, and the rest of each file, both with their origin."""
    rows = fragments(spark, root, f"{category}.json")
    rows = keep(rows.withColumn("_legislatura", F.regexp_extract("path", _TAIL, 1)), one_of("_legislatura", legislatures))
    return tuple(part.select(*origin(F.col("path")), "*") for part in cut_lists(rows.drop("_legislatura"), lists))


def _expected(what: str, kind: str) -> Column:
    return F.raise_error(F.concat(F.lit(f"expected {what} in "), F.col("_source_file"))).cast(kind)


def list_files(spark: SparkSession, root: str, category: str, legislatures: Sequence[str] = ()) -> DataFrame:
    """Elements of files whose root is a list, each a VARIANT of its own; many tasks read one large file.

    The size limit of a VARIANT holds per element. A file with another root, or that is not JSON, stops the query; one
    without content has no rows (`rejected` lists it). Elements that are not objects are passed over.
    """
    elements, rest = _parts(spark, root, category, [()], legislatures)
    parsed = F.coalesce(F.from_json(F.concat(F.lit("["), "text", F.lit("]")), "array<variant>"), _expected("a list", "array<variant>"))
    items = elements.select("_legislatura", "_source_file", F.explode(parsed).alias("v"))
    wrong = F.when(F.col("whole") & F.col("text").rlike(r"^\s*\[\s*\]\s*$"), False).otherwise(_expected("a list", "boolean"))
    bad = rest.filter(wrong).select("_legislatura", "_source_file", F.lit(None).cast("variant").alias("v"))
    return items.filter(is_object(F.col("v"))).unionByName(bad)


def object_parts(
    spark: SparkSession, root: str, category: str, lists: Sequence[Sequence[str]], legislatures: Sequence[str] = ()
) -> DataFrame:
    """Files whose root is an object as documents of their own: one for each element of the named lists, an object that
    holds that element alone, and one for what else the file holds, with `is_part` false. Many tasks read one large file.
    """
    elements, rest = _parts(spark, root, category, lists, legislatures)
    cells = F.lit(None).cast("string")
    for keys in lists:
        head = "".join(f"{{{json.dumps(k, ensure_ascii=False)}:" for k in keys)
        here = F.col("keys") == F.array(*map(F.lit, keys))
        cells = F.when(here, F.concat(F.lit(f"{head}["), "text", F.lit("]" + "}" * len(keys)))).otherwise(cells)
    parts = elements.select("_legislatura", "_source_file", F.coalesce(parse(cells), _expected("an object", "variant")).alias("v"), F.lit(True).alias("is_part"))
    whole = parse(F.when(F.col("whole"), F.col("text")))
    whole = F.when(is_object(whole), whole).otherwise(_expected("an object", "variant"))
    return parts.unionByName(rest.select("_legislatura", "_source_file", whole.alias("v"), F.lit(False).alias("is_part")))


def read_category(
    spark: SparkSession, root: str, category: Category, legislatures: Sequence[str] = (), lines: bool = False
) -> DataFrame:
    """All documents of one category; a legislature without such a file contributes none."""
    if lines:
        files = keep(read_files(spark, root, category.name, lines), one_of("_legislatura", legislatures))
        return files.filter(is_object(F.col("v"))).select("_legislatura", "_source_file", "v")
    if category.root == "list":
        return list_files(spark, root, category.name, legislatures)
    return object_parts(spark, root, category.name, category.large_lists(), legislatures)


def stage(spark: SparkSession, docs: DataFrame, path: str) -> DataFrame:
    """Documents parsed once into parquet, so that each table of a category reads splittable data.

    Without this step every table would cut and parse the files again.
    """
    docs.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def described(content: Column, text: Column) -> list[Column]:
    """Size, hash and JSON root of a content and its text; `top_level_type` is null where the text is not JSON."""
    items, names = F.json_array_length(text), F.size(F.json_object_keys(text))
    scalar = F.try_parse_json(text)
    kind = (
        F.when(items.isNotNull(), "list")
        .when(names >= 0, "dict")
        .when(scalar.isNotNull(), F.lower(F.regexp_extract(F.schema_of_variant(scalar), r"^\w+", 0)))
    )
    return [
        F.octet_length(content).cast("long").alias("bytes"),
        F.sha2(content, 256).alias("sha256"),
        kind.alias("top_level_type"),
        F.coalesce(items, F.when(names >= 0, names)).cast("long").alias("top_level_len"),
    ]


def fingerprints(spark: SparkSession, root: str, pattern: str = "*.json") -> DataFrame:
    """Size, hash and root of every raw file. A file is one row here, so one of 2 GB or more is refused by the reader."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    return files.select(
        F.regexp_extract("path", r"([^/]+)$", 1).alias("file"),
        F.regexp_extract("path", r"[^/]+/[^/]+$", 0).alias("path"),
        *described(F.col("content"), F.col("content").cast("string")),
        utc_now_text().alias("downloaded_at"),
    )


def accepted(files: DataFrame) -> DataFrame:
    """Fingerprints of the files that hold JSON."""
    return files.filter("top_level_type IS NOT NULL")


def rejected(files: DataFrame) -> DataFrame:
    return files.filter("top_level_type IS NULL")
