"""Raw files written from the given tables and read the way published ones are, and the rest of the store's outputs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hemicycle.driver.documents import KEY, dealt_orders, document_sql, table_check
from hemicycle.driver.json_queries import _items
from hemicycle.driver.registry import add, add_civic
from hemicycle.driver.roles import CivicTables, read_source
from hemicycle.driver.store_queries import _ACTS, _CALENDAR, _PUBLISHED, _calendar, _stored_acts
from hemicycle.plans.categories import CATEGORIES
from hemicycle.plans.dynamic import key_catalogue, wide_form
from hemicycle.plans.json_explode import long_satellite
from hemicycle.plans.normalise import normalise, rows_of
from hemicycle.plans.pipeline import explode_store
from hemicycle.session import work_dir
from hemicycle.sinks.manifest import FILE_KEY, TABLE_KEY, current, upsert
from hemicycle.sinks.raw import write_raw
from hemicycle.sinks.tables import load, replace_partitions, write_dimension
from hemicycle.sources.catalogue import read_catalogue
from hemicycle.sources.raw import described, fingerprints, read_category
from hemicycle.sources.store import read_table

# Fingerprints -------------------------------------------------------------------------------

_TEXTS = {"documents": ("doc_id", "text"), "conversations": ("conv_id", "text"), "events": ("event_id", "props")}


def _text_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = []
    for table, (key, column) in _TEXTS.items():
        text = F.col(column)
        rows = read_source(spark, sf_dir, table)
        parts.append(rows.select(F.lit(table).alias("tabela"), F.col(key).cast("long").alias("id"), *described(text.cast("binary"), text)))
    return reduce(DataFrame.unionByName, parts)


_ROOT = "CASE WHEN json_valid({c}) THEN {c}::JSON END"
add(
    "text_fingerprints",
    _text_fingerprints,
    " UNION ALL ".join(
        f"""SELECT '{table}' AS tabela, CAST({key} AS BIGINT) AS id, CAST(strlen({column}) AS BIGINT) AS bytes, sha256({column}) AS sha256,
      CASE json_type({_ROOT.format(c=column)}) WHEN 'ARRAY' THEN 'list' WHEN 'OBJECT' THEN 'dict' END AS top_level_type,
      CAST(CASE json_type({_ROOT.format(c=column)}) WHEN 'ARRAY' THEN json_array_length({column}) WHEN 'OBJECT' THEN len(json_keys({column})) END AS BIGINT) AS top_level_len
    FROM {table}"""
        for table, (key, column) in _TEXTS.items()
    ),
)

# Raw files ----------------------------------------------------------------------------------



def _raw_acts(spark: SparkSession, sf_dir: str, legislatures: tuple[str, ...] = ()) -> DataFrame:
    """List files of all legislatures, several each, of which all or some are read."""
    root = work_dir(spark)
    docs = dealt_orders(spark, sf_dir).select(F.col(KEY), F.expr("CAST(year(o_orderdate) AS STRING)").alias("_legislatura"),
                                                      F.expr(document_sql(_ACTS)).alias("item"))
    write_raw(docs, root, _ACTS.name, KEY, per_file=_PER_FILE)
    return rows_of(_PUBLISHED, read_category(spark, root, _ACTS, legislatures))


#: Items of a file here, so that the given tables make several files a legislature.
_PER_FILE = 1000
add("raw_list_files", _raw_acts, table_check(_PUBLISHED, _ACTS.name))
add(
    "raw_list_files_of_legislatures",
    lambda spark, sf_dir: _raw_acts(spark, sf_dir, ("1995", "1996")),
    f"SELECT * FROM ({table_check(_PUBLISHED, _ACTS.name)}) WHERE _legislatura IN ('1995', '1996')",
)
_BUDGET = CATEGORIES["orcamento_do_estado"]
_BUDGET_TEXTS = "ID ID_Pai Tipo Numero Titulo Texto Estado".split()


def _raw_budget(t: CivicTables) -> DataFrame:
    """Object files, each with items of a legislature in one list."""
    root = work_dir(t.spark)
    rows = t["orcamento_do_estado"].select("_legislatura", "ID", F.to_json(F.struct(*_BUDGET_TEXTS)).alias("item"))
    write_raw(rows, root, _BUDGET.name, "ID", '{"Item":[', "]}", _PER_FILE)
    found = normalise(_BUDGET, read_category(t.spark, root, _BUDGET))["orcamento_do_estado"]
    return found.select(*_BUDGET_TEXTS, "Artigos_json", "_legislatura", "_source_file")


add_civic(
    "raw_object_files",
    _raw_budget,
    f"""SELECT {", ".join(_BUDGET_TEXTS)}, NULL AS Artigos_json, _legislatura, _legislatura || '/orcamento_do_estado.json' AS _source_file
    FROM orcamento_do_estado""",
)


def _catalogue_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue files by nation, each with its entries in one list."""
    root = work_dir(spark)
    name = F.concat(F.col("c_nationkey").cast("string"), F.lit("_"), F.lower("c_mktsegment"))
    entry = F.to_json(F.struct(name.alias("filename"), F.concat(F.lit("https://example.org/"), "c_custkey").alias("json")))
    rows = read_source(spark, sf_dir, "customer").select(F.col("c_nationkey").cast("string").alias("_legislatura"), "c_custkey", entry.alias("item"))
    write_raw(rows, root, "catalogue", "c_custkey", '{"rows":[', "]}", _PER_FILE)
    return read_catalogue(spark, root)


add(
    "catalogue_scan",
    _catalogue_file,
    """SELECT CAST(c_nationkey AS VARCHAR) AS legislatura, lower(c_mktsegment) AS categoria, 'https://example.org/' || c_custkey AS url,
      c_nationkey || '_' || lower(c_mktsegment) AS filename FROM customer""",
)

_CUSTOMER = """{"id":%s,"name":"%s"}"""


def _file_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size, hash and root of list files by nation, and of files that lack their end and thus hold no JSON."""
    root = work_dir(spark)
    item = F.format_string(_CUSTOMER, F.col("c_custkey"), F.col("c_name"))
    rows = read_source(spark, sf_dir, "customer").select(F.col("c_nationkey").cast("string").alias("_legislatura"), "c_custkey", item.alias("item"))
    for category, tail in (("clientes", "]"), ("cortado", "")):
        write_raw(rows, root, category, "c_custkey", tail=tail, per_file=1 << 40)
    return fingerprints(spark, root).drop("downloaded_at")


_FILES = """SELECT c_nationkey AS n, '[' || string_agg('{"id":' || c_custkey || ',"name":"' || c_name || '"}', chr(10) || ',' ORDER BY c_custkey) AS body,
      count(*) AS items FROM customer GROUP BY c_nationkey"""
add(
    "raw_file_fingerprints",
    _file_fingerprints,
    f"""WITH f AS ({_FILES}), files AS (SELECT n, 'clientes' AS name, body || ']' || chr(10) AS body, 'list' AS kind, items FROM f
      UNION ALL SELECT n, 'cortado', body || chr(10), NULL, NULL FROM f)
    SELECT name || '.json' AS file, n || '/' || name || '.json' AS path, CAST(strlen(body) AS BIGINT) AS bytes, sha256(body) AS sha256,
      kind AS top_level_type, CAST(items AS BIGINT) AS top_level_len FROM files""",
)

# Store --------------------------------------------------------------------------------------


def _file_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An ingestion manifest in which the files of one segment were fetched again."""
    files = read_source(spark, sf_dir, "customer").select(F.col("c_name").alias("filename"), "c_mktsegment")
    first = files.select("filename", F.lit("first").alias("generated_at"))
    again = files.where("c_mktsegment = 'BUILDING'").select("filename", F.lit("second").alias("generated_at"))
    return upsert(first, again, FILE_KEY)


add(
    "manifest_upsert_files",
    _file_records,
    "SELECT c_name AS filename, CASE WHEN c_mktsegment = 'BUILDING' THEN 'second' ELSE 'first' END AS generated_at FROM customer",
)


def _dimension(t: CivicTables) -> str:
    store = work_dir(t.spark)
    write_dimension(_calendar(t), store, "dim_calendario", "dim_calendario")
    return store


add_civic("dimension_write", lambda t: read_table(t.spark, f"{_dimension(t)}/tables/dim_calendario"), f"WITH {_CALENDAR} SELECT * FROM cal")
add_civic(
    "dimension_manifest",
    lambda t: current(t.spark, f"{_dimension(t)}/meta/tables", TABLE_KEY).select("table", "legislatura", "rows", "columns", "normalizer"),
    f"""WITH {_CALENDAR} SELECT 'dim_calendario' AS "table", CAST(NULL AS VARCHAR) AS legislatura, count(*) AS rows,
      CAST(13 AS BIGINT) AS columns, 'dim_calendario' AS normalizer FROM cal""",
)


def _managed(spark: SparkSession, sf_dir: str) -> DataFrame:
    load(spark, f"{_stored_acts(spark, sf_dir)}", ["diploma_publicacao"], as_tables=True)
    return spark.table("diploma_publicacao").drop("_source_sha256", "_normalized_at")


add("managed_table", _managed, f"SELECT *, 'normalise_diplomas_aprovados' AS _normalizer FROM ({table_check(_PUBLISHED, _ACTS.name)})")


def _exploded_twice(t: CivicTables) -> DataFrame:
    """All JSON columns of a table, then all of the satellites just written; the rows of one of the second pass."""
    store = work_dir(t.spark)
    replace_partitions(t["registos"], f"{store}/tables/registos")
    reports = list(explode_store(t.spark, store, ["registos"]))
    failed = [r for r in reports if r["status"] != "written"]
    if failed or len(reports) < 4:
        raise RuntimeError(failed or reports)
    rows = read_table(t.spark, f"{store}/tables/registos_votacao_partes")
    return rows.select("IdRegisto", "_json_idx", "n", "_value", "_source_table", "_source_col", "_legislatura")


add_civic(
    "store_explode_two_passes",
    _exploded_twice,
    f"""WITH {_items('Votacao_json')}, partes AS (SELECT IdRegisto, _legislatura, e.key, e.value AS item
      FROM (SELECT * FROM items WHERE json_type(item) = 'OBJECT'), json_each(item, '$.partes') e)
    SELECT IdRegisto, CAST(key AS BIGINT) AS _json_idx, CASE WHEN json_type(item) = 'OBJECT' THEN item->>'$.n' END AS n,
      CASE WHEN json_type(item) <> 'OBJECT' THEN item->>'$' END AS _value, 'registos_votacao' AS _source_table,
      'partes_json' AS _source_col, _legislatura FROM partes""",
)


def _exploded_long(t: CivicTables) -> DataFrame:
    """The same rows from satellites stored in the long form: named columns of the nested items of one column."""
    store = work_dir(t.spark)
    replace_partitions(t["registos"], f"{store}/tables/registos")
    list(explode_store(t.spark, store, ["registos"], long=True))
    rows = read_table(t.spark, f"{store}/tables/registos_votacao_nested").filter("in_key = 'partes'")
    kept = ["IdRegisto", "_legislatura", "in_idx", "_json_idx"]
    found = wide_form(rows, kept, ["n"], plain="_value")
    return found.select("IdRegisto", "_json_idx", "n", "_value", "_legislatura")


add_civic(
    "store_explode_long",
    _exploded_long,
    f"""WITH {_items('Votacao_json')}, partes AS (SELECT IdRegisto, _legislatura, e.key, e.value AS item
      FROM (SELECT * FROM items WHERE json_type(item) = 'OBJECT'), json_each(item, '$.partes') e)
    SELECT IdRegisto, CAST(key AS BIGINT) AS _json_idx, CASE WHEN json_type(item) = 'OBJECT' THEN item->>'$.n' END AS n,
      CASE WHEN json_type(item) <> 'OBJECT' THEN item->>'$' END AS _value, _legislatura FROM partes""",
)


def _long_keys(t: CivicTables) -> DataFrame:
    """How often each key stands in the items of a JSON column, from its long form."""
    return key_catalogue(long_satellite(t["registos"], "registos", "Votacao_json")).select("name", "key", "nested", "n")


add_civic(
    "satellite_key_catalogue",
    _long_keys,
    f"""WITH {_items('Votacao_json')}, e AS (SELECT e.key, e.value FROM (SELECT * FROM items WHERE json_type(item) = 'OBJECT'), json_each(item) e),
    k AS (SELECT key, json_type(value) IN ('OBJECT', 'ARRAY') AS nested, value FROM e
      WHERE json_type(value) <> 'NULL' AND NOT (json_type(value) IN ('OBJECT', 'ARRAY') AND CAST(value AS VARCHAR) IN ('{{}}', '[]')))
    SELECT regexp_replace(key, '[^a-zA-Z0-9_]', '_', 'g') || CASE WHEN nested THEN '_json' ELSE '' END AS name, key, nested, count(*) AS n
    FROM k GROUP BY ALL""",
)
