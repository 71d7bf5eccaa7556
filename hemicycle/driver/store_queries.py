"""Calendar, lineage, manifests and the store, written to and read back from the shared folder."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hemicycle.driver.documents import document_sql, documents, table_check
from hemicycle.driver.registry import add, add_civic
from hemicycle.driver.roles import CivicTables
from hemicycle.operators import aggregates
from hemicycle.plans import calendar
from hemicycle.plans.categories import CATEGORIES
from hemicycle.plans.pipeline import explode_store, store_category
from hemicycle.session import work_dir
from hemicycle.sinks.export import write_csv
from hemicycle.sinks.lineage import stamp
from hemicycle.sinks.manifest import TABLE_KEY, current, upsert
from hemicycle.sinks.tables import replace_partitions, row_counts
from hemicycle.sources.store import read_table

TODAY = date(2003, 1, 15)


# Calendar -----------------------------------------------------------------------------------

_FIRST = """least((SELECT min(data_entrada) FROM iniciativas), (SELECT min(DataFase) FROM iniciativa_eventos),
    (SELECT min(DataReuniaoPlenaria) FROM intervencoes), (SELECT min(DataEnvio) FROM perguntas_e_requerimentos),
    (SELECT min(PetDataEntrada) FROM peticoes), (SELECT min(pubdt) FROM diploma_publicacao))"""
_MONTHS = "[" + ", ".join(f"'{m}'" for m in calendar.MONTHS) + "]"
_DAYS = "[" + ", ".join(f"'{d}'" for d in calendar.DAYS) + "]"
_CALENDAR = f"""cal AS (SELECT CAST(d AS VARCHAR) AS data, year(d) AS ano, quarter(d) AS trimestre, month(d) AS mes,
    ({_MONTHS})[month(d)] AS mes_nome, weekofyear(d) AS semana_iso, strftime(d, '%Y-%m') AS ano_mes,
    year(d) || '-T' || quarter(d) AS ano_trimestre, day(d) AS dia, dayofyear(d) AS dia_ano, isodow(d) AS dia_semana_iso,
    ({_DAYS})[isodow(d)] AS dia_semana_nome, isodow(d) >= 6 AS fim_de_semana
  FROM (SELECT CAST(unnest(generate_series(CAST({_FIRST} AS DATE), DATE '2003-01-15' + 365, INTERVAL 1 DAY)) AS DATE) AS d))"""


def _calendar(t: CivicTables) -> DataFrame:
    return calendar.calendar(t.spark, t, TODAY).drop("_generated_at")


add_civic("calendar_dimension", _calendar, f"WITH {_CALENDAR} SELECT * FROM cal")
add_civic("global_min_date", calendar.first_date, f"SELECT CAST(CAST({_FIRST} AS DATE) AS VARCHAR) AS first_date")
add_civic(
    "calendar_bounds",
    lambda t: aggregates.date_bounds(_calendar(t), "data"),
    f"WITH {_CALENDAR} SELECT min(data) AS min_d, max(data) AS max_d FROM cal",
)
add_civic(
    "calendar_week_rollup",
    lambda t: calendar.by_period(t["iniciativa_eventos"], "DataFase", _calendar(t), "ano", "semana_iso"),
    f"""WITH {_CALENDAR} SELECT ano, semana_iso, count(*) AS n FROM iniciativa_eventos
    JOIN cal ON data = CAST(CAST(DataFase AS DATE) AS VARCHAR) GROUP BY 1, 2""",
)
add_civic(
    "calendar_quarter_rollup",
    lambda t: calendar.by_period(t["peticoes"], "PetDataEntrada", _calendar(t), "ano_trimestre", "fim_de_semana"),
    f"""WITH {_CALENDAR} SELECT ano_trimestre, fim_de_semana, count(*) AS n FROM peticoes
    JOIN cal ON data = CAST(CAST(PetDataEntrada AS DATE) AS VARCHAR) GROUP BY 1, 2""",
)

# Lineage and manifests ----------------------------------------------------------------------


def _with_origin(df: DataFrame, category: str) -> DataFrame:
    return df.withColumn("_source_file", F.concat("_legislatura", F.lit(f"/{category}.json")))


def _hashes(t: CivicTables) -> DataFrame:
    """An ingestion manifest that lists the files of some legislatures."""
    files = _with_origin(t["iniciativas"], "iniciativas").filter("_legislatura < '1998'").select("_source_file").distinct()
    return files.select(F.col("_source_file").alias("path"), F.sha2("_source_file", 256).alias("sha256"))


add_civic(
    "lineage_columns",
    lambda t: stamp(
        _with_origin(t["iniciativas"].select("IniId", "_legislatura"), "iniciativas"), "normalise_iniciativas", _hashes(t)
    ).drop("_normalized_at"),
    """SELECT IniId, _legislatura, _legislatura || '/iniciativas.json' AS _source_file, CASE WHEN _legislatura < '1998'
      THEN sha256(_legislatura || '/iniciativas.json') END AS _source_sha256,
      'normalise_iniciativas' AS _normalizer FROM iniciativas""",
)


def _records(rows: DataFrame, table: str, run: str) -> DataFrame:
    counted = rows.groupBy(F.lit(table).alias("table"), F.col("_legislatura").alias("legislatura"))
    return counted.agg(F.count("*").alias("rows")).withColumn("generated_at", F.lit(run))


add_civic(
    "manifest_upsert",
    lambda t: upsert(
        _records(t["iniciativas"], "iniciativas", "first").unionByName(_records(t["peticoes"], "peticoes", "first")),
        _records(t["iniciativas"].filter("IniTipo = 'F' AND _legislatura > '1995'"), "iniciativas", "second"),
        TABLE_KEY,
    ),
    """WITH old AS (SELECT 'iniciativas' AS "table", _legislatura AS legislatura, count(*) AS rows, 'first' AS generated_at
      FROM iniciativas GROUP BY 2 UNION ALL SELECT 'peticoes', _legislatura, count(*), 'first' FROM peticoes GROUP BY 2),
    new AS (SELECT 'iniciativas' AS "table", _legislatura AS legislatura, count(*) AS rows, 'second' AS generated_at
      FROM iniciativas WHERE IniTipo = 'F' AND _legislatura > '1995' GROUP BY 2)
    SELECT * FROM new UNION ALL SELECT * FROM old WHERE NOT EXISTS (SELECT 1 FROM new
      WHERE new."table" = old."table" AND new.legislatura = old.legislatura)""",
)
_COUNTED = ["iniciativas", "intervencoes", "peticoes", "agenda_parlamentar", "deputados", "iniciativa_eventos"]
add_civic(
    "table_row_counts",
    lambda t: row_counts({name: t[name] for name in _COUNTED}),
    " UNION ALL ".join(f"SELECT '{name}' AS tabela, count(*) AS n FROM {name}" for name in _COUNTED),
)

# Store --------------------------------------------------------------------------------------


def _overwritten(t: CivicTables) -> DataFrame:
    """A table written whole, then again for two legislatures, one of which has no rows left."""
    path = work_dir(t.spark)
    rows = t["iniciativas"].select("IniId", "IniTipo", "_legislatura")
    replace_partitions(rows.withColumn("run", F.lit("first")), path)
    again = rows.filter("_legislatura = '1996' AND IniTipo = 'F'").withColumn("run", F.lit("second"))
    replace_partitions(again, path, ["1996", "1997"])
    return read_table(t.spark, path)


add_civic(
    "partition_overwrite",
    _overwritten,
    """SELECT IniId, IniTipo, _legislatura, 'first' AS run FROM iniciativas WHERE _legislatura NOT IN ('1996', '1997')
    UNION ALL SELECT IniId, IniTipo, _legislatura, 'second' FROM iniciativas WHERE _legislatura = '1996' AND IniTipo = 'F'""",
)


def _drifted(t: CivicTables) -> DataFrame:
    """Partitions that disagree on a type and on their columns."""
    path = work_dir(t.spark)
    rows = t["iniciativas"]
    early, late = rows.filter("_legislatura < '1996'"), rows.filter("_legislatura >= '1996'")
    replace_partitions(early.select("IniId", F.col("IniTipo"), "_legislatura"), path)
    replace_partitions(late.select(F.concat(F.lit("n"), "IniId").alias("IniId"), "IniDescTipo", "_legislatura"), path)
    return read_table(t.spark, path)


add_civic(
    "partition_type_drift",
    _drifted,
    """SELECT CAST(IniId AS VARCHAR) AS IniId, IniTipo, NULL AS IniDescTipo, _legislatura FROM iniciativas
    WHERE _legislatura < '1996' UNION ALL SELECT 'n' || IniId, NULL, IniDescTipo, _legislatura FROM iniciativas
    WHERE _legislatura >= '1996'""",
)
_ACTS = CATEGORIES["diplomas_aprovados"]
_PUBLISHED = next(t for t in _ACTS.tables if t.name == "diploma_publicacao")


def _stored_acts(spark: SparkSession, sf_dir: str) -> str:
    store = work_dir(spark)
    store_category(spark, _ACTS, documents(spark, sf_dir, document_sql(_ACTS), _ACTS.name), store)
    return store


add(
    "store_category",
    lambda spark, sf_dir: read_table(spark, f"{_stored_acts(spark, sf_dir)}/tables/diploma_publicacao").drop(
        "_source_sha256", "_normalized_at"
    ),
    f"SELECT *, 'normalise_diplomas_aprovados' AS _normalizer FROM ({table_check(_PUBLISHED, _ACTS.name)})",
)
add(
    "store_manifest",
    lambda spark, sf_dir: current(spark, f"{_stored_acts(spark, sf_dir)}/meta/tables", TABLE_KEY)
    .filter("table = 'diploma_publicacao'")
    .select("table", "legislatura", "rows", "columns", "source_file", "normalizer"),
    f"""SELECT 'diploma_publicacao' AS "table", CAST(year(o_orderdate) AS VARCHAR) AS legislatura,
      count(*) FILTER (WHERE n IS NOT NULL) AS rows, CAST(20 AS BIGINT) AS columns,
      max(CASE WHEN n IS NOT NULL THEN CAST(year(o_orderdate) AS VARCHAR) || '/diplomas_aprovados.json' END) AS source_file,
      'normalise_diplomas_aprovados' AS normalizer
    FROM orders LEFT JOIN (SELECT Id, 1 AS n FROM ({table_check(_PUBLISHED, _ACTS.name)})) ON Id = CAST(o_orderkey AS VARCHAR)
    GROUP BY 2""",
)


def _exploded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The satellite of one JSON column, written beside its table and read back."""
    store = _stored_acts(spark, sf_dir)
    for report in explode_store(spark, store, ["diplomas_aprovados"], "Anexos_json"):
        if report["status"] != "written":
            raise RuntimeError(report)
    rows = read_table(spark, f"{store}/tables/diplomas_aprovados_anexos")
    return rows.select("Id", "_json_idx", "Anexos_json", "_source_table", "_source_col", "_legislatura")


add(
    "store_explode",
    _exploded,
    """SELECT Id, CAST(0 AS BIGINT) AS _json_idx, json_extract_string(Anexos_json, '$[0].Anexos_json') AS Anexos_json,
      'diplomas_aprovados' AS _source_table, 'Anexos_json' AS _source_col, _legislatura
    FROM ({check}) WHERE Anexos_json IS NOT NULL AND Anexos_json <> '[]'""".format(
        check=table_check(_ACTS.tables[0], _ACTS.name)
    ),
)


def _csv(t: CivicTables) -> DataFrame:
    """A table written as CSV parts and read back as text."""
    path = work_dir(t.spark)
    rows = t["iniciativa_eventos_votacao"].select("IniId", "data", "resultado", "detalhe")
    write_csv(rows, path)
    back = t.spark.read.option("header", True).option("escape", '"').csv(path)
    return back.toDF(*rows.columns)


add_civic(
    "csv_export",
    _csv,
    "SELECT CAST(IniId AS VARCHAR) AS IniId, data, resultado, detalhe FROM iniciativa_eventos_votacao",
)
