"""JSON profile, inventory and explode over JSON text derived from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from hemicycle.driver.registry import add, add_civic
from hemicycle.driver.roles import read_source
from hemicycle.functions.variants import entry_count, parse
from hemicycle.plans import json_explode, json_inventory, json_profile
from hemicycle.plans.dynamic import long_rows

_VALID = "CASE WHEN json_valid({c}) THEN {c}::JSON END"


def _items(column: str, table: str = "registos", keys: str = "_legislatura, IdRegisto") -> str:
    """DuckDB rows of a JSON column: list items, single values, nothing for empty ones."""
    return f"""parsed AS (SELECT {keys}, {_VALID.format(c=column)} AS j FROM {table}),
    items AS (SELECT {keys}, CAST(e.key AS BIGINT) AS _json_idx, e.value AS item FROM parsed, json_each(j) e
        WHERE json_type(j) = 'ARRAY'
      UNION ALL SELECT {keys}, 0, j FROM parsed WHERE json_type(j) NOT IN ('ARRAY', 'NULL') AND CAST(j AS VARCHAR) <> '{{}}')"""


_TEXT = "CASE WHEN json_type(item->'$.{k}') NOT IN ('OBJECT', 'ARRAY', 'NULL') THEN item->>'$.{k}' END"
_NESTED = """CASE WHEN json_type(item->'$.{k}') IN ('OBJECT', 'ARRAY') AND CAST(item->'$.{k}' AS VARCHAR) NOT IN ('[]', '{{}}')
    THEN CAST(item->'$.{k}' AS VARCHAR) END"""
_VALUE = """CASE WHEN json_type(item) = 'ARRAY' AND CAST(item AS VARCHAR) <> '[]' THEN CAST(item AS VARCHAR)
    WHEN json_type(item) NOT IN ('OBJECT', 'ARRAY', 'NULL') THEN item->>'$' END"""
_WIDE = f"""_json_idx, {_NESTED.format(k='autor')} AS autor_json, {_TEXT.format(k='id')} AS id, {_TEXT.format(k='"k y"')} AS k_y,
    CAST(NULL AS VARCHAR) AS nota, {_NESTED.format(k='partes')} AS partes_json, CAST(NULL AS VARCHAR) AS vazio_json,
    {_VALUE} AS _value"""

add_civic(
    "json_explode_list",
    lambda t: json_explode.explode_column(t["registos"], "Votacao_json", ["_legislatura", "IdRegisto"]),
    f"""WITH {_items('Votacao_json')} SELECT _legislatura, IdRegisto, {_WIDE} FROM items""",
)
add_civic(
    "json_explode_object",
    lambda t: json_explode.explode_column(t["registos"], "EstadoFinal_json", ["_legislatura", "IdRegisto"]),
    """SELECT _legislatura, IdRegisto, CAST(0 AS BIGINT) AS _json_idx, EstadoFinal_json->>'$.estado' AS estado FROM registos
    WHERE EstadoFinal_json IS NOT NULL""",
)
add_civic(
    "json_explode_lenient",
    lambda t: json_explode.explode_column(t["registos"], "Votacao_json", ["IdRegisto"], strict=False).select(
        "IdRegisto", "_json_idx", "_value"
    ),
    f"""WITH {_items('Votacao_json')} SELECT IdRegisto, _json_idx, {_VALUE} AS _value FROM items
    UNION ALL SELECT IdRegisto, 0, Votacao_json FROM registos WHERE Votacao_json = 'sem conteúdo'""",
)
add(
    "json_explode_props",
    lambda spark, sf_dir: json_explode.explode_column(read_source(spark, sf_dir, "events"), "props", ["event_id"]),
    "SELECT event_id, CAST(0 AS BIGINT) AS _json_idx, props->>'$.k' AS k FROM events",
)
add_civic(
    "json_explode_long",
    lambda t: long_rows(json_explode.json_items(t["registos"], "Votacao_json", ["IdRegisto"]), ["IdRegisto", "_json_idx"]),
    f"""WITH {_items('Votacao_json', keys='IdRegisto')} SELECT IdRegisto, _json_idx, e.key,
      CASE WHEN json_type(e.value) IN ('OBJECT', 'ARRAY') THEN nullif(nullif(CAST(e.value AS VARCHAR), '[]'), '{{}}')
        WHEN json_type(e.value) <> 'NULL' THEN e.value->>'$' END AS value
    FROM (SELECT * FROM items WHERE json_type(item) = 'OBJECT'), json_each(item) e""",
)
add_civic(
    "json_satellite",
    lambda t: json_explode.satellite(
        t["registos"].withColumnRenamed("IdRegisto", "IniId"), "iniciativas", "Votacao_json", strict=True
    ).select(
        "_legislatura", "IniId", "_json_idx", F.col("id").alias("vote_id"), "_source_table", "_source_col", "_normalizer"
    ),
    f"""WITH {_items('Votacao_json')} SELECT _legislatura, IdRegisto AS IniId, _json_idx, {_TEXT.format(k='id')} AS vote_id,
      'iniciativas' AS _source_table, 'Votacao_json' AS _source_col, 'json_explode' AS _normalizer FROM items""",
)
add_civic(
    "json_second_pass",
    lambda t: json_explode.explode_column(
        json_explode.explode_column(t["registos"], "Votacao_json", ["IdRegisto"]).withColumnRenamed("_json_idx", "voto_idx"),
        "partes_json",
        ["IdRegisto", "voto_idx"],
    ),
    f"""WITH {_items('Votacao_json', keys='IdRegisto')}, partes AS (SELECT IdRegisto, _json_idx AS voto_idx, e.key, e.value AS item
      FROM (SELECT * FROM items WHERE json_type(item) = 'OBJECT'), json_each(item, '$.partes') e)
    SELECT IdRegisto, voto_idx, CAST(key AS BIGINT) AS _json_idx, CASE WHEN json_type(item) = 'OBJECT' THEN item->>'$.n' END AS n,
      CASE WHEN json_type(item) <> 'OBJECT' THEN item->>'$' END AS _value FROM partes""",
)
add_civic(
    "json_dry_run",
    lambda t: json_explode.dry_run(t["registos"], "registos", "Votacao_json"),
    f"""WITH {_items('Votacao_json')}, keyed AS (
      SELECT replace(e.key, ' ', '_') || CASE WHEN json_type(e.value) IN ('OBJECT', 'ARRAY') THEN '_json' ELSE '' END AS name
      FROM (SELECT * FROM items WHERE json_type(item) = 'OBJECT'), json_each(item) e
      UNION ALL SELECT '_value' FROM items WHERE json_type(item) <> 'OBJECT'
      UNION ALL SELECT unnest(['IdRegisto', 'IdAutor', '_json_idx']) FROM items)
    SELECT 'registos_votacao' AS satellite, 'legislatura' AS subject, _legislatura AS name, count(*) AS rows_total FROM items GROUP BY _legislatura
    UNION ALL SELECT 'registos_votacao', 'column', name, count(*) FROM keyed GROUP BY name""",
)

add_civic(
    "json_dry_run_rows",
    lambda t: json_explode.dry_run_rows(t["registos"], "registos", "EstadoFinal_json"),
    """SELECT _legislatura, IdRegisto, IdAutor, CAST(0 AS BIGINT) AS _json_idx, EstadoFinal_json->>'$.estado' AS estado
    FROM registos WHERE EstadoFinal_json IS NOT NULL ORDER BY _legislatura, IdRegisto LIMIT 3""",
)

# Inventory ----------------------------------------------------------------------------------

_BLANK = f"""(coalesce(CAST({_VALID} AS VARCHAR), 'null') IN ('""', '[]', '{{{{}}}}', 'null'))"""


def _statistics(column: str) -> str:
    significant = f"count(*) FILTER (WHERE {column} IS NOT NULL AND NOT {_BLANK.format(c=column)})"
    return f"""SELECT _legislatura, '{column}' AS "column", count(*) AS total, count(*) - count({column}) AS nulls,
      count({column}) AS non_null, count({column}) - {significant} AS blank, {significant} AS significant,
      round_even(100.0 * {significant} / greatest(count({column}), 1), 1) AS pct_significant FROM registos GROUP BY 1"""


_STATISTICS = f"{_statistics('Votacao_json')} UNION ALL {_statistics('EstadoFinal_json')}"
_KEYS = f"""WITH v AS (SELECT _legislatura, 'Votacao_json' AS "column", {_VALID.format(c='Votacao_json')} AS j FROM registos
    UNION ALL SELECT _legislatura, 'EstadoFinal_json', {_VALID.format(c='EstadoFinal_json')} FROM registos),
  objects AS (SELECT _legislatura, "column", j AS o FROM v WHERE json_type(j) = 'OBJECT'
    UNION ALL SELECT _legislatura, "column", e.value FROM (SELECT * FROM v WHERE json_type(j) = 'ARRAY'), json_each(j) e
      WHERE json_type(e.value) = 'OBJECT'),
  counted AS (SELECT _legislatura, "column", key, count(*) AS n FROM (SELECT _legislatura, "column",
      unnest(json_keys(o)) AS key FROM objects) GROUP BY ALL),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY _legislatura, "column" ORDER BY n DESC, key) AS rank FROM counted)"""
add_civic("json_inventory", lambda t: json_inventory.statistics(t["registos"]), _STATISTICS)
add_civic(
    "json_top_keys",
    lambda t: json_inventory.top_keys(json_inventory.long_values(t["registos"]), 4),
    f"""{_KEYS} SELECT _legislatura, "column", key, n, rank FROM ranked WHERE rank <= 4""",
)
add_civic(
    "json_samples",
    lambda t: json_inventory.samples(json_inventory.long_values(t["registos"]), 2),
    f"""WITH s AS (SELECT DISTINCT _legislatura, "column", left(CAST(CAST(value AS JSON) AS VARCHAR), 180) AS sample FROM (
      SELECT _legislatura, 'Votacao_json' AS "column", Votacao_json AS value FROM registos
      WHERE Votacao_json IS NOT NULL AND NOT {_BLANK.format(c='Votacao_json')}
      UNION ALL SELECT _legislatura, 'EstadoFinal_json', EstadoFinal_json FROM registos WHERE EstadoFinal_json IS NOT NULL))
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY _legislatura, "column" ORDER BY sample) AS rank FROM s)
    WHERE rank <= 2""",
)
add_civic(
    "json_inventory_report",
    lambda t: json_inventory.report(t["registos"]),
    f"""{_KEYS}, stats AS ({_STATISTICS}) SELECT stats.*, keys_top FROM stats LEFT JOIN (SELECT _legislatura, "column",
      string_agg(key, ', ' ORDER BY rank) AS keys_top FROM ranked WHERE rank <= 8 GROUP BY ALL) USING (_legislatura, "column")""",
)

# Profile ------------------------------------------------------------------------------------


def _nodes(t):
    docs = t["registos"].select("IdRegisto", parse(F.col("Votacao_json")).alias("v"))
    return json_profile.walk(docs, ["IdRegisto"])


_TREE = r"""WITH d AS (SELECT IdRegisto, CASE WHEN json_valid(Votacao_json) THEN Votacao_json::JSON END AS j FROM registos),
  n AS (SELECT IdRegisto, replace(regexp_replace(fullkey, '\[\d+\]', '[]', 'g'), '"', '') AS path,
      CASE e.type WHEN 'OBJECT' THEN 'dict' WHEN 'ARRAY' THEN 'list' WHEN 'VARCHAR' THEN 'str' WHEN 'UBIGINT' THEN 'int'
        WHEN 'BIGINT' THEN 'int' WHEN 'DOUBLE' THEN 'float' WHEN 'BOOLEAN' THEN 'bool' ELSE 'NoneType' END AS type,
      CASE WHEN e.type = 'ARRAY' THEN json_array_length(e.value) END AS length,
      CASE WHEN e.type NOT IN ('OBJECT', 'ARRAY', 'NULL') THEN left(e.value->>'$', 80) END AS sample
    FROM (SELECT * FROM d WHERE j IS NOT NULL), json_tree(j) e),
  walked AS (SELECT IdRegisto, path, type, length, sample,
      CAST(length(regexp_replace(path, '[^.\[]', '', 'g')) AS BIGINT) AS depth FROM n)"""
_TYPE_COUNTS = ", ".join(f"count(*) FILTER (WHERE type = '{t}') AS type_{t}" for t in json_profile.TYPES)
_LENGTHS = ", ".join(f"count(*) FILTER (WHERE least(length, 10) = {i}) AS list_len_{i}" for i in range(11))
add_civic(
    "json_path_profile",
    lambda t: json_profile.paths(_nodes(t)),
    f"{_TREE} SELECT path, count(*) AS count, max(depth) AS max_depth, {_TYPE_COUNTS}, {_LENGTHS} FROM walked GROUP BY 1",
)
add_civic(
    "json_path_samples",
    lambda t: json_profile.path_samples(_nodes(t)),
    f"""{_TREE} SELECT path, sample, rank FROM (SELECT path, sample, row_number() OVER (PARTITION BY path ORDER BY sample)
      AS rank FROM (SELECT DISTINCT path, sample FROM walked WHERE sample IS NOT NULL)) WHERE rank <= 3""",
)
add_civic(
    "json_document_profile",
    lambda t: json_profile.documents(_nodes(t), ["IdRegisto"]),
    f"""{_TREE} SELECT IdRegisto, max(type) FILTER (WHERE path = '$') AS root_type,
      CASE WHEN max(type) FILTER (WHERE path = '$') IN ('dict', 'list') THEN count(*) FILTER (WHERE depth = 1) END AS root_len,
      count(DISTINCT path) AS num_paths, max(depth) AS max_depth FROM walked GROUP BY 1""",
)
add_civic(
    "json_top_fields",
    lambda t: json_profile.top_fields(_nodes(t), ["IdRegisto"], 4),
    f"""{_TREE} SELECT IdRegisto, field, rank FROM (SELECT IdRegisto, field, row_number() OVER (PARTITION BY IdRegisto ORDER BY field) AS rank
      FROM (SELECT DISTINCT IdRegisto, substr(path, 3) AS field FROM walked WHERE depth = 1 AND path NOT LIKE '%[]%')) WHERE rank <= 4""",
)
add(
    "json_props_profile",
    lambda spark, sf_dir: json_profile.paths(
        json_profile.walk(
            read_source(spark, sf_dir, "events").select("event_type", parse(F.col("props")).alias("v")),
            ["event_type"],
        ),
        "event_type",
    ).select("event_type", "path", "count", "max_depth", "type_dict", "type_int"),
    """SELECT event_type, '$' AS path, count(*) AS count, CAST(0 AS BIGINT) AS max_depth, count(*) AS type_dict,
      CAST(0 AS BIGINT) AS type_int FROM events GROUP BY 1
    UNION ALL SELECT event_type, '$.k', count(*), 1, 0, count(*) FROM events GROUP BY 1""",
)
add_civic(
    "json_type_counters",
    lambda t: t["registos"].select("IdRegisto", entry_count(parse(F.col("Votacao_json"))).alias("n_Votacao")),
    f"""SELECT IdRegisto, CAST(CASE json_type(j) WHEN 'ARRAY' THEN json_array_length(j) WHEN 'OBJECT' THEN 1 ELSE 0 END AS BIGINT)
      AS n_Votacao FROM (SELECT IdRegisto, {_VALID.format(c='Votacao_json')} AS j FROM registos)""",
)
