"""Structure of JSON documents: which paths occur, how often, how deep and with which types.

A document unfolds level by level inside one stage: each pass replaces an unopened list or object
by itself plus its children. Rows stream through the passes, so nothing is grouped per document
and no level is computed twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hemicycle.operators.ordering import first_per_group

# Type names as the profile reports them.
TYPES = ("dict", "list", "str", "int", "float", "bool", "NoneType")
LONGEST_BUCKET = 10


# What a row keeps of a value `v` whose JSON text starts with `mark`.
_DESCRIBED = {
    "type": """CASE WHEN mark = '{' THEN 'dict' WHEN mark = '[' THEN 'list' WHEN mark = '"' THEN 'str'
      WHEN mark IN ('t', 'f') THEN 'bool' WHEN mark = 'n' THEN 'NoneType'
      WHEN schema_of_variant(v) = 'BIGINT' THEN 'int' ELSE 'float' END""",
    "length": "CASE WHEN mark = '[' THEN size(try_variant_get(v, '$', 'array<variant>')) END",
    "sample": "CASE WHEN mark NOT IN ('{', '[') THEN left(try_cast(v AS string), 80) END",
    "open": "CASE WHEN mark IN ('{', '[') THEN v END",
}


# What a value's JSON text starts with; only scalars are written out to tell.
_MARK = """CASE WHEN try_variant_get({v}, '$', 'map<string,variant>') IS NOT NULL THEN '{{'
  WHEN try_variant_get({v}, '$', 'array<variant>') IS NOT NULL THEN '[' ELSE left(to_json({v}), 1) END"""


def depth_of(docs: DataFrame, column: str = "v") -> int:
    """The deepest nesting of all documents: one number, from the brackets outside of text."""
    text = F.regexp_replace(F.to_json(F.col(column)), r'"(?:[^"\\]|\\.)*+"', "")
    steps = F.split(F.regexp_replace(text, r"[^\[\]{}]", ""), "")
    zero = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def step(state: Column, mark: Column) -> Column:
        now = state["now"] + F.when(mark.isin("[", "{"), 1).when(mark.isin("]", "}"), -1).otherwise(0)
        return F.struct(now.alias("now"), F.greatest(state["most"], now).alias("most"))

    return docs.agg(F.max(F.aggregate(steps, zero, step)["most"])).first()[0] or 0


def walk(docs: DataFrame, keys: list[str], column: str = "v") -> DataFrame:
    """One row per value of each document: the keys, path, depth, type, list length and sample.

    As many levels are opened as the deepest document has, which one aggregate over the data finds.
    """
    carried = ", ".join(f"`{k}`" for k in keys)
    described = ", ".join(f"{sql} AS {name}" for name, sql in _DESCRIBED.items())
    grown = ", ".join(
        f"if(grow, {sql}, {name if name != 'open' else 'NULL'}) AS {name}" for name, sql in _DESCRIBED.items()
    )
    def level(query: str, rows: DataFrame) -> DataFrame:
        return docs.sparkSession.sql(query.replace("'{'", "'{{'"), rows=rows)

    nodes = level(
        f"""SELECT {carried}, '$' AS path, 0 AS depth, {described} FROM (
          SELECT {carried}, `{column}` AS v, {_MARK.format(v=f"`{column}`")} AS mark FROM {{rows}} WHERE `{column}` IS NOT NULL)""",
        docs,
    )
    for _ in range(depth_of(docs, column)):
        # Each unopened value stays as it is and is followed by its children.
        nodes = level(
            f"""SELECT {carried}, if(grow, path || coalesce('.' || key, '[]'), path) AS path,
              if(grow, depth + 1, depth) AS depth, {grown}
            FROM (SELECT {carried}, path, depth, type, length, sample, grow, key, c.value AS v,
                if(grow, {_MARK.format(v="c.value")}, NULL) AS mark
              FROM (SELECT *, explode(if(open IS NULL, array(false), array(false, true))) AS grow FROM {{rows}}) p,
                LATERAL variant_explode_outer(if(p.grow, p.open, NULL)) AS c
              WHERE (NOT grow OR c.value IS NOT NULL))""",
            nodes,
        )
    return nodes.drop("open")


def paths(nodes: DataFrame, *by: str) -> DataFrame:
    """Per path: occurrences, depth, one counter per type and one per list length (10 means 10 or more)."""
    counters = [F.count_if(F.col("type") == t).alias(f"type_{t}") for t in TYPES]
    bucket = F.least("length", F.lit(LONGEST_BUCKET))
    counters += [F.count_if(bucket == i).alias(f"list_len_{i}") for i in range(LONGEST_BUCKET + 1)]
    return nodes.groupBy(*by, "path").agg(F.count("*").alias("count"), F.max("depth").alias("max_depth"), *counters)


def path_samples(nodes: DataFrame, *by: str, n: int = 3) -> DataFrame:
    """The first distinct plain values of each path, in text order."""
    seen = nodes.filter("sample IS NOT NULL").select(*by, "path", "sample").distinct()
    return first_per_group(seen, [*by, "path"], [F.asc("sample")], n)


def documents(nodes: DataFrame, keys: list[str]) -> DataFrame:
    """Per document: type and length of its root, distinct paths and depth."""
    at_root = F.col("path") == "$"
    members_of_root = (F.col("depth") == 1).cast("long")
    length = F.when(F.max(F.when(at_root, F.col("type"))).isin("dict", "list"), F.sum(members_of_root))
    return nodes.groupBy(*keys).agg(
        F.max(F.when(at_root, F.col("type"))).alias("root_type"),
        length.alias("root_len"),
        F.count_distinct("path").alias("num_paths"),
        F.max("depth").alias("max_depth"),
    )


def top_fields(nodes: DataFrame, keys: list[str], n: int = 20) -> DataFrame:
    """The first fields of each root object, by name."""
    direct = nodes.filter((F.col("depth") == 1) & ~F.col("path").contains("[]"))
    names = direct.select(*keys, F.substr("path", F.lit(3)).alias("field")).distinct()
    return first_per_group(names, keys, [F.asc("field")], n)
