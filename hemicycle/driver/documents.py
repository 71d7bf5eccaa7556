"""Raw documents derived from the orders, one per order, in the shapes of the source files.

The value of every field is a SQL expression over the order, and over the item number `i` (and
`j` one level down) inside a list. Spark evaluates the expressions into JSON text; the check
evaluates the same expressions in DuckDB and so knows what each table must hold.

Lists vary by order: missing, an object in place of a list, empty, and up to three items, in some
orders after a null and a plain value that belong to no row but count in the numbering.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hemicycle.driver.roles import read_source
from hemicycle.functions.variants import parse
from hemicycle.plans.normalise import Category, Field, Table

KEY = "o_orderkey"
TERM = "CAST(year(o_orderdate) AS STRING)"
_NO_LIST = f"{KEY} % 11 = 0"
_OBJECT_LIST = f"{KEY} % 13 = 0"
_JUNK = f"CASE WHEN {KEY} % 7 = 0 THEN 2 ELSE 0 END"
_SIZES = (f"({KEY} % 4)", f"(({KEY} + i) % 3)")
_SOURCES = ("o_orderpriority", "o_orderstatus", "CAST(o_custkey AS STRING)")


def _where(level: int) -> str:
    return {0: "0", 1: "i", 2: "(i * 10 + j)"}[level]


def text_value(name: str, level: int) -> str:
    """SQL text of a plain field: unlike its neighbours, null for some rows."""
    seed = sum(map(ord, name))
    value = f"{_SOURCES[seed % 3]} || ' {name} ' || CAST({KEY} + {_where(level)} AS STRING)"
    return f"CASE WHEN ({KEY} + {_where(level)} + {seed}) % 9 = 0 THEN NULL ELSE {value} END"


def date_text(name: str, level: int, day_first: bool) -> str:
    """SQL text of a date field, with impossible, empty and missing dates among them."""
    seed = sum(map(ord, name))
    iso = f"CAST(CAST(o_orderdate AS DATE) + CAST({_where(level)} + {seed % 5} AS INT) AS STRING)"
    turned = f"substr({iso}, 9, 2) || '/' || substr({iso}, 6, 2) || '/' || substr({iso}, 1, 4)"
    shown = f"CASE WHEN {KEY} % 3 = 0 THEN {iso} ELSE {turned} END" if day_first else iso
    return (
        f"CASE WHEN ({KEY} + {seed}) % 17 = 0 THEN '2024-02-30' WHEN ({KEY} + {seed}) % 19 = 0 THEN '' "
        f"WHEN ({KEY} + {seed}) % 23 = 0 THEN NULL ELSE {shown} END"
    )


def nested_json(name: str, level: int) -> str:
    """SQL text of a nested value: a list with one object, an empty list, or null."""
    seed = sum(map(ord, name))
    value = f"""'[{{"{name}":"' || o_orderpriority || CAST({KEY} + {_where(level)} AS STRING) || '"}}]'"""
    return f"CASE WHEN ({KEY} + {seed}) % 8 = 0 THEN 'null' WHEN ({KEY} + {seed}) % 10 = 0 THEN '[]' ELSE {value} END"


def _quoted(sql: str) -> str:
    return f"""coalesce('"' || {sql} || '"', 'null')"""


def field_json(f: Field, level: int) -> str:
    """SQL text of the JSON a field holds in the document."""
    if f.kind == "json":
        return nested_json(f.name, level)
    if f.kind in ("date", "day_first"):
        return _quoted(date_text(f.name, level, f.kind == "day_first"))
    if f.kind == "flag":
        return f"CASE WHEN {KEY} % 5 = 0 THEN 'null' WHEN {KEY} % 2 = 0 THEN 'true' ELSE 'false' END"
    return _quoted(f"({_plain(f, level)})")


def _plain(f: Field, level: int) -> str:
    return f"CAST({KEY} AS STRING)" if level == 0 and f.path == (KEY_FIELDS.get(f.name),) else text_value(f.name, level)


# Fields that identify a document hold the order key itself.
KEY_FIELDS = {"IniId": "IniId", "PetId": "PetId", "Id": "Id"}


def field_check(f: Field, level: int, siblings: tuple[Field, ...] = ()) -> str:
    """SQL (DuckDB) of what a field must hold in the table."""
    if f.kind == "json":
        parts = [o for o in siblings if len(o.path) > len(f.path) and o.path[: len(f.path)] == f.path]
        if parts:
            return tree([(o.path[len(f.path) :], field_json(o, level)) for o in parts])
        found = nested_json(f.name, level)
        return f"nullif({found}, 'null')"
    if f.kind == "date":
        return f"CAST(TRY_CAST({date_text(f.name, level, False)} AS TIMESTAMP) AS VARCHAR)"
    if f.kind == "day_first":
        found = date_text(f.name, level, True)
        return f"CAST(coalesce(TRY_CAST({found} AS TIMESTAMP), try_strptime({found}, '%d/%m/%Y')) AS VARCHAR)"
    if f.kind == "flag":
        return f"CASE WHEN {KEY} % 5 = 0 THEN NULL ELSE {KEY} % 2 = 0 END"
    return _plain(f, level)


def _object(members: dict[str, str]) -> str:
    """SQL text of a JSON object from the SQL of its members."""
    return " || ',' || ".join(f"""'"{k}":' || ({v})""" for k, v in members.items()).join(("'{' || ", " || '}'"))


def tree(fields: list[tuple[tuple, str]]) -> str:
    """SQL text of a JSON value from (path, SQL) pairs; a step 0 is the first item of a list."""
    if len(fields) == 1 and fields[0][0] == ():
        return fields[0][1]
    heads: dict = {}
    for path, sql in fields:
        heads.setdefault(path[0], []).append((path[1:], sql))
    # A value that is also opened further down is spelled out by its parts.
    heads = {head: [r for r in rest if r[0]] or rest for head, rest in heads.items()}
    parts = {head: tree(rest) for head, rest in heads.items()}
    if list(parts) == [0]:
        return f"'[' || ({parts[0]}) || ']'"
    return _object(dict(sorted(parts.items())))


def list_json(items: str, level: int) -> str:
    """SQL (Spark) text of a list from the SQL of one item."""
    var = "ij"[level - 1]
    size = _SIZES[level - 1]
    numbers = f"slice(array(0, 1, 2), 1, CAST({size} AS INT))"
    junk = f"CASE WHEN {_JUNK} = 2 THEN array('null', '\"solto\"') ELSE CAST(array() AS ARRAY<STRING>) END"
    filled = f"'[' || array_join(concat({junk}, transform({numbers}, {var} -> {items})), ',') || ']'"
    if level > 1:
        return filled
    return f"CASE WHEN {_NO_LIST} THEN 'null' WHEN {_OBJECT_LIST} THEN '{{\"a\":1}}' ELSE {filled} END"


def _item(category: Category, lists: tuple, level: int) -> str:
    """SQL text of one item of a list: its own fields and the lists below it."""
    fields: dict[tuple, str] = {}
    deeper = []
    for table in category.tables:
        if table.lists == lists:
            if table.scalars:
                return _quoted(f"({text_value(table.columns[0].name, level)})")
            for f in table.columns:
                if f.compute is None:
                    fields.setdefault(f.path, field_json(f, level))
        elif table.lists[: len(lists)] == lists and len(table.lists) > len(lists):
            deeper.append(table.lists[: len(lists) + 1])
    for below in dict.fromkeys(deeper):
        fields[below[-1]] = list_json(_item(category, below, level + 1), level + 1)
    return tree(list(fields.items()))


def document_sql(category: Category, extra: dict[tuple, str] | None = None, only: str | None = None) -> str:
    """SQL (Spark) text of a document; `extra` adds fields the declared tables compute.

    With `only` the document holds the fields one table reads and lacks all others.
    """
    fields = {path: sql for path, sql in (extra or {}).items()}
    tables = tuple(t for t in category.tables if only is None or t.name == only)
    category = replace(category, tables=tables)
    for table in category.tables:
        for f in (*table.keys, *(() if table.lists else table.columns)):
            if f.compute is None and f.path not in fields:
                fields[f.path] = field_json(f, 0)
    for table in category.tables:
        if table.lists and table.lists[0] not in fields:
            fields[table.lists[0]] = list_json(_item(category, table.lists[:1], 1), 1)
    return tree(list(fields.items()))


def dealt_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders, dealt by key before documents are built from them, as the table may be a single range for its reader.

    The number of parts is named, so that adaptive execution keeps it: a row is small beside the document made of it.
    """
    return read_source(spark, sf_dir, "orders").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), KEY)


def documents(spark: SparkSession, sf_dir: str, sql: str, category: str) -> DataFrame:
    """Documents as the engine reads them: origin columns and the VARIANT `v`.

    A document is the one value of a generator, as filters on values in it would otherwise move below and build it again
    where the table is read. Its text is a column of its own below the generator, which evaluates what it is given tree by
    tree: a projection is compiled, and builds text that stands in it several times once. The lambda over the one term
    keeps that projection out of whole-stage code, whose single method for all fields is too long for the JVM to compile.
    """
    term = F.transform(F.array(F.expr(TERM)), lambda t: t)[0]
    texts = dealt_orders(spark, sf_dir).select(
        term.alias("_legislatura"),
        F.expr(sql).alias("text"),
    )
    file = F.concat("_legislatura", F.lit(f"/{category}.json")).alias("_source_file")
    return texts.select("_legislatura", file, F.explode(F.array(parse(F.col("text")))).alias("v"))


def table_check(table: Table, category: str, computed: dict[str, str] | None = None) -> str:
    """SQL (DuckDB) of the rows a declared table must hold."""
    level = len(table.lists)
    cells = [f"{field_check(k, 0)} AS {k.name}" for k in table.keys]
    if table.ordinals:
        numbering = [f"i + {_JUNK}", f"j + {_JUNK}"][:level]
        cells += [f"CAST({sql} AS BIGINT) AS {name}" for sql, name in zip(numbering, table.ordinals)]
    for f in table.columns:
        if f.compute is not None:
            cells.append(f"{(computed or {})[f.name]} AS {f.name}")
        elif table.scalars:
            cells.append(f"{text_value(f.name, level)} AS {f.name}")
        else:
            cells.append(f"{field_check(f, level, table.columns)} AS {f.name}")
    cells += [f"{TERM} AS _legislatura", f"{TERM} || '/{category}.json' AS _source_file"]
    source = "orders"
    for depth in range(level):
        source += f", LATERAL (SELECT unnest(range(CAST({_SIZES[depth]} AS BIGINT))) AS {'ij'[depth]})"
    where = f" WHERE NOT ({_NO_LIST}) AND NOT ({_OBJECT_LIST})" if level else ""
    if table.scalars:
        # The plain value in front of some lists is a row here; nulls are not.
        value = text_value(table.columns[0].name, level)
        rows = f"SELECT {', '.join(cells)} FROM {source}{where} AND ({value}) IS NOT NULL"
        keys = [f"{field_check(k, 0)} AS {k.name}" for k in table.keys]
        loose = [*keys, f"'solto' AS {table.columns[0].name}", *cells[-2:]]
        return f"{rows} UNION ALL SELECT {', '.join(loose)} FROM orders{where} AND {_JUNK} = 2"
    return f"SELECT {', '.join(cells)} FROM {source}{where}"
