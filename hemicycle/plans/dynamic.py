"""Tables whose columns are the keys found in the data.

Items are stored in the long form (`long_form`): one row per entry in a fixed schema, without a job and without a
column per key. `key_catalogue` lists the keys as a table, and `wide_form` gives the columns that a caller names. The
wide form with a column for every key (`discover`, `layout`, `spread`) needs one aggregate job, as schema inference does,
whose list of keys is as long as the table is wide; it is for sources whose keys are known to be few.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hemicycle.functions.variants import is_nested, is_object, members, nested_text, scalar_text


@dataclass(frozen=True)
class Key:
    """A key, whether it held nested values, and whether an item also has another key of the same column name."""

    name: str
    nested: bool
    clashes: bool


@dataclass(frozen=True)
class Shape:
    """Keys met in a set of items."""

    keys: tuple[Key, ...]
    has_plain_items: bool


def same_name(key: str) -> str:
    return key


def safe_name(key: str) -> str:
    """A key with every character that is not a letter, digit or underscore replaced."""
    return re.sub(r"[^a-zA-Z0-9_]", "_", key)


def key_usage(items: DataFrame, column: str = "item") -> DataFrame:
    """Distinct (is_object, key, nested, clashes) over all items; the reduction starts in the map tasks.

    Items are first reduced to the different sets of keys they have, and only these are named and opened.
    """
    item = F.col(column)
    own = F.transform(F.map_entries(members(item)), lambda e: F.struct(e["key"].alias("key"), is_nested(e["value"]).alias("nested")))
    opened = items.select(is_object(item).alias("is_object"), own.alias("entries")).distinct()
    column_of = lambda e: F.lower(F.regexp_replace(e["key"], "[^a-zA-Z0-9_]", "_"))
    names = F.transform("entries", column_of)
    opened = opened.withColumn("several", F.size(F.array_distinct(names)) < F.size(names))
    alike = lambda e: F.size(F.filter(names, lambda n: n == column_of(e))) > 1
    marked = F.transform(
        "entries", lambda e: F.struct(e["key"].alias("key"), e["nested"].alias("nested"), (F.col("several") & alike(e)).alias("clashes"))
    )
    entries = opened.select("is_object", F.explode_outer(marked).alias("e"))
    found = entries.select("is_object", F.col("e.key").alias("key"), F.coalesce("e.nested", F.lit(False)).alias("nested"), "e.clashes")
    return found.groupBy("is_object", "key", "nested").agg(F.max("clashes").alias("clashes"))


def discover(items: DataFrame, column: str = "item") -> Shape:
    found = key_usage(items, column).collect()
    clashing = {r["key"] for r in found if r["clashes"]}
    keys = sorted({(r["key"], r["nested"]) for r in found if r["key"] is not None})
    return Shape(tuple(Key(k, n, k in clashing) for k, n in keys), any(not r["is_object"] for r in found))


def layout(
    shape: Shape,
    name_of: Callable[[str], str],
    taken: Sequence[str] = (),
    plain_key: Callable[[str], bool] = lambda key: True,
) -> dict[str, list[tuple[str, bool]]]:
    """Output columns in key order, each with the (key, nested) values it merges.

    Nested values go to `<name>_json`, and so do scalars of keys that `plain_key` rejects. Keys
    that differ only in case, or only in replaced characters, share a column as long as no item
    holds two of them; else each has a column of its own, numbered from the second on. A name
    already `taken` by the parent gets the prefix `item_`.
    """
    columns: dict[str, list[tuple[str, bool]]] = {}
    spelling: dict[str, str] = {}
    alone: set[str] = set()
    reserved = {t.lower() for t in taken}
    for key in shape.keys:
        wanted = name_of(key.name) + ("_json" if key.nested or not plain_key(key.name) else "")
        prefixed = wanted.lower() in reserved
        wanted = f"item_{wanted}" if prefixed else wanted
        name, n = spelling.get(wanted.lower(), wanted), 1
        single = key.clashes or prefixed
        same_key = lambda name: all(k == key.name for k, _ in columns[name])
        while name in columns and not same_key(name) and (single or name in alone):
            n += 1
            name = f"{wanted}_{n}"
            name = spelling.get(name.lower(), name)
        spelling[name.lower()] = name
        columns.setdefault(name, []).append((key.name, key.nested))
        if single:
            alone.add(name)
    return columns


def spread(
    items: DataFrame,
    kept: Sequence[str],
    columns: dict[str, list[tuple[str, bool]]],
    column: str = "item",
    blank_is_null: bool = False,
) -> DataFrame:
    """One output column per entry of `columns`, read from the object in each row."""

    def read(key: str, nested: bool) -> Column:
        value = _member(F.col(column), key)
        if not nested:
            return scalar_text(value)
        return nested_text(value) if blank_is_null else F.when(is_nested(value), F.to_json(value))

    cells = [F.coalesce(*[read(k, nested) for k, nested in parts]).alias(name) for name, parts in columns.items()]
    return items.select(*kept, column, *cells)


def _member(v: Column, key: str) -> Column:
    """The value of a key; found by search in the object, not by a pass over its entries."""
    if re.search(r'["\\]', key):  # such keys have no path
        return F.try_element_at(members(v), F.lit(key))
    return F.try_variant_get(v, f'$["{key}"]', "variant")


def long_rows(items: DataFrame, kept: Sequence[str], column: str = "item") -> DataFrame:
    """One row per entry of each object: its key, and its value as plain or JSON text."""
    entries = items.select(*kept, F.explode(F.map_entries(members(F.col(column)))).alias("e"))
    value = F.col("e.value")
    return entries.select(
        *kept, F.col("e.key").alias("key"), F.coalesce(scalar_text(value), nested_text(value)).alias("value")
    )


def long_form(items: DataFrame, kept: Sequence[str], column: str = "item") -> DataFrame:
    """The stored form of items with any keys, in one fixed schema and without a job: (kept, name, key, value, nested, clash).

    One row per entry of an object that has a value. `name` is the column the entry has in the wide form, `clash` tells
    that another key of the same item has that name too. An item that is no object is one row without name and key.
    """
    item = F.col(column)
    own = items.select(*kept, column, F.map_entries(members(item)).alias("__entries"))
    plain = F.array(F.struct(F.lit(None).cast("string").alias("key"), item.alias("value")))
    column_of = lambda e: F.lower(F.regexp_replace(e["key"], "[^a-zA-Z0-9_]", "_"))
    own = own.withColumn("__names", F.transform("__entries", column_of))
    own = own.withColumn("__several", F.size(F.array_distinct("__names")) < F.size("__names"))
    alike = lambda e: F.size(F.filter("__names", lambda n: n == column_of(e))) > 1
    marked = F.transform(
        F.coalesce("__entries", plain),
        lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value"), F.coalesce(F.col("__several") & alike(e), F.lit(False)).alias("clash")),
    )
    rows = own.select(*kept, F.explode(marked).alias("e"))
    value = F.col("e.value")
    rows = rows.select(
        *kept, F.col("e.key").alias("key"), F.coalesce(scalar_text(value), nested_text(value)).alias("value"), is_nested(value).alias("nested"), F.col("e.clash").alias("clash")
    )
    name = F.concat(F.regexp_replace("key", "[^a-zA-Z0-9_]", "_"), F.when(F.col("nested"), F.lit("_json")).otherwise(F.lit("")))
    return rows.filter("value IS NOT NULL").select(*kept, name.alias("name"), "key", "value", "nested", "clash")


def key_catalogue(rows: DataFrame) -> DataFrame:
    """(name, key, nested, clash, n) of rows in the long form: which keys there are, as a table of any length."""
    return rows.filter("key IS NOT NULL").groupBy("name", "key", "nested").agg(F.max("clash").alias("clash"), F.count("*").alias("n"))


def wide_form(rows: DataFrame, kept: Sequence[str], names: Sequence[str], plain: str | None = None) -> DataFrame:
    """The named columns of rows in the long form, one row per item that has a value in any column at all.

    Names match without regard to case. Of several keys of an item with one name the first in order counts; `key_catalogue`
    tells where that happens. `plain` names the column for items that are no objects.
    """
    cells = [F.min_by(F.when(F.lower("name") == n.lower(), F.col("value")), F.when(F.lower("name") == n.lower(), F.col("key"))).alias(n) for n in names]
    if plain:
        cells.append(F.min(F.when(F.col("key").isNull(), F.col("value"))).alias(plain))
    return rows.groupBy(*kept).agg(*cells)
