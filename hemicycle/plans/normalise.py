"""Declared tables and the plan that fills them from raw documents.

A category of raw documents yields several tables. A table says which lists lead from the
document to its rows, which values of the document identify the parent, and where each column
comes from. Input frames have `_legislatura`, `_source_file` and the document `v` as VARIANT.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from dataclasses import replace as with_changes

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hemicycle.functions.dates import day_first_timestamp, iso_timestamp
from hemicycle.functions.variants import elements, is_object
from hemicycle.functions.variants import field as value_at

ORIGIN = ("_legislatura", "_source_file")
Path = tuple[str | int, ...]


@dataclass(frozen=True)
class Field:
    """One output column: its name, where its value sits and how to read it."""

    name: str
    path: Path
    kind: str
    compute: Callable[[Column], Column] | None = None

    @property
    def is_member(self) -> bool:
        """True for a value that sits directly under one key."""
        return self.compute is None and len(self.path) == 1 and isinstance(self.path[0], str)

    @property
    def raw_type(self) -> str:
        return {"json": "variant", "flag": "boolean"}.get(self.kind, "string")

    def read(self, v: Column) -> Column:
        """The column from the whole document or item."""
        if self.compute is not None:
            return self.compute(v)
        return self.typed(value_at(v, *self.path, as_type=self.raw_type))

    def typed(self, value: Column) -> Column:
        """The column from its raw value."""
        if self.kind == "json":
            return F.when(~F.is_variant_null(value), F.to_json(value))
        if self.kind == "date":
            return iso_timestamp(value)
        if self.kind == "day_first":
            return day_first_timestamp(value)
        return value


def _fields(kind: str, names: str) -> tuple[Field, ...]:
    return tuple(Field(n, (n,), kind) for n in names.split())


def texts(names: str) -> tuple[Field, ...]:
    """Columns named like the key they copy."""
    return _fields("text", names)


def dates(names: str) -> tuple[Field, ...]:
    return _fields("date", names)


def days_first(names: str) -> tuple[Field, ...]:
    return _fields("day_first", names)


def flags(names: str) -> tuple[Field, ...]:
    return _fields("flag", names)


def jsons(names: str) -> tuple[Field, ...]:
    """`<key>_json` columns holding the JSON text under each key."""
    return tuple(Field(f"{n}_json", (n,), "json") for n in names.split())


def at(name: str, *path: str | int, kind: str = "text") -> tuple[Field, ...]:
    """One column read from elsewhere than the key of its own name."""
    return (Field(name, path, kind),)


def under(prefix: str, parent: Path, names: str, kind: str = "text") -> tuple[Field, ...]:
    """Members of an embedded object as `<prefix>_<member>` columns."""
    return tuple(Field(f"{prefix}_{n}", (*parent, n), kind) for n in names.split())


def computed(name: str, compute: Callable[[Column], Column]) -> tuple[Field, ...]:
    return (Field(name, (), "computed", compute),)


@dataclass(frozen=True)
class Table:
    """Rows of one output table.

    `lists` are the list-valued steps from the document to a row, `ordinals` the columns that
    number the items of each step (gaps stay where an item is skipped), `keys` the values copied
    from the document. `scalars` says that items are plain values and not objects.
    """

    name: str
    columns: tuple[Field, ...] = ()
    lists: tuple[Path, ...] = ()
    ordinals: tuple[str, ...] = ()
    keys: tuple[Field, ...] = ()
    scalars: bool = False

    def renamed(self, name: str) -> Table:
        return with_changes(self, name=name)


@dataclass(frozen=True)
class Category:
    """One kind of raw file: the shape of its root and the tables read from it.

    With root `list` a document is one element of the file; with root `object` it is the file.
    `dynamic` tables copy every key they meet and are built by a function of the documents, from the lists that
    `dynamic_lists` names.
    """

    name: str
    root: str
    tables: tuple[Table, ...] = ()
    dynamic: dict[str, Callable[[DataFrame], DataFrame]] = field(default_factory=dict)
    dynamic_lists: tuple[Path, ...] = ()

    def large_lists(self) -> list[Path]:
        """The lists of an object file that its tables are read from; their elements may be documents of their own.

        A list whose items are numbered is not among them.
        """
        declared = [t.lists[0] for t in self.tables if t.lists and not t.ordinals and not t.keys]
        return [*dict.fromkeys([*declared, *self.dynamic_lists])]


def _project(df: DataFrame, carried: Sequence[str], fields: Sequence[Field]) -> DataFrame:
    """The columns of a table from the objects in `v`; rows with anything else in `v` are dropped.

    All values directly under a key are read in one pass over the object, as one struct.
    """
    members = [f for f in fields if f.is_member]
    shape = ", ".join(f"`{f.path[0]}`: {f.raw_type}" for f in members)
    record = value_at(F.col("v"), as_type=f"struct<{shape}>" if members else "map<string,variant>")
    opened = df.select(*carried, *ORIGIN, "v", record.alias("__record")).filter(F.col("__record").isNotNull())
    cells = [f.typed(F.col("__record")[f.path[0]]) if f.is_member else f.read(F.col("v")) for f in fields]
    return opened.select(*carried, *[c.alias(f.name) for c, f in zip(cells, fields)], *ORIGIN)


def rows_of(table: Table, docs: DataFrame) -> DataFrame:
    """The rows of one declared table, with their origin."""
    v = F.col("v")
    carried = [k.name for k in table.keys]
    if not table.lists:
        docs = docs.filter("NOT is_part") if "is_part" in docs.columns else docs
        return _project(docs, (), (*table.keys, *table.columns))
    df = docs.select(*[k.read(v).alias(k.name) for k in table.keys], *ORIGIN, "v")
    last = len(table.lists) - 1
    for depth, step in enumerate(table.lists):
        position = table.ordinals[depth] if table.ordinals else f"__pos{depth}"
        df = df.select(*carried, *ORIGIN, F.posexplode(elements(v, *step)).alias(position, "v"))
        if depth < last:
            df = df.filter(is_object(v))
        if table.ordinals:
            carried = [*carried, position]
    if table.scalars:
        (column,) = table.columns
        plain = df.filter(~F.is_variant_null(v))
        return plain.select(*carried, v.try_cast("string").alias(column.name), *ORIGIN)
    return _project(df, carried, table.columns)


def normalise(category: Category, docs: DataFrame, only: Sequence[str] = ()) -> dict[str, DataFrame]:
    """All tables of a category, or the named ones, as lazy frames over the same documents."""
    wanted = set(only)
    frames = {t.name: rows_of(t, docs) for t in category.tables if not wanted or t.name in wanted}
    for name, build in category.dynamic.items():
        if not wanted or name in wanted:
            frames[name] = build(docs)
    return frames
