"""Text search, cleaning and naming."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns contain no such character, so `%` and `_` are wildcards and nothing is an escape.
_NO_ESCAPE = "\u0001"


def contains(column: Column, text: str) -> Column:
    """Case-insensitive substring test; `%` and `_` in the text act as wildcards."""
    return F.ilike(column, F.lit(f"%{text}%"), F.lit(_NO_ESCAPE))


def contains_any(columns: list[Column], text: str, null_safe: bool = False) -> Column:
    hits = [contains(F.coalesce(c, F.lit("")) if null_safe else c, text) for c in columns]
    return reduce(lambda a, b: a | b, hits)


def plain_text(html: Column) -> Column:
    """HTML fragment as one line: line breaks become ` | `, tags go, blanks collapse; null gives ''."""
    text = F.regexp_replace(F.coalesce(html, F.lit("")), r"<BR\s*/?>", " | ")
    text = F.regexp_replace(text, r"<[^>]+>", "")
    text = F.regexp_replace(text, r"(?U)\s+", " ")
    return F.trim(text)


def or_dash(value: Column, default: Column | str = "—") -> Column:
    return F.coalesce(value.cast("string"), F.lit(default) if isinstance(default, str) else default)


def person_label(short: Column, full: Column, place: Column) -> Column:
    """`name — place`, falling back to the full name, then to `(s/n)`."""
    return F.concat(or_dash(short, or_dash(full, "(s/n)")), F.lit(" — "), or_dash(place))


def snake_case(name: Column) -> Column:
    """`VotacaoFinal_json` -> `votacao_final`."""
    name = F.regexp_replace(name, "_json$", "")
    name = F.regexp_replace(name, "([a-z0-9])([A-Z])", "$1_$2")
    name = F.lower(F.regexp_replace(name, "[^a-zA-Z0-9_]", "_"))
    return F.regexp_replace(name, "^_+|_+$", "")


def snake_name(name: str) -> str:
    """`snake_case` for a name known on the driver, such as a table name."""
    name = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name.removesuffix("_json"))
    return re.sub(r"[^a-zA-Z0-9_]", "_", name).lower().strip("_")


def column_name(key: Column) -> Column:
    """A JSON key as a column name."""
    return F.regexp_replace(key, "[^a-zA-Z0-9_]", "_")


def without_prefix(name: Column, prefix: str) -> Column:
    return F.when(F.startswith(name, F.lit(prefix)), F.substr(name, F.lit(len(prefix) + 1))).otherwise(name)
