"""Run registered queries against DuckDB: `python tests/compare.py [sf_dir] [name ...]`."""

from __future__ import annotations

import math
import os
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return repr(round(value, 6)) if not value.is_integer() else str(int(value))
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(_cell(v) for v in value) + "]"
    return str(value)


def rows_of(columns: list[str], rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def difference(spark, con, sf_dir: str, query, sql: str) -> tuple[str | None, int]:
    """What differs, or None; and the number of rows."""
    ours = query(spark, sf_dir)
    got = rows_of(ours.columns, ours.collect())
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = rows_of(names, cursor.fetchall())
    if sorted(ours.columns) != sorted(names):
        return f"columns {sorted(ours.columns)} != {sorted(names)}", len(got)
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}", len(got)
    for a, b in zip(got, want):
        if a != b:
            return f"{sorted(names)}\n    got  {a}\n    want {b}", len(got)
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    odd = {c: k for c, k in kinds.items() if k in ("HUGEINT", "INTEGER", "DATE", "TIMESTAMP") or k.startswith("DECIMAL")}
    return (f"check has unportable types {odd}" if odd else None), len(got)


def main() -> None:
    from conftest import new_session

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = new_session(), connect(sf_dir)
    queries, checks = entry.queries(), entry.oracle_sql()
    failures = 0
    for name in sys.argv[2:] or queries:
        started = time.time()
        try:
            if name in checks:
                problem, n = difference(spark, con, sf_dir, queries[name], checks[name])
            else:
                problem, n = None, queries[name](spark, sf_dir).count()
        except Exception as error:  # noqa: BLE001
            problem, n = f"{type(error).__name__}: {str(error)[:1500]}", -1
        failures += problem is not None
        state = "FAIL" if problem else ("ok" if name in checks else "rows only")
        print(f"{state:9} {name:42} {n:8} rows {time.time() - started:6.2f}s {problem or ''}", flush=True)
    print(f"{failures} failures of {len(sys.argv[2:] or queries)}; no check: {sorted(set(queries) - set(checks))}")


if __name__ == "__main__":
    os.environ.setdefault("PYTHONPATH", str(Path(__file__).resolve().parent.parent))
    main()
