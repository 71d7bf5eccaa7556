"""CSV files for spreadsheets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BYTE_ORDER_MARK = "\ufeff"


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> bool:
    """UTF-8 CSV with header and byte order mark; an empty frame writes nothing and returns False.

    A whole table is written by many tasks, each file with its own header. `single_file` is for
    frames with a known small bound, such as a page.
    """
    if df.isEmpty():
        return False
    times = (T.TimestampType, T.TimestampNTZType)
    texts = {f.name: F.col(f.name).cast("string") for f in df.schema if isinstance(f.dataType, times)}
    flags = {f.name: F.initcap(F.col(f.name).cast("string")) for f in df.schema if isinstance(f.dataType, T.BooleanType)}
    rows = df.withColumns({**texts, **flags}) if texts or flags else df
    rows = rows.withColumnRenamed(rows.columns[0], BYTE_ORDER_MARK + rows.columns[0])
    if single_file:
        rows = rows.coalesce(1)
    writer = rows.write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "")
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return True
