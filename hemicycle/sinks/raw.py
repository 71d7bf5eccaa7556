"""Raw JSON files as the sources publish them: arrays or objects, by legislature and category."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hemicycle.sources.store import PARTITION, rename_data_files

#: Items of a file, about. A legislature with more has several files, in folders of their own.
FILE_ITEMS = 100_000


def write_raw(items: DataFrame, root: str, category: str, order: str, head: str = "[", tail: str = "]", per_file: int = FILE_ITEMS) -> None:
    """`<root>/<part>/<legislature>/<category>.json` from rows (_legislatura, item as JSON text), a line an item.

    Items are dealt to the files of their legislature by a hash of `order`, and stand in that order in a file. A task
    writes whole files, and files are bounded, so a large legislature takes many tasks.
    """
    sizes = items.groupBy(PARTITION).agg(F.ceil(F.count("*") / per_file).alias("files"))
    # as few rows as there are legislatures; left to itself, Spark takes the items for the smaller side if they were dealt short
    dealt = items.join(F.broadcast(sizes), PARTITION).withColumn("part", F.pmod(F.xxhash64(order), "files"))
    file = Window.partitionBy(PARTITION, "part").orderBy(order)
    opening = F.when(F.row_number().over(file) == 1, F.lit(head)).otherwise(F.lit(","))
    closing = F.when(F.lead(F.lit(1)).over(file).isNull(), F.lit(tail)).otherwise(F.lit(""))
    lines = dealt.select(PARTITION, "part", F.concat(opening, "item", closing).alias("value"))
    # a window's rows stay in its order, and the writer asks for no other
    staging = f"{root}/.{category}"
    lines.write.partitionBy(PARTITION, "part").text(staging)
    rename_data_files(items.sparkSession, staging, lambda folder: f"{root}/{folder['part']}/{folder[PARTITION]}/{category}.json")
