"""Mixing sources to target weights with a low-discrepancy schedule, in DataFrame operations only.

Each source's documents, in an order shuffled by a digest of their ids, form a stream of words that is cut into equal
blocks and read at most twice. The slots of the mix are the points of the van der Corput sequence: the first 2**m of
them fill an even grid, so a source whose blocks take up a part of all blocks gets at least that many slots, spread
evenly over the mix. A slot's rank within its source says which block it takes.

Running sums and ranks are taken in two steps, within buckets and over buckets, so that no task holds a source.

Defined results: a null source is a source, after all others; null and empty texts and texts of white space have size
0 and are never taken; a null id is shuffled as an empty text; rows with the same id are documents of their own, and
equal ones are interchangeable; extra columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hemicycle.llm.storage import cut

WORD = r"[^\x20\x09-\x0D]+"
#: Words of a block; the last block of a source is cut to its target.
BLOCK_WORDS = 4096
#: Rows of a bucket of the two-step sums, about; slots and points of a chunk.
BUCKET, CHUNK = 256, 1024
#: Weights of the sources, in turn; share of all words and most uses of a word, as fractions.
WEIGHTS, SHARE, MOST = (3, 1, 2), (3, 2), 2


def running(df: DataFrame, keys: list[str], bucket: str, order: list[Column], value: Column, name: str) -> DataFrame:
    """``name``: the sum of ``value`` over the rows before this one among those with the same keys, by bucket and order."""
    within = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    sums = df.groupBy(*keys, bucket).agg(F.sum(value).alias("_sum"))
    sums = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    df = df.withColumn("_within", F.coalesce(F.sum(value).over(within), F.lit(0)))
    return df.join(sums, [*keys, bucket]).withColumn(name, F.col("_before") + F.col("_within")).drop("_before", "_within")


def targets(sizes: DataFrame) -> DataFrame:
    """(source, number, source_size, target, blocks, from_, till): targets, and the grid points of each source.

    The driver learns sums over the sources, round by round, until no target is above its limit.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # numbers by code point without one task for all: place in a sorted part, plus the parts before
    per = cut(per.repartitionByRange(F.col("source").asc_nulls_last()).sortWithinPartitions(F.col("source").asc_nulls_last()))
    per = per.withColumn("part", F.spark_partition_id()).withColumn("one", F.lit(1)).withColumn("all", F.lit(0))
    per = running(per, ["all"], "part", [F.col("source").asc_nulls_last()], F.col("one"), "number")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("number") % len(WEIGHTS) + 1).cast("int"))
    per = cut(per.select("source", "number", "source_size", weight.alias("weight")))
    limit, part = F.col("source_size") * MOST, 0.0
    held = None
    while True:
        above = limit < F.col("weight") * part
        full, n, free, total = per.agg(
            F.sum(F.when(above, limit)), F.sum(above.cast("long")), F.sum(F.when(~above, F.col("weight"))), F.sum("source_size")
        ).first()
        if n == held:
            break
        held = n
        part = (SHARE[0] * (total or 0) - SHARE[1] * (full or 0)) / (float(SHARE[1]) * free) if free else 0.0
    target = F.when(limit < F.col("weight") * part, limit.cast("double")).otherwise(F.col("weight") * F.lit(part))
    per = per.withColumn("target", target).withColumn("words", F.floor("target"))
    per = per.withColumn("blocks", F.ceil(F.col("words") / BLOCK_WORDS)).withColumn("all", F.lit(0))
    per = per.withColumn("bucket", F.floor(F.col("number") / CHUNK))
    return cut(running(per, ["all"], "bucket", [F.col("number")], F.col("blocks"), "first").drop("all", "bucket"))


def schedule(per: DataFrame) -> DataFrame:
    """(slot, number, block): which block of which source each slot of the mix takes."""
    total = per.agg(F.sum("blocks")).first()[0] or 0
    bits = max(1, math.ceil(math.log2(max(total, 2))))
    grid = 1 << bits
    edge = lambda c: F.ceil(c.cast("decimal(20,0)") * F.lit(grid).cast("decimal(17,0)") / max(total, 1)).cast("long")
    points = per.where("blocks > 0").select(
        "number", "blocks", edge(F.col("first")).alias("lo"), edge(F.col("first") + F.col("blocks")).alias("hi")
    )
    points = points.withColumn("chunk", F.explode(F.expr(f"sequence(lo div {CHUNK}, (hi - 1) div {CHUNK})"))).repartition("number", "chunk")
    low, high = F.greatest("lo", F.col("chunk") * CHUNK), F.least("hi", (F.col("chunk") + 1) * CHUNK) - 1
    points = points.withColumn("point", F.explode(F.sequence(low, high)))
    # the slot whose van der Corput point this is: its bits in reverse order
    slot = F.conv(F.reverse(F.lpad(F.bin("point"), bits, "0")), 2, 10).cast("long")
    slots = cut(points.select("number", "blocks", slot.alias("slot"))).withColumn("chunk", F.floor(F.col("slot") / CHUNK)).withColumn("one", F.lit(1))
    ranked = running(slots, ["number"], "chunk", [F.col("slot")], F.col("one"), "block")
    return ranked.where("block < blocks").select("slot", "number", "block")


def mix(docs: DataFrame, by_text: bool = False) -> tuple[DataFrame, DataFrame]:
    """The schedule, and for each document (row, doc_id, source, size, source_size, target, taken).

    With ``by_text`` also a digest of the text.
    """
    digest = [F.xxhash64("text").alias("digest")] if by_text else []
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    sizes = docs.select("doc_id", "source", size.alias("size"), F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("shuffled"), *digest)
    sizes = cut(sizes.withColumn("row", F.monotonically_increasing_id()))
    per = targets(sizes)
    slots = cut(schedule(per))
    digits = max(1, math.ceil(math.log(max(1, sizes.count() / BUCKET), 16)))
    placed = sizes.withColumnRenamed("source", "of").join(per, F.col("of").eqNullSafe(F.col("source"))).drop("of")
    placed = placed.withColumn("bucket", F.substring("shuffled", 1, digits))
    placed = cut(running(placed, ["number"], "bucket", [F.col("shuffled"), F.col("doc_id"), F.col("size"), F.col("row")], F.col("size"), "start"))
    twice = placed.where("size > 0").withColumn("start", F.explode(F.expr(f"transform(sequence(0, {MOST} - 1), p -> start + p * source_size)")))
    twice = twice.where("start < words").withColumn("end", F.least(F.col("start") + F.col("size"), "words"))
    pieces = twice.withColumn("block", F.explode(F.expr(f"sequence(start div {BLOCK_WORDS}, (end - 1) div {BLOCK_WORDS})")))
    low, high = F.greatest("start", F.col("block") * BLOCK_WORDS), F.least("end", (F.col("block") + 1) * BLOCK_WORDS)
    taken = pieces.select("row", "number", "block", (high - low).alias("n")).join(slots.select("number", "block"), ["number", "block"])
    taken = taken.groupBy("row").agg(F.sum("n").alias("taken"))
    out = placed.join(taken, "row", "left").withColumn("taken", F.coalesce("taken", F.lit(0)))
    return slots, out.select("row", "doc_id", "source", "size", "source_size", "target", "taken", *(["digest"] if by_text else []))


def mixed(docs: DataFrame) -> DataFrame:
    """The documents as often as the mix takes them, with all their columns: never, once or up to MOST times.

    A document that its source's last block cuts counts by the nearest whole number. Rows that are equal in id, source
    and text share their uses, to the nearest whole number. Texts without words are not taken.
    """
    _, found = mix(docs, by_text=True)
    key = ["doc_id", "source", "digest"]
    uses = found.where("size > 0").groupBy(*key).agg((F.sum("taken") / F.sum("size")).alias("uses"))
    uses = uses.withColumn("uses", F.floor(F.col("uses") + 0.5)).where("uses > 0")
    # the documents' own columns stay inside one, so their names meet no others
    doc = F.col("doc")
    carried = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"))
    same = F.xxhash64(doc.getField("text")) == F.col("digest")
    for k in key[:2]:
        same &= F.col(k).eqNullSafe(doc.getField(k))
    taken = carried.join(uses.hint("shuffle_hash"), same)
    return taken.select("doc", F.explode(F.sequence(F.lit(1), F.col("uses")))).select(*(doc.getField(c).alias(c) for c in docs.columns))
