"""Byte strings that occur more than once, found with suffix arrays.

The least hash of the short byte strings inside a window is the same for equal windows. A document is cut into runs of
windows with the same least hash; only runs whose least hash occurs again are dealt out, by that hash, so that all
equal windows meet in one task. There their suffixes are sorted in two stages and adjacent ones with a common prefix of
the window's length are repeats. Identical runs are sent once, with their number. A least hash with many different runs
is dealt to several tasks, and the hashes of its windows are compared over the tasks.

Defined results: null and empty texts, and texts shorter than the window, keep everything; rows with the same id, null
ids and repeated rows are documents of their own, so a repeated long text goes from each of them; extra columns travel
in ``doc``; an empty table gives an empty result. Runs of a repeated byte are cut like any others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hemicycle.llm.hashing import CHUNK, U64, joined, mix, range_hashes, windows
from hemicycle.llm.shared_keys import flags, n_ranges, rows, shared, with_answers
from hemicycle.llm.storage import cut, pack, struct_of, text_bytes, unpack, whole_groups
from hemicycle.llm.suffix_array import DEPTH, MARGIN, SuffixArray

#: Bytes of the short strings whose least hash names a window.
SHORT = 16
#: Windows of a run at most.
LONGEST = 1024
#: Different runs of one least hash that one task sorts; those beyond are dealt to more tasks.
CROWD = 512
#: Runs sorted at once, and places where the runs of a crowd meet its number of tasks.
BATCH, SALTS = 2048, 32


def least_within(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbouring values, from running minima to both sides within blocks."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    pad = -len(values) % width
    blocks = np.append(values, np.full(pad, ~U64(0), U64)).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def short_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of every string of SHORT bytes, by start."""
    n = len(data) - SHORT + 1
    if n <= 0:
        return np.zeros(0, U64)
    words = np.ndarray((len(data) - 7,), "<u8", np.ascontiguousarray(data).data, strides=(1,))
    out = mix(words[:n].astype(U64))
    for at in range(8, SHORT, 8):
        out = joined(out, words[at : at + n])
    return out


def runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of windows of the rows of a block: first byte, number of windows, least hash, hash of the run's bytes, and
    whether the least hash lies at more than one place, so that the run may repeat itself.
    """
    out = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U64), np.zeros(0, U64), np.zeros(0, bool)]
    found = [out]
    ends = np.repeat(offsets[1:], np.diff(offsets))
    for base in range(0, len(data), CHUNK):
        part = data[base : base + CHUNK + DEPTH - 1]
        short = short_hashes(part)
        least = least_within(short, DEPTH - SHORT + 1)
        passed = np.append(0, np.cumsum(short[: len(least)] == least))  # windows that begin with their least hash
        at = np.arange(len(least))
        valid = at + base + DEPTH <= ends[base : base + len(least)]
        at, least = at[valid], least[valid]
        if not len(at):
            continue
        new = np.ones(len(at), bool)
        new[1:] = (least[1:] != least[:-1]) | (at[1:] != at[:-1] + 1)
        first = np.flatnonzero(new)
        place = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
        first = np.flatnonzero(place % LONGEST == 0)
        n = np.diff(np.append(first, len(at)))
        start = at[first]
        found.append([start + base, n, least[first], range_hashes(part, start, start + n + DEPTH - 1), passed[start + n - 1] > passed[start]])
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def runs_of(payload: bytes) -> tuple:
    table = unpack(payload)
    data, offsets = text_bytes(table.column("text"))
    return table, data, offsets, *runs(data, offsets)


def keys_of(payload: bytes) -> np.ndarray:
    """The least hashes of a block's runs; twice where a run may repeat itself."""
    *_, least, _, again = runs_of(payload)
    return np.concatenate([least, least[again]])


def spans(again: np.ndarray) -> bytes:
    """First and last (exclusive) of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], again.view(np.int8), [0]])))
    return edges.astype(np.int32).tobytes()


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Every byte goes that is covered by a string of DEPTH bytes that also starts anywhere else.

    Returns doc (a struct of all columns of ``docs``), kept (bytes), n_bytes, n_removed, n_spans, kept_sha256.
    """
    blocks = pack(docs)
    ranges = n_ranges(blocks)
    met = shared(blocks, lambda r: keys_of(r["payload"]), ranges)

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in rows(batches):
            *_, start, n, least, content, _ = runs_of(block["payload"])
            again = flags(least, block["met"], ranges) if len(least) else np.zeros(0, bool)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(least[again].view(np.int64)),
                    pa.array(content[again].view(np.int64)),
                    pa.array(np.full(again.sum(), block["block_id"], np.int64)),
                    pa.array(start[again]),
                    pa.array(n[again].astype(np.int32)),
                ],
                ["least", "content", "block_id", "start", "n"],
            )

    found = with_answers(blocks, met, "met").mapInArrow(occurrences, "least long, content long, block_id long, start long, n int")
    found = cut(found)
    place = F.struct(F.xxhash64("block_id", "start").alias("any"), "block_id", "start", "n")  # one block would serve all
    distinct = cut(found.groupBy("least", "content").agg(F.count("*").alias("copies"), F.min(place).alias("at")))
    crowds = distinct.groupBy("least").agg(F.ceil(F.count("*") / CROWD).alias("tasks")).where("tasks > 1")
    # a crowd's runs meet its number of tasks in SALTS places
    crowds = crowds.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    distinct = distinct.withColumn("salt", F.pmod(F.xxhash64("content"), F.lit(SALTS)).cast("int"))
    wanted = distinct.join(crowds, ["least", "salt"], "left").select(
        F.col("at.block_id").alias("block_id"),
        F.struct(
            F.xxhash64("least", F.pmod("content", F.coalesce("tasks", F.lit(1)))).alias("unit"),
            F.col("tasks").isNotNull().alias("crowd"), "least", "content", "copies", "at.start", "at.n",
        ).alias("run"),
    )
    sorted_ = cut(sort_runs(fetch(blocks, wanted)))
    repeats = sorted_.where("spans IS NOT NULL").select("least", "content", "spans")
    repeats = repeats.unionByName(across(sorted_.where("text IS NOT NULL").select("least", "content", "text")))
    marks = found.join(repeats, ["least", "content"]).groupBy("block_id").agg(F.collect_list(F.struct("start", "spans")).alias("marks"))
    return removed(blocks.join(marks.hint("shuffle_hash"), "block_id", "left"), docs.schema)


def fetch(blocks: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of one occurrence of each run."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in rows(batches):
            data, offsets = text_bytes(unpack(block["payload"]).column("text"))
            whole = data.tobytes()
            wants = block["wanted"]
            ends = offsets[np.searchsorted(offsets, [w["start"] for w in wants], "right")].tolist()
            texts = [whole[w["start"] : min(w["start"] + w["n"] + DEPTH - 1 + MARGIN, e)] for w, e in zip(wants, ends, strict=True)]
            columns = {k: [w[k] for w in wants] for k in ("unit", "crowd", "least", "content", "copies", "n")}
            types = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(v, t) for v, t in zip(columns.values(), types, strict=True)), pa.array(texts, pa.binary())], [*columns, "text"]
            )

    lists = wanted.groupBy("block_id").agg(F.collect_list("run").alias("wanted"))
    return blocks.join(lists.hint("shuffle_hash"), "block_id").mapInArrow(
        read, "unit long, crowd boolean, least long, content long, copies long, n int, text binary"
    )


def sort_runs(fetched: DataFrame) -> DataFrame:
    """(least, content, spans, text): spans of repeated windows of each run, or null; text only where tasks must compare."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "unit", BATCH):
            texts, n = table.column("text").to_pylist(), table.column("n").to_numpy()
            again = SuffixArray(texts, n.tolist()).repeated(table.column("copies").to_numpy())
            crowd = table.column("crowd").to_numpy().astype(bool)
            any_ = np.array([x.any() for x in again])
            keep = np.flatnonzero(any_ | crowd)
            yield pa.RecordBatch.from_arrays(
                [
                    table.column("least").combine_chunks().take(pa.array(keep)),
                    table.column("content").combine_chunks().take(pa.array(keep)),
                    pa.array([spans(again[i]) if any_[i] else None for i in keep], pa.binary()),
                    pa.array([texts[i][: n[i] + DEPTH - 1] if crowd[i] else None for i in keep], pa.binary()),
                ],
                ["least", "content", "spans", "text"],
            )

    dealt = fetched.repartition("unit").sortWithinPartitions("unit")
    return dealt.mapInArrow(sort, "least long, content long, spans binary, text binary")


def across(crowds: DataFrame) -> DataFrame:
    """Spans of the windows that occur in more than one run of a crowd, from the hashes of all its windows."""
    blocks = pack(crowds)
    ranges = n_ranges(blocks)

    def hashes(payload: bytes) -> tuple[pa.Table, np.ndarray, np.ndarray]:
        table = unpack(payload)
        data, offsets = text_bytes(table.column("text"))
        least = table.column("least").to_numpy().view(np.uint64)
        at = [np.arange(a, z - DEPTH + 1) for a, z in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        keys = windows(data, DEPTH)[np.concatenate(at)] ^ np.repeat(mix(least), [len(a) for a in at])
        return table, keys, np.cumsum([len(a) for a in at])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in rows(batches):
            table, keys, ends = hashes(block["payload"])
            again = np.split(flags(keys, block["answer"], ranges), ends[:-1])
            yield pa.RecordBatch.from_arrays(
                [table.column("least").combine_chunks(), table.column("content").combine_chunks(), pa.array([spans(x) for x in again], pa.binary())],
                ["least", "content", "spans"],
            )

    answers = shared(blocks, lambda r: hashes(r["payload"])[1], ranges)
    return with_answers(blocks, answers, "answer").mapInArrow(mark, "least long, content long, spans binary")


def removed(blocks: DataFrame, schema: T.StructType) -> DataFrame:
    """The documents of the blocks without the bytes of their marked windows."""

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in rows(batches):
            table = unpack(block["payload"])
            data, offsets = text_bytes(table.column("text"))
            steps = np.zeros(len(data) + 1, np.int32)
            for mark in block["marks"] or ():
                edges = np.frombuffer(mark["spans"], np.int32).reshape(-1, 2) + mark["start"]
                np.add.at(steps, edges[:, 0], 1)
                np.add.at(steps, edges[:, 1] + DEPTH - 1, -1)
            gone = np.cumsum(steps[:-1]) > 0
            starts = gone & ~np.append(False, gone[:-1])
            edge = offsets[:-1][np.diff(offsets) > 0]
            starts[edge] = gone[edge]
            total = lambda x: np.diff(np.append(0, np.cumsum(x))[offsets])
            kept = data[~gone].tobytes()
            bounds = np.append(0, np.cumsum(~gone))[offsets].tolist()
            texts = [kept[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    struct_of(table),
                    pa.array(texts, pa.binary()),
                    pa.array(np.diff(offsets)),
                    pa.array(total(gone), pa.int64()),
                    pa.array(total(starts), pa.int64()),
                    pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
                ],
                ["doc", "kept", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    numbers = [T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")]
    fields = [T.StructField("doc", schema), T.StructField("kept", T.BinaryType()), *numbers, T.StructField("kept_sha256", T.StringType())]
    return blocks.mapInArrow(remove, T.StructType(fields))
