"""Cutting lineage, and the blocks of whole documents that the kernels work on."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text in a block. A longer document is a block of its own.
BLOCK_BYTES = 4 << 20
#: Rows in a block, so that a row's number fits beside the block's.
BLOCK_ROWS = 1 << 16
BLOCK_SCHEMA = "block_id long, n_bytes long, payload binary"


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; one of our own only where none is set, as in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isEmpty():
        folder = folder or tempfile.mkdtemp(prefix="hemicycle-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder or current.get()


def cut(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder: later steps read them instead of computing them again."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def payload_of(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table.combine_chunks())
    return sink.getvalue().to_pybytes()


def packer(limit: int):
    """Rows into blocks of at most ``limit`` bytes of text; a block is one compressed Arrow table with all columns."""

    def write(rows: list[pa.RecordBatch], number: int, size: int) -> pa.RecordBatch:
        payload = payload_of(pa.Table.from_batches(rows))
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.array([size], pa.int64()), pa.array([payload], pa.binary())],
            ["block_id", "n_bytes", "payload"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        held: list[pa.RecordBatch] = []
        size = count = 0
        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index("text"))), 0).to_numpy(zero_copy_only=False)
            start = 0
            for i, length in enumerate(lengths.tolist()):
                if count and size + length > limit or count == BLOCK_ROWS:
                    yield write([*held, batch.slice(start, i - start)], number, size)
                    held, size, count, start, number = [], 0, 0, i, number + 1
                size, count = size + length, count + 1
            held.append(batch.slice(start))
        if any(x.num_rows for x in held):
            yield write(held, number, size)

    return run


def pack(docs: DataFrame, limit: int = BLOCK_BYTES) -> DataFrame:
    """Whole documents, compressed, in blocks with lasting numbers: (block_id, n_bytes, payload).

    Passes over the blocks refer to rows by their place in a block, so repeated or null ids are no problem,
    and the columns of the documents, being inside the payload, clash with nothing.
    """
    return cut(docs.mapInArrow(packer(limit), BLOCK_SCHEMA))


def unpack(payload: bytes | pa.Buffer) -> pa.Table:
    return pa.ipc.open_stream(payload).read_all().combine_chunks()


def text_bytes(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows, one after the other, and where each row starts (one more entry than rows). Null: empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        column = column if isinstance(column, pa.Array) else pa.concat_arrays(column.chunks)
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    bytes_ = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return bytes_, at - at[0]


def whole_groups(batches: Iterator[pa.RecordBatch], key: str, least: int) -> Iterator[pa.Table]:
    """Rows sorted by ``key`` as tables of whole groups, each of at least ``least`` rows but for the last."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(x.num_rows for x in held) < least:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        keys = table.column(key).to_numpy()
        last = int(np.searchsorted(keys, keys[-1]))
        if last:
            yield table.slice(0, last)
            held = table.slice(last).to_batches()
    if any(x.num_rows for x in held):
        yield pa.Table.from_batches(held).combine_chunks()


def slices(batches: Iterator[pa.RecordBatch], limit: int = BLOCK_BYTES) -> Iterator[pa.Table]:
    """The rows in tables of at most ``limit`` bytes of text, or of one longer row."""
    for batch in batches:
        table = pa.Table.from_batches([batch])
        sizes = pc.fill_null(pc.binary_length(table.column("text")), 0).to_numpy()
        ends = np.cumsum(sizes)
        start = 0
        while start < len(sizes):
            end = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + limit, "right")))
            yield table.slice(start, end - start).combine_chunks()
            start = end


def struct_of(table: pa.Table) -> pa.Array:
    """The columns of a table as one struct column, to carry them under one name."""
    arrays = [c.combine_chunks() if c.num_chunks != 1 else c.chunk(0) for c in table.columns]
    return pa.StructArray.from_arrays(arrays, fields=list(table.schema))
