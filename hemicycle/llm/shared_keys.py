"""Which 64-bit keys of a block occur more than once in the corpus.

Every block sends each of its distinct keys once, packed into binary rows by key range, with a bit for keys that it
holds twice itself. The task of a range answers every block with one bit for each key. A key that a third of all
rows hold thus costs one entry a block, and the answer travels as bits, not as keys. Where it is asked how often a key
occurs, bytes stand in place of the bits, and counts end at 255.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text for each key range.
RANGE_BYTES = 8 << 20

Keys = Callable[[dict], np.ndarray]


def n_ranges(blocks: DataFrame) -> int:
    """Number of key ranges, in proportion to the text; one small number reaches the driver."""
    return max(16, (blocks.agg(F.sum("n_bytes")).first()[0] or 0) // RANGE_BYTES)


def cuts(distinct: np.ndarray, ranges: int) -> np.ndarray:
    at = ((distinct >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
    return np.searchsorted(at, np.arange(ranges + 1, dtype=np.uint64))


def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one by one, so that one block at a time is unpacked."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(k)[i].as_py() for k, name in enumerate(batch.schema.names)}
        del batch  # before the next one is read


def packed(keys: np.ndarray, width: int) -> bytes:
    """The upper bytes of little-endian keys."""
    return keys.view(np.uint8).reshape(-1, 8)[:, 8 - width :].tobytes()


def unpacked(data: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, 8 - width :] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return out.view(np.uint64).ravel()


def least_byte(counts: np.ndarray) -> bytes:
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def shared(blocks: DataFrame, keys: Keys, ranges: int, width: int = 8, counted: bool = False) -> DataFrame:
    """(block_id, answer): for each block, the bits of its keys, by range. ``keys`` takes a row of ``blocks``.

    With a ``width`` below 8 only so many upper bytes are compared, and the lower ones must be zero. With ``counted``
    the answer holds a byte for each key, read by ``times`` and not by ``flags``.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows(batches):
            distinct, counts = np.unique(keys(row), return_counts=True)
            at = cuts(distinct, ranges)
            used = np.flatnonzero(np.diff(at))
            if len(used):
                parts = [slice(at[r], at[r + 1]) for r in used]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(used, pa.int32()),
                        pa.array([row["block_id"]] * len(used), pa.int64()),
                        pa.array([packed(distinct[p], width) for p in parts], pa.binary()),
                        pa.array([least_byte(counts[p]) if counted else np.packbits(counts[p] > 1).tobytes() for p in parts], pa.binary()),
                    ],
                    ["part", "block_id", "keys", "twice"],
                )

    def answer(table: pa.Table) -> pa.Table:
        found = [unpacked(x, width) for x in table.column("keys").to_pylist()]
        every = np.concatenate(found)
        ends = np.cumsum([len(k) for k in found])
        if counted:
            own = np.concatenate([np.frombuffer(t, np.uint8) for t in table.column("twice").to_pylist()]).astype(np.int64)
            order = np.argsort(every, kind="stable")
            start = np.flatnonzero(np.append(True, every[order[1:]] != every[order[:-1]]))
            own[order] = np.repeat(np.add.reduceat(own[order], start), np.diff(np.append(start, len(every))))
            bytes_ = [least_byte(own[e - len(k) : e]) for e, k in zip(ends, found, strict=True)]
            return pa.table({"part": table.column("part"), "block_id": table.column("block_id"), "bits": pa.array(bytes_, pa.binary())})
        many = np.concatenate(
            [np.unpackbits(np.frombuffer(t, np.uint8), count=len(k)) for t, k in zip(table.column("twice").to_pylist(), found, strict=True)]
        ).astype(bool)
        order = np.argsort(every, kind="stable")
        same = np.zeros(len(every) + 1, bool)
        same[1:-1] = every[order[1:]] == every[order[:-1]]
        many[order] |= same[1:] | same[:-1]
        bits = [np.packbits(many[e - len(k) : e]).tobytes() for e, k in zip(ends, found, strict=True)]
        return pa.table({"part": table.column("part"), "block_id": table.column("block_id"), "bits": pa.array(bits, pa.binary())})

    sent = blocks.mapInArrow(send, "part int, block_id long, keys binary, twice binary")
    answers = sent.groupBy("part").applyInArrow(answer, "part int, block_id long, bits binary")
    return answers.groupBy("block_id").agg(F.collect_list(F.struct("part", "bits")).alias("answer"))


def with_answers(blocks: DataFrame, answers: DataFrame, name: str) -> DataFrame:
    return blocks.join(answers.withColumnRenamed("answer", name).hint("shuffle_hash"), "block_id", "left")


def flags(keys: np.ndarray, answer: list[dict] | None, ranges: int) -> np.ndarray:
    """For each of the keys that the block sent, whether the corpus holds it more than once."""
    distinct, inverse = np.unique(keys, return_inverse=True)
    at = cuts(distinct, ranges)
    out = np.zeros(len(distinct), bool)
    for part in answer or ():
        a, b = at[part["part"]], at[part["part"] + 1]
        out[a:b] = np.unpackbits(np.frombuffer(part["bits"], np.uint8), count=b - a)
    return out[inverse]


def times(keys: np.ndarray, answer: list[dict] | None, ranges: int) -> np.ndarray:
    """For each of the keys that the block sent, how often the corpus holds it, up to 255 times, from a ``counted`` answer."""
    distinct, inverse = np.unique(keys, return_inverse=True)
    at = cuts(distinct, ranges)
    out = np.zeros(len(distinct), np.uint8)
    for part in answer or ():
        a, b = at[part["part"]], at[part["part"] + 1]
        out[a:b] = np.frombuffer(part["bits"], np.uint8)
    return out[inverse]
