"""Repeated word passages, found through anchors at difference-cover positions.

A difference cover of a period holds, for any two places, a shift below the period that brings both onto the cover.
Two equal passages of ``window`` words therefore share an anchor of ``window - period + 1`` words that starts at a cover
position in both. Only anchors at cover positions are hashed and counted over the corpus; around anchors that occur
again the match is extended to every whole window that holds the anchor, and those windows are counted in turn.

Defined results: null and empty texts have no words; a text of fewer words than a window keeps all; rows with the
same id, null ids and repeated rows are documents of their own, so a repeated long text goes from each of them (windows
are judged on the input). Extra columns of any name travel in ``doc``. An empty table gives an empty result.
Windows count as equal when their 64-bit hashes do, which differ for unequal ones but by chance.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hemicycle.llm.hashing import Words, covered, windows
from hemicycle.llm.shared_keys import flags, n_ranges, rows, shared, with_answers
from hemicycle.llm.storage import pack, struct_of, text_bytes, unpack

#: Difference covers: every residue of the period is a difference of two members.
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}


def period_for(window: int) -> int:
    """The longest period that leaves an anchor of two fifths of the window."""
    return max(p for p in COVERS if p == 1 or p <= window * 3 // 5)


class Passages:
    """Words of one block and their anchors and windows."""

    def __init__(self, payload: bytes, window: int):
        self.table, self.window, self.period = unpack(payload), window, period_for(window)
        data, offsets = text_bytes(self.table.column("text"))
        self.offsets = offsets
        self.words = Words(data, offsets)
        self.hashes = self.words.hashes()
        counts, row = self.words.counts, self.words.row()
        self.place = np.arange(len(self.words)) - self.words.bounds[row]
        self.left = counts[row] - self.place  # words from here to the end of the document
        self.long = counts[row] >= window

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Word positions on the cover and the hashes of the anchors that start there."""
        length = self.window - self.period + 1
        on_cover = np.isin(np.arange(self.period), COVERS[self.period])[self.place % self.period]
        at = np.flatnonzero(on_cover & self.long & (self.left >= length))
        return at, windows(self.hashes, length)[at]

    def windows(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the windows that hold one of the anchors, and their hashes."""
        reach = self.period  # an anchor is 0 to period - 1 words into the window
        near = covered(np.maximum(anchors - reach + 1, 0), reach, len(self.words))
        at = np.flatnonzero(near & (self.left >= self.window))
        return at, windows(self.hashes, self.window)[at]

    def repeated(self, row: dict, ranges: int) -> tuple[np.ndarray, np.ndarray]:
        at, keys = self.anchors()
        return self.windows(at[flags(keys, row["anchors"], ranges)])


def remove_repeats(docs: DataFrame, window: int = 35) -> DataFrame:
    """Every word goes that is covered by a window of ``window`` words that also starts anywhere else.

    Returns doc (a struct of all columns of ``docs``), kept_text (kept words joined by one space), n_words, n_removed,
    kept_sha256. Counts and candidates cover all rows; one block of text is in memory at a time.
    """
    blocks = pack(docs)
    ranges = n_ranges(blocks)
    anchors = shared(blocks, lambda r: Passages(r["payload"], window).anchors()[1], ranges)
    blocks = with_answers(blocks, anchors, "anchors")
    windows = shared(blocks, lambda r: Passages(r["payload"], window).repeated(r, ranges)[1], ranges)
    blocks = with_answers(blocks, windows, "windows")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows(batches):
            found = Passages(row["payload"], window)
            at, keys = found.repeated(row, ranges)
            gone = covered(at[flags(keys, row["windows"], ranges)], window, len(found.words))
            texts = kept_texts(found.words, ~gone)
            removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[found.words.bounds])
            yield pa.RecordBatch.from_arrays(
                [
                    struct_of(found.table),
                    pa.array([t.decode() for t in texts], pa.string()),
                    pa.array(found.words.counts, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
                ],
                ["doc", "kept_text", "n_words", "n_removed", "kept_sha256"],
            )

    schema = T.StructType(
        [
            T.StructField("doc", docs.schema),
            *(T.StructField(n, t) for n, t in zip(("kept_text", "n_words", "n_removed", "kept_sha256"), (T.StringType(), T.LongType(), T.LongType(), T.StringType()), strict=True)),
        ]
    )
    return blocks.mapInArrow(remove, schema)


def kept_texts(words: Words, kept: np.ndarray) -> list[bytes]:
    """The kept words of each row, joined by one space."""
    start, end = words.start[kept], words.end[kept]
    lengths = end - start + 1  # and one space after each
    to = np.concatenate([[0], np.cumsum(lengths)])
    source = np.repeat(start - to[:-1], lengths) + np.arange(to[-1])
    out = np.append(words.data, np.uint8(0x20))[np.minimum(source, len(words.data))]
    out[to[1:] - 1] = 0x20
    whole = out.tobytes()
    bounds = to[np.concatenate([[0], np.cumsum(kept)])[words.bounds]]
    return [whole[a : max(a, b - 1)] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


def with_kept_text(found: DataFrame, columns: list[str]) -> DataFrame:
    """The documents with their kept text in place of the text."""
    return found.select(*(F.col("kept_text").alias("text") if c == "text" else F.col("doc").getField(c).alias(c) for c in columns))
