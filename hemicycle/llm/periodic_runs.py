"""Periodic runs of words, found online by catchers over dyadic blocks.

A run is a stretch of words with smallest period q (words q apart are the same), of at least ``least`` words and ``times``
periods, that no neighbouring word extends. Words are appended in turn. For every power of two L, each completed block of
L words that starts at a multiple of L has a catcher: for the L words to come it waits for the block to occur again, at a
distance of L to 2 * L - 1. At each appended word just one catcher of a size is waiting, so a step is one comparison of
names, taken for many words at once. Two neighbouring blocks caught at one distance q are a square in the making: the
words before and after are compared with those q away, one by one, and what is the same merges into one stretch,
which goes on growing with the words that follow. Names are hashes that only point at candidates; a stretch is found
by comparing words, and where names mislead all words at that distance are compared.

A run of ``times`` >= 4 periods holds two neighbouring blocks and their next occurrence wherever the blocks lie. A stretch
with a multiple of its smallest period is the same stretch; it is passed over where it lies in a known one.

Defined results: null and empty texts have no words and no runs; rows with the same id, null ids and repeated rows are
documents of their own; equally long runs are ordered by start, then period; extra columns are not read. Runs never
cross documents. An empty table gives an empty result. A text is held whole by one task, with memory in proportion to it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hemicycle.llm.hashing import U64, Words, mix
from hemicycle.llm.storage import slices, text_bytes
from hemicycle.llm.substring_dedup import kept_texts

#: Least number of words of a run, and of its periods. The catchers find all runs of 4 periods or more.
LEAST, TIMES = 6, 4
#: Words appended together.
STEP = 1 << 18


def names_of(words: np.ndarray) -> np.ndarray:
    return mix(words.astype(U64))


def names_of_pairs(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(left * U64(0x9E3779B97F4A7C15) + right)


class Catchers:
    """Stretches of a growing sequence of whole numbers. ``longest`` bounds the length of runs that are looked for."""

    def __init__(self, longest: int | None = None):
        self.longest = longest
        self.words = np.zeros(0, np.int64)
        self.names: list[tuple[int, np.ndarray]] = []  # by size: first start that is kept, and the names from it on
        self.found: dict[tuple[int, int], int] = {}  # (start, period): end
        self.open: set[tuple[int, int]] = set()  # those that reach the last word
        self.misled: set[int] = set()  # periods at which names of other words agreed
        self.reach, self.period = np.zeros(0, np.int64), np.ones(0, np.int64)  # furthest end of a stretch over a word

    def append(self, words: np.ndarray) -> None:
        before = len(self.words)
        self.words = np.concatenate([self.words, words.astype(np.int64)])
        self.reach = np.concatenate([self.reach, np.zeros(len(words), np.int64)])
        self.period = np.concatenate([self.period, np.ones(len(words), np.int64)])
        for start, q in sorted(self.open):
            self.open.discard((start, q))
            self._keep(start, before + self._ahead(before - q, before), q)
        level, size = 0, 1
        while TIMES * size <= min(len(self.words), self.longest or len(self.words)):
            self._advance(level, size)
            level, size = level + 1, 2 * size
        for q in self.misled:
            for a, z in self._stretches(q):
                self._keep(a, z, q)
        # a later step compares windows with blocks up to four sizes before them, and a new size builds on all names of the last
        for level, (base, names) in enumerate(self.names):
            keep = max(base, (len(self.words) >> level) - 10 << level)
            self.names[level] = (keep, names[keep - base :])

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, length, period) of the runs so far, by start and period."""
        least: dict[tuple[int, int], int] = {}
        for (start, q), end in self.found.items():
            if end - start >= max(LEAST, TIMES * q):
                least[start, end] = min(q, least.get((start, end), q))
        return sorted((start, end - start, q) for (start, end), q in least.items())

    def _advance(self, level: int, size: int) -> None:
        """Names the new blocks and windows of a size and looks whether their catchers meet them."""
        n = len(self.words)
        if level == len(self.names):
            self.names.append((0, np.zeros(0, U64)))
        base, names = self.names[level]
        new = base + len(names)
        if level == 0:
            fresh = names_of(self.words[new:])
        else:
            below, parts = self.names[level - 1]
            parts = parts[new - below :]
            fresh = names_of_pairs(parts[: n - size + 1 - new], parts[size // 2 :][: n - size + 1 - new])
        names = np.concatenate([names, fresh])
        low = max(new - 2 * size, base + size)
        at = np.arange(low, n - size + 1)
        if len(at):
            caught = names[at - base] == names[(at // size - 1) * size - base]
            once = lambda k: np.append(np.zeros(min(k, len(at)), bool), caught[: max(0, len(at) - k)])
            pair = caught & once(size) & ~once(2 * size)
            pair &= at >= max(new, 2 * size)
            self._squares(at[pair], size)
        self.names[level] = (base, names)

    def _known(self, first, at, size: int, q):
        """Whether the words of two caught blocks lie in a stretch that is known, with a period that divides q."""
        return (self.reach[first] >= at + size) & (q % self.period[first] == 0)

    def _squares(self, at: np.ndarray, size: int) -> None:
        first = (at // size - 2) * size
        q = at - first - size
        fresh = ~self._known(first, at, size, q)
        for a, b, c in zip(first[fresh].tolist(), at[fresh].tolist(), q[fresh].tolist(), strict=True):
            if not self._known(a, b, size, c):
                self._square(a, b + size, c)

    def _square(self, start: int, end: int, q: int) -> None:
        if (start, q) in self.found and self.found[start, q] >= end:
            return
        if not np.array_equal(self.words[start : end - q], self.words[start + q : end]):
            self.misled.add(q)
            return
        start -= self._behind(start, start + q)
        self._keep(start, end + self._ahead(end - q, end), q)

    def _keep(self, start: int, end: int, q: int) -> None:
        self.found[start, q] = end
        if end == len(self.words):
            self.open.add((start, q))
        part = slice(start, end)
        further = self.reach[part] < end
        self.reach[part][further], self.period[part][further] = end, q

    def _ahead(self, a: int, b: int) -> int:
        """How many words from b on are the same as those from a on."""
        n, step = 0, 64
        while b + n < len(self.words):
            m = min(step, len(self.words) - b - n)
            other = self.words[a + n : a + n + m] != self.words[b + n : b + n + m]
            if other.any():
                return n + int(other.argmax())
            n, step = n + m, 2 * step
        return n

    def _behind(self, a: int, b: int) -> int:
        """How many words before b are the same as those before a."""
        n, step = 0, 64
        while a - n > 0:
            m = min(step, a - n)
            other = self.words[a - n - m : a - n] != self.words[b - n - m : b - n]
            if other.any():
                return n + int(other[::-1].argmax())
            n, step = n + m, 2 * step
        return n

    def _stretches(self, q: int) -> list[tuple[int, int]]:
        same = np.concatenate([[False], self.words[:-q] == self.words[q:], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1]).reshape(-1, 2)
        return [(int(a), int(z) + q) for a, z in edges]


def word_numbers(words: Words) -> np.ndarray:
    """A number for each word, the same for the same words."""
    lengths = words.end - words.start
    data = words.data[np.repeat(words.start - np.append(0, np.cumsum(lengths)[:-1]), lengths) + np.arange(lengths.sum())]
    ends = np.append(0, np.cumsum(lengths)).astype(np.int64)
    column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer(ends), pa.py_buffer(data)])
    return column.dictionary_encode().indices.to_numpy().astype(np.int64)


def runs_of(words: Words, step: int = STEP) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of all rows, by place among the words of the block; none crosses a row."""
    counts = words.counts
    if counts.max(initial=0) < LEAST:
        return []
    row = words.row()
    # between rows stands a number that occurs nowhere else
    whole = np.zeros(len(words) + len(counts), np.int64)
    ends = words.bounds[1:] + np.arange(len(counts))
    whole[ends] = -1 - np.arange(len(counts))
    whole[np.arange(len(words)) + row] = word_numbers(words)
    catchers = Catchers(int(counts.max()))
    for at in range(0, len(whole), step):
        catchers.append(whole[at : at + step])
    place = lambda start: start - int(np.searchsorted(ends, start))
    return [(place(a), n, q) for a, n, q in catchers.runs()]


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def find_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row: runs by start and period as (start, length, period), words from 0,
    and the text without the words that a run holds after its first period, joined by one space.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in slices(batches):
            words = Words(*text_bytes(table.column("text")))
            runs = runs_of(words)
            start, length, period = (np.array(x, np.int64) for x in zip(*runs, strict=True)) if runs else [np.zeros(0, np.int64)] * 3
            steps = np.zeros(len(words) + 1, np.int64)
            np.add.at(steps, start + period, 1)
            np.add.at(steps, start + length, -1)
            collapsed = kept_texts(words, np.cumsum(steps[:-1]) == 0)
            at = np.searchsorted(start, words.bounds)
            of = np.searchsorted(words.bounds, start, "right") - 1
            found = pa.StructArray.from_arrays([pa.array(start - words.bounds[of]), pa.array(length), pa.array(period)], fields=list(RUN))
            yield pa.RecordBatch.from_arrays(
                [
                    table.column("doc_id").combine_chunks(), pa.array(words.counts, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(at, pa.int32()), found), pa.array([t.decode() for t in collapsed], pa.string()),
                ],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")
