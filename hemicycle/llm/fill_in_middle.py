"""Fill-in-the-middle texts, assembled by a secondary sort of pieces.

A text is cut into units: runs of the letters A-Z and a-z, and any other character by itself. Two places among the units
part it into prefix, middle and suffix, which are written after the marks ``<P>``, ``<M>`` and ``<S>``: prefix, suffix,
middle (psm) or suffix, prefix, middle (spm). Places and form follow from a digest of the id; a text that is empty or
holds a mark stays plain, as does a share of all others.

Map tasks emit the parts as pieces of whole units, keyed by document and output position. One shuffle by document with a
sort by document and position in each partition (the data frame's repartition and sort within partitions) brings the
pieces of a document together in order, so they stream into its digest and no task holds a document. To restore the
texts, the sections of the output are told by their marks, the pieces get their position in the text, and the same
partitions are sorted again, without a second shuffle.

Defined results: null and empty texts have no units and stay plain; a null id is an empty one in the digest; rows with
the same id and repeated rows are documents of their own, with the same places; a unit that is longer than a piece is
cut; ties cannot arise, as a document's positions differ. Documents are numbered by their place in the input's
partitions, so an input whose rows may come in another order when read again must be written before. Extra columns are
not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hemicycle.llm.storage import slices, text_bytes

PREFIX, SUFFIX, MIDDLE = MARKS = (b"<P>", b"<S>", b"<M>")
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Of 100 texts those that may change, and of 100 changed ones those with the suffix first.
CHANGED, SUFFIX_FIRST = 90, 20
#: Bytes of a piece at most.
PIECE = 8 << 10

_codes = np.arange(256)
LETTER = ((_codes >= ord("A")) & (_codes <= ord("Z"))) | ((_codes >= ord("a")) & (_codes <= ord("z")))

HEAD = "struct<doc_id: long, n: long, form: string, prefix_chars: long, middle_chars: long>"
HEAD_TYPE = pa.struct([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64())])
PIECES = f"rid long, position long, head {HEAD}, piece binary"
ROWS = 2048


def draws(doc_id: int | None) -> list[int]:
    """Four numbers of 32 bits from an id."""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4)]


class Units:
    """Where the units of the texts of a block start."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        letter = LETTER[data]
        after = np.append(False, letter[:-1]) if len(data) else letter
        after[offsets[:-1][np.diff(offsets) > 0]] = False
        character = (data & 0xC0) != 0x80
        self.start = np.flatnonzero(character & ~(letter & after))
        self.bounds = np.searchsorted(self.start, offsets)  # the units of row i are bounds[i] to bounds[i + 1]
        self.characters = np.append(0, np.cumsum(character))
        self.end = offsets[1:]

    def place(self, row: int, unit: int) -> int:
        """The byte at which a unit of a row starts, or the row ends."""
        at = self.bounds[row] + unit
        return int(self.start[at] if at < self.bounds[row + 1] else self.end[row])

    def cuts(self, a: int, z: int) -> list[int]:
        """Places that part the bytes from a to z into pieces, at units where a unit fits."""
        out = [a]
        while z - out[-1] > PIECE:
            at = int(self.start[np.searchsorted(self.start, out[-1] + PIECE, "right") - 1])
            out.append(at if at > out[-1] else out[-1] + PIECE)
        return [*out, z]


def arranged(units: Units, text: bytes, row: int, doc_id: int | None) -> tuple[dict, list[tuple[bytes, int, int]]]:
    """The head of a document, and the parts of its output: a mark and the bytes from a place of the block to another."""
    h1, h2, h3, h4 = draws(doc_id)
    n = int(units.bounds[row + 1] - units.bounds[row])
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    start, end = units.place(row, 0), int(units.end[row])
    head = {"doc_id": doc_id, "n": n, "form": PLAIN, "prefix_chars": None, "middle_chars": None}
    if not text or any(mark in text for mark in MARKS) or h3 % 100 >= CHANGED:
        return head, [(b"", start, end)]
    a, z = units.place(row, low), units.place(row, high)
    count = lambda x, y: int(units.characters[y] - units.characters[x])
    head |= {"form": SPM if h4 % 100 < SUFFIX_FIRST else PSM, "prefix_chars": count(start, a), "middle_chars": count(a, z)}
    prefix, middle, suffix = (PREFIX, start, a), (MIDDLE, a, z), (SUFFIX, z, end)
    return head, [suffix, prefix, middle] if head["form"] == SPM else [prefix, suffix, middle]


def batch_of(rows: list[tuple], types: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)


PIECE_TYPES, PIECE_NAMES = [pa.int64(), pa.int64(), HEAD_TYPE, pa.binary()], ["rid", "position", "head", "piece"]


def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of the outputs of all documents; the first of a document has its head."""
    rid, held = TaskContext.get().partitionId() << 40, []
    for table in slices(batches):
        data, offsets = text_bytes(table.column("text"))
        units, whole = Units(data, offsets), data.tobytes()
        for row, doc_id in enumerate(table.column("doc_id").to_pylist()):
            head, parts = arranged(units, whole[offsets[row] : offsets[row + 1]], row, doc_id)
            position = 0
            for mark, a, z in parts:
                for x, y in pairwise(units.cuts(a, z)):
                    held.append((rid, position, head if position == 0 else None, (mark if x == a else b"") + whole[x:y]))
                    position += 1
                    if len(held) >= ROWS:
                        yield batch_of(held, PIECE_TYPES, PIECE_NAMES)
                        held = []
            rid += 1
    if held:
        yield batch_of(held, PIECE_TYPES, PIECE_NAMES)


def assembled(docs: DataFrame) -> DataFrame:
    """(rid, position, head, piece): the pieces of the outputs, those of a document in one partition and in order."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(emit, PIECES).repartition("rid").sortWithinPartitions("rid", "position")


def pieces_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


#: Where the sections of a text lie, by the mark before them.
SECTION = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}
PLACED_TYPES = [pa.int64(), pa.int64(), HEAD_TYPE, pa.string(), pa.binary()]
PLACED_NAMES = ["rid", "place", "head", "output_sha256", "piece"]


def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From pieces in output order: pieces with their place in the text, and after them a document's head and digest."""
    rid = head = None
    digest, section, held = hashlib.sha256(), 0, []
    last = (1 << 62,)
    for own, position, first, piece in pieces_of(batches):
        if own != rid:
            if rid is not None:
                held.append((rid, *last, head, digest.hexdigest(), None))
            rid, head, digest, section = own, first, hashlib.sha256(), 0
        digest.update(piece)
        if head["form"] != PLAIN and piece[:3] in SECTION:  # no text with a mark is changed, so this is the output's own
            section, piece = SECTION[piece[:3]], piece[3:]
        held.append((rid, section << 60 | position, None, None, piece))
        if len(held) >= ROWS:
            yield batch_of(held, PLACED_TYPES, PLACED_NAMES)
            held = []
    if rid is not None:
        held.append((rid, *last, head, digest.hexdigest(), None))
        yield batch_of(held, PLACED_TYPES, PLACED_NAMES)


def restored(pieces: DataFrame) -> DataFrame:
    """(rid, place, head, output_sha256, piece): the pieces of the texts in order, rebuilt from output and form alone.

    After the pieces of a document comes one row with its head and the digest of its output.
    """
    placed = pieces.mapInArrow(place, f"rid long, place long, head {HEAD}, output_sha256 string, piece binary")
    return placed.sortWithinPartitions("rid", "place")


FIELDS = ["doc_id", "n", "form", "prefix_chars", "middle_chars"]
DIGEST_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]


def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    digest, held, names = hashlib.sha256(), [], [*FIELDS, "output_sha256", "restored_sha256"]
    for _, _, head, output, piece in pieces_of(batches):
        if head is None:
            digest.update(piece)
            continue
        held.append((*(head[f] for f in FIELDS), output, digest.hexdigest()))
        digest = hashlib.sha256()
        if len(held) >= ROWS:
            yield batch_of(held, DIGEST_TYPES, names)
            held = []
    if held:
        yield batch_of(held, DIGEST_TYPES, names)


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256) of every row."""
    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
    return restored(assembled(docs)).mapInArrow(finish, schema)


def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rid, head, parts = None, None, []
    out = lambda: batch_of([(*(head[f] for f in FIELDS), b"".join(parts).decode())], [*DIGEST_TYPES[:5], pa.string()], [*FIELDS, "output"])
    for own, _, first, piece in pieces_of(batches):
        if own != rid:
            if rid is not None:
                yield out()
            rid, head, parts = own, first, []
        parts.append(piece)
    if rid is not None:
        yield out()


def texts(docs: DataFrame) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row, the output as one text."""
    return assembled(docs).mapInArrow(join, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")
