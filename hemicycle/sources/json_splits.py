"""Large JSON files read in parallel: byte ranges of a file, their effect on depth and strings, and the elements cut from them.

A file is read as text that ends at every ``}``, which Spark splits by byte range like any lines; a task has the rows of a
range in file order. A pass over them works out what a range changes, for both states in which it may begin: whether a string
is open, how deep braces and brackets are, and which list is open where it ends. That is one row a range; these are summed in
file order, so every range learns the state it begins in. A second pass cuts the elements, which end where their closing brace
does; only those that lie in several ranges, two a range at most, are joined over ranges. Both passes are Arrow functions
over a few thousand rows at a time: they find all quotes, braces and brackets at once, so no sign is a row of its own.

A quote after an odd number of backslashes is escaped; ``}`` is never escaped in JSON, so no row ends within an escape. Lists
at most two keys below the root can be cut; a key that holds ``}`` is not known. What lies outside the lists that are asked
for comes back as one text a file, the list empty in it.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator, Sequence
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hemicycle.session import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of the package

RANGE = ["path", "block"]
SIGNS = b'"{}[]\\'
QUOTE, BRACE, UNBRACE, BRACKET, UNBRACKET, BACKSLASH = range(1, 7)
KIND = np.zeros(256, np.uint8)
KIND[np.frombuffer(SIGNS, np.uint8)] = range(1, 7)

_LIST = pa.struct([("pos", pa.int64()), ("b", pa.int64()), ("key", pa.string()), ("parent", pa.string())])
_OPENED = pa.list_(pa.struct([("b", pa.int64()), ("name", pa.string())]))
_EFFECT = pa.struct([("braces", pa.int64()), ("brackets", pa.int64()), ("low", pa.int64()), ("list", _LIST), ("opened", _OPENED)])
_EFFECTS = pa.schema(
    [("path", pa.string()), ("block", pa.int64()), ("size", pa.int64()), ("bytes", pa.int64()), ("odd", pa.int64()), ("if0", _EFFECT), ("if1", _EFFECT)]
)
_EFFECT_SQL = "struct<braces: long, brackets: long, low: long, list: struct<pos: long, b: long, key: string, parent: string>, opened: array<struct<b: long, name: string>>>"
_EFFECTS_SQL = f"path string, block long, size long, bytes long, odd long, if0 {_EFFECT_SQL}, if1 {_EFFECT_SQL}"
_PIECES_SQL = (
    "path string, block long, from_block long, from_pos long, keys array<string>, n long, text string, "
    "closed boolean, continued boolean, opens boolean, whole boolean"
)


def before(*keys: str, by: Sequence[str]):
    return Window.partitionBy(*keys).orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)


def total(value: Column, window) -> Column:
    return F.coalesce(F.sum(value).over(window), F.lit(0))


def fragments(spark: SparkSession, root: str, name: str) -> DataFrame:
    """(path, block, size, text): what lies between closing braces, in file order within a range."""
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", name).option("lineSep", "}")
    meta = [F.col(f"_metadata.{m}").alias(a) for m, a in (("file_path", "path"), ("file_block_start", "block"), ("file_size", "size"))]
    return reader.text(root).select(*meta, F.col("value").alias("text"))


def _with_effects(rows: DataFrame) -> DataFrame:
    """Fragments with all their signs that change the depth: the brace that ends one is put back. The last of a file may lack it there."""
    return rows.withColumn("text", F.concat("text", F.lit("}")).cast("binary"))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, np.ndarray, bool]]:
    """The columns of a range but its text, some of its text, and whether that is the last of it."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [n for n in batch.schema.names if n != "text"]
        change = np.zeros(batch.num_rows - 1, bool)
        for n in columns:
            change |= pc.not_equal(batch.column(n)[1:], batch.column(n)[:-1]).to_numpy(zero_copy_only=False)
        text = batch.column("text").cast(pa.large_binary())
        _, offsets, data = text.buffers()
        at = np.frombuffer(offsets, np.int64)[text.offset : text.offset + len(text) + 1]
        data = np.frombuffer(data, np.uint8)
        for a, z in pairwise([0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]):
            row = {n: batch.column(n)[a].as_py() for n in columns}
            if held is not None:
                yield *held, held[0] != row
            held = row, data[at[a] : at[z]]
    if held is not None:
        yield *held, True


class Signs:
    """Quotes that are not escaped, braces and brackets of a text: where they are, and whether an odd number of quotes of the range stands before."""

    def __init__(self, data: np.ndarray, odd: int):
        kind = KIND[data]
        at = np.flatnonzero(kind)
        kind = kind[at]
        slash = kind == BACKSLASH
        if slash.any():
            where = at[slash]
            ends = np.append(where[1:] != where[:-1] + 1, True)
            length = np.diff(np.append(-1, np.flatnonzero(ends)))
            keep = ~slash & ~((kind == QUOTE) & np.isin(at, where[ends][length % 2 == 1] + 1))
            at, kind = at[keep], kind[keep]
        self.data, self.at, self.kind = data, at, kind
        quotes = kind == QUOTE
        so_far = np.cumsum(quotes) + odd
        self.odd = (so_far - quotes) & 1
        self.odd_after = int(so_far[-1]) & 1 if len(so_far) else odd

    def outside(self, state: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Which signs are braces and brackets outside strings if the range begins so, their kinds, and what they add to both depths."""
        at = np.flatnonzero((self.odd == state) & (self.kind != QUOTE))
        kind = self.kind[at]
        steps = [(kind == up).astype(np.int64) - (kind == down) for up, down in ((BRACE, UNBRACE), (BRACKET, UNBRACKET))]
        return at, kind, *steps

    def key(self, i: int) -> str | None:
        """The key whose value begins at a sign."""
        if i < 2 or self.kind[i - 1] != QUOTE or self.kind[i - 2] != QUOTE or self.data[self.at[i - 1] + 1 : self.at[i]].tobytes().strip() != b":":
            return None
        return self.data[self.at[i - 2] + 1 : self.at[i - 1]].tobytes().decode(errors="replace")


class Effect:
    """What a range changes if it begins outside a string (0) or in one (1).

    Where its brackets are least deep it is outside of all lists, or else within one throughout. Of that depth the last list
    opened there is kept, and the last key of an object for each depth of braces; all depths count from the range's begin.
    """

    def __init__(self, state: int):
        self.state, self.b, self.k, self.low, self.list, self.opened = state, 0, 0, 0, None, {}

    def add(self, signs: Signs, base: int) -> None:
        at, kind, db, dk = signs.outside(self.state)
        if not len(at):
            return
        k, b = self.k + np.cumsum(dk), self.b + np.cumsum(db)
        low = int(k.min())
        if low < self.low:
            self.low, self.list, self.opened = low, None, {}
        least = (k - dk) == self.low
        lists, objects = np.flatnonzero(least & (kind == BRACKET)), np.flatnonzero(least & (kind == BRACE))
        if len(lists):
            last = int(lists[-1])
            above = int(b[last]) - 1
            near = objects[: np.searchsorted(objects, last)]
            near = near[b[near] - 1 == above]
            parent = signs.key(at[near[-1]]) if len(near) else self.opened.get(above)
            self.list = {"pos": base + int(signs.at[at[last]]), "b": above + 1, "key": signs.key(at[last]), "parent": parent}
        depth, last = np.unique(b[objects][::-1] - 1, return_index=True)
        self.opened |= {d: signs.key(at[objects[len(objects) - 1 - i]]) for d, i in zip(depth.tolist(), last.tolist(), strict=True)}
        self.k, self.b = int(k[-1]), int(b[-1])

    def row(self) -> dict:
        opened = [{"b": b, "name": name} for b, name in self.opened.items()]
        return {"braces": self.b, "brackets": self.k, "low": self.low, "list": self.list, "opened": opened}


def _effects_of_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a range: its bytes, whether its quotes are odd, and its effect for either state."""
    states, base, odd = (Effect(0), Effect(1)), 0, 0
    for row, data, last in _chunks(batches):
        signs = Signs(data, odd)
        for state in states:
            state.add(signs, base)
        base, odd = base + len(data), signs.odd_after
        if last:
            row |= {"bytes": base, "odd": odd, "if0": states[0].row(), "if1": states[1].row()}
            yield pa.RecordBatch.from_pylist([row], schema=_EFFECTS)
            states, base, odd = (Effect(0), Effect(1)), 0, 0


def _range_states(rows: DataFrame) -> DataFrame:
    """(path, block, inside, b0, k0, up, open, cut_short, whole): the state in which a range begins, the last key of an object
    in the root before it and the outermost list that was opened last before it, whether its last fragment ends the file without a
    brace, and whether the file ends outside of all.
    """
    so_far, file = before("path", by=["block"]), Window.partitionBy("path")
    ranges = rows.mapInArrow(_effects_of_ranges, _EFFECTS_SQL)
    ranges = ranges.withColumn("inside", total(F.col("odd"), so_far) % 2)
    ranges = ranges.withColumn("own", F.when(F.col("inside") == 0, F.col("if0")).otherwise(F.col("if1"))).drop("if0", "if1")
    ranges = ranges.withColumn("b0", total(F.col("own.braces"), so_far)).withColumn("k0", total(F.col("own.brackets"), so_far))
    bare = F.col("own.low") == -F.col("k0")
    named = F.filter("own.opened", lambda o: (o["b"] == 1 - F.col("b0")) & o["name"].isNotNull())
    ranges = ranges.withColumn("up", F.last(F.when(bare, F.get(named, F.lit(0))["name"]), True).over(so_far))
    at = F.col("own.list")
    begun = F.struct("block", at["pos"].alias("pos"), (at["b"] + F.col("b0")).alias("b"), at["key"].alias("key"), F.coalesce(at["parent"], "up").alias("parent"))
    ranges = ranges.withColumn("open", F.last(F.when(bare & at.isNotNull(), begun), True).over(so_far))
    ranges = ranges.withColumn("short", F.sum("bytes").over(file) > F.col("size"))
    end = [F.sum(c).over(file) for c in ("own.braces", "own.brackets", "odd")]
    closed = (end[0] + F.when(F.col("short"), 1).otherwise(0) == 0) & (end[1] == 0) & (end[2] % 2 == 0)
    final = F.lead("block").over(Window.partitionBy("path").orderBy("block")).isNull()
    return ranges.select(*RANGE, "inside", "b0", "k0", "up", "open", (F.col("short") & final).alias("cut_short"), closed.alias("whole"))


class Cutter:
    """A range cut into pieces of the wanted lists and what lies outside of them."""

    def __init__(self, row: dict, wanted: set[tuple[str, ...]]):
        self.row, self.wanted, self.depths = row, wanted, sorted({len(keys) for keys in wanted})
        self.b, self.k, self.odd, self.base, self.up = row["b0"], row["k0"], 0, 0, row.get("up")
        self.list, self.pending, self.rest, self.n = None, [], [], 0
        was = row.get("open")
        if was is not None and self.k > 0:
            self.begin(was["block"], was["pos"], was["b"], was.get("key"), was.get("parent"))

    def begin(self, block: int, pos: int, b: int, key: str | None, parent: str | None) -> bool:
        """Enters a list if it is wanted."""
        keys = {0: (), 1: (key,), 2: (parent, key)}.get(b)
        if keys in self.wanted:
            self.list, self.n = (block, pos, b, keys), 0
        return self.list is not None

    def pieces(self, texts: pa.Array, closed: bool) -> pa.RecordBatch:
        count, (block, pos, _, keys) = len(texts), self.list
        first = np.arange(self.n, self.n + count) == 0
        here = block == self.row["block"]
        own = [self.row["path"], self.row["block"], block, pos]
        columns = [pa.array([x] * count) for x in own]
        columns += [pa.array([list(keys)] * count, pa.list_(pa.string())), pa.array(np.arange(self.n, self.n + count)), texts]
        columns += [pa.array(x) for x in (np.full(count, closed), first & (not here), first & here, np.full(count, self.row["whole"]))]
        self.n += count
        return self.batch(columns)

    def batch(self, columns: list[pa.Array]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _PIECES_SQL.split(", ")])

    def within(self, data: np.ndarray, start: int, end: int, cuts: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Some text of a list, and where elements end in it."""
        if len(cuts) and self.pending:
            text = b"".join([*self.pending, data[start : cuts[0]].tobytes()])
            yield self.pieces(text_array(np.frombuffer(text, np.uint8), np.array([0, len(text)])), True)
            self.pending, start, cuts = [], int(cuts[0]), cuts[1:]
        if len(cuts):
            yield self.pieces(text_array(data, np.append(start, cuts)), True)
            start = int(cuts[-1])
        if start < end:
            self.pending.append(data[start:end].tobytes())

    def left_open(self) -> Iterator[pa.RecordBatch]:
        """What no element's end follows, in the list or the range."""
        if self.pending:
            text = b"".join(self.pending)
            yield self.pieces(text_array(np.frombuffer(text, np.uint8), np.array([0, len(text)])), False)
        self.pending = []

    def add(self, data: np.ndarray) -> Iterator[pa.RecordBatch]:
        signs = Signs(data, self.odd)
        at, kind, db, dk = signs.outside(self.row["inside"])
        k, b, place = self.k + np.cumsum(dk), self.b + np.cumsum(db), signs.at[at]
        bare = (k - dk) == 0
        begins = np.flatnonzero(bare & (kind == BRACKET) & np.isin(b, self.depths))
        ends = np.flatnonzero((k == 0) & (kind == UNBRACKET))
        objects = np.flatnonzero(bare & (kind == BRACE) & (b == 2))
        done = np.flatnonzero((kind == UNBRACE) & (k == 1))
        start, sign = 0, 0
        while True:
            if self.list is not None:
                i = np.searchsorted(ends, sign)
                last = int(ends[i]) if i < len(ends) else len(at)
                end = int(place[last]) if i < len(ends) else len(data)
                own = done[np.searchsorted(done, sign) : np.searchsorted(done, last)]
                yield from self.within(data, start, end, place[own[b[own] == self.list[2]]] + 1)
                if last == len(at):
                    break
                yield from self.left_open()
                self.list, start, sign = None, end, last + 1
            for i in begins[np.searchsorted(begins, sign) :].tolist():
                near = objects[: np.searchsorted(objects, i)].tolist()
                parent = next((x for j in reversed(near) if (x := signs.key(at[j])) is not None), self.up) if b[i] == 2 else None
                if self.begin(self.row["block"], self.base + int(place[i]), int(b[i]), signs.key(at[i]), parent):
                    end = int(place[i]) + 1
                    self.rest.append(data[start:end].tobytes())
                    start, sign = end, i + 1
                    break
            else:
                self.rest.append(data[start:].tobytes())
                break
        self.up = next((x for j in reversed(objects.tolist()) if (x := signs.key(at[j])) is not None), self.up)
        self.base, self.odd = self.base + len(data), signs.odd_after
        if len(at):
            self.k, self.b = int(k[-1]), int(b[-1])

    def end(self) -> Iterator[pa.RecordBatch]:
        yield from self.left_open()
        text, none = b"".join(self.rest), pa.array([None], pa.int64())
        flag = pa.array([None], pa.bool_())
        texts = text_array(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
        columns = [pa.array([self.row["path"]]), pa.array([self.row["block"]]), none, none, pa.array([None], pa.list_(pa.string())), none, texts]
        yield self.batch([*columns, flag, flag, flag, pa.array([self.row["whole"]])])


def text_array(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Texts that stand one after the other in a buffer."""
    start = int(offsets[0])
    buffers = [None, pa.py_buffer((offsets - start).astype(np.int32)), pa.py_buffer(data[start : offsets[-1]])]
    return pa.Array.from_buffers(pa.string(), len(offsets) - 1, buffers)


def _tokens(rows: DataFrame, states: DataFrame, lists: Sequence[Sequence[str]] = ((),)) -> DataFrame:
    """(path, block, from_block, from_pos, keys, n, text, closed, continued, opens, whole): ranges cut where elements of the named lists end.

    `from_block` and `from_pos` say where the list begins, and are null for what lies outside of all, one row a range; `n`
    numbers the pieces of a list in a range.
    """
    wanted = {tuple(keys) for keys in lists}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for row, data, last in _chunks(batches):
            now = now or Cutter(json.loads(row["state"]), wanted)
            yield from now.add(data[:-1] if last and now.row["cut_short"] else data)
            if last:
                yield from now.end()
                now = None

    # the join keeps rows in their order, as the smaller side, one row a range, is sent to all
    states = states.select(*RANGE, F.to_json(F.struct("*")).alias("state"))
    return rows.select(*RANGE, "text").join(F.broadcast(states), RANGE).select("state", "text").mapInArrow(cut, _PIECES_SQL)


def _joined(parts: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(parts), lambda p: p["text"]), "")


def cut_lists(rows: DataFrame, lists: Sequence[Sequence[str]]) -> tuple[DataFrame, DataFrame]:
    """From fragments, the elements of the named lists and the rest of each file.

    The first frame is (path, keys, text): a text of one element that is an object, with what else stands between it and
    the element before, or of the others at the end of a list. The second is (path, text, whole), one row a file; `whole`
    is false where a file ends within a string, list or object.
    """
    rows = _with_effects(rows)
    pieces = written(_tokens(rows, _range_states(rows), lists))
    rest = pieces.where("from_block IS NULL").groupBy("path").agg(_joined(F.collect_list(F.struct("block", "text"))).alias("text"), F.min("whole").alias("whole"))
    alone = pieces.where("closed AND NOT continued").select("path", "keys", "text", "opens")
    parted = pieces.where("continued OR NOT closed").withColumn("chain", total(F.col("closed").cast("int"), before("path", "from_block", "from_pos", by=["block", "n"])))
    parted = parted.groupBy("path", "from_block", "from_pos", "keys", "chain").agg(
        _joined(F.collect_list(F.struct("block", "n", "text"))).alias("text"), F.max("opens").alias("opens")
    )
    elements = alone.unionByName(parted.select("path", "keys", "text", "opens"))
    # after the first element of a list, a comma stands before each; text that lacks it is made no JSON
    after = F.regexp_replace("text", r"^\s*,", "")
    proper = F.col("text").rlike(r"^\s*,") & after.rlike(r"\S")
    text = F.when(F.col("opens"), F.col("text")).when(proper, after).otherwise(F.concat(F.lit("!"), "text"))
    elements = elements.where(F.col("text").rlike(r"\S")).select("path", "keys", text.alias("text"))
    return elements, rest
