"""Near-duplicate vectors by an epsilon grid order join.

Unit vectors are turned onto their principal axes; similar ones are at most epsilon apart. Rows are sorted by the grid
cells, of side epsilon, on the leading axes and cut into blocks of the sequence. Blocks meet if a cell of one is in
reach of the other and their boxes are at most epsilon apart; a pair of blocks is joined by halving both sequences and
skipping halves whose boxes are farther apart. What is left is compared by cosine in double precision.

Equal vectors are one point with a weight, so copies are not expanded into pairs. Each block pair returns link counts
and a star of its connected points, not its links.

Defined results: null, empty and zero vectors, and vectors with a null or non-finite component, link with nothing;
shorter vectors count as filled with zeros; rows with the same or a null id are vectors of their own; the id of a group
is its smallest id that is not null, and a row without one is kept if it is in no group. Extra columns are not read. An
empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hemicycle.llm.components import components
from hemicycle.llm.storage import cut

#: Rows of a block, and of the sequences that are compared whole.
BLOCK, LEAF = 4096, 128
#: Leading axes whose cells give the order, and those whose cells blocks meet over.
ORDERED, MET = 4, 3
#: Added to squared distances when skipping, for rounding.
SLACK = 1e-9


def is_valid(name: str) -> Column:
    vector = F.col(name)
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of vectors, filled with zeros up to the width."""
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
    lengths = np.diff(offsets)
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = values
    return out


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True, initial=0)  # so that squares neither vanish nor overflow
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def principal_axes(points: DataFrame, width: int) -> np.ndarray:
    """Axes by falling variance, from second moments summed over all vectors: width * width numbers for the driver."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 1, width + 1))
        for batch in batches:
            x = unit(matrix(batch.column("vector"), width))
            x = np.concatenate([np.ones((len(x), 1)), x], axis=1)
            total += x.T @ x
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(total.ravel())], ["i", "j", "v"])

    moments = np.zeros((width + 1, width + 1))
    for r in points.select("vector").mapInArrow(sums, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        moments[r.i, r.j] = r.v
    n = max(moments[0, 0], 1)
    mean = moments[0, 1:] / n
    _, axes = np.linalg.eigh(moments[1:, 1:] / n - np.outer(mean, mean))
    return axes[:, ::-1].copy()


def gaps(low_a: np.ndarray, high_a: np.ndarray, low_b: np.ndarray, high_b: np.ndarray) -> np.ndarray:
    """Squared distance of boxes."""
    gap = np.maximum(0, np.maximum(low_a - high_b, low_b - high_a))
    return (gap * gap).sum(axis=-1)


class Sequence:
    """The rows of a block in grid order, and the boxes of their parts."""

    def __init__(self, payload: bytes, width: int, axes: np.ndarray):
        n = len(payload) // (8 * (width + 2))
        self.nodes = np.frombuffer(payload, np.int64, n)
        self.copies = np.frombuffer(payload, np.int64, n, 8 * n)
        self.units = unit(np.frombuffer(payload, np.float64, offset=16 * n).reshape(n, width))
        turned = self.units @ axes
        at = np.arange(0, n, LEAF)
        self.low, self.high = np.minimum.reduceat(turned, at), np.maximum.reduceat(turned, at)

    def box(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        return self.low[a:b].min(axis=0), self.high[a:b].max(axis=0)


def join(left: Sequence, right: Sequence, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the left and of the right that are similar; of a sequence with itself each pair once."""
    reach = 2 - 2 * cosine + SLACK
    found: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    todo = [(0, len(left.low), 0, len(right.low))]
    while todo:
        a, b, c, d = todo.pop()
        if left is right and d <= a:
            continue
        if gaps(*left.box(a, b), *right.box(c, d)) > reach:
            continue
        if b - a > 1 or d - c > 1:
            m, k = (a + b + 1) // 2, (c + d + 1) // 2
            todo += [(x, y, u, v) for x, y in ((a, m), (m, b)) for u, v in ((c, k), (k, d)) if x < y and u < v]
            continue
        i, j = np.nonzero(left.units[a * LEAF : b * LEAF] @ right.units[c * LEAF : d * LEAF].T >= cosine)
        i, j = i + a * LEAF, j + c * LEAF
        once = i < j if left is right else np.ones(len(i), bool)
        found.append((i[once], j[once]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def stars(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For linked nodes, the smallest node that each reaches: rows (node, smallest)."""
    nodes, both = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = both[: len(a)], both[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if (new == label).all():
            return np.stack([nodes, nodes[label]])
        label = new


def links(points: DataFrame, cosine: float, width: int) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) that connect what similar pairs connect, and (node, linked): weights of each node's links."""
    axes = principal_axes(points, width)
    side = math.sqrt(2 - 2 * cosine + SLACK) if cosine < 1 else 1e-4
    leading = axes[:, :ORDERED]

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("vector"), width)
            cells = np.floor(unit(x) @ leading / side).astype(np.int64)
            cells = np.pad(cells, ((0, 0), (0, ORDERED - cells.shape[1])))
            rows = [r.tobytes() for r in x]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("copies"), *map(pa.array, cells.T.copy()), pa.array(rows, pa.binary())],
                ["node", "copies", *order, "row"],
            )

    order = [f"c{k}" for k in range(ORDERED)]
    cells = ", ".join(f"{c} long" for c in order)
    located = points.mapInArrow(locate, f"node long, copies long, {cells}, row binary")
    parts = max(1, points.count() // BLOCK)
    located = located.repartitionByRange(parts, *order, "node").sortWithinPartitions(*order, "node")

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def write(table: pa.Table) -> pa.RecordBatch:
            nodes, copies = table.column("node").to_numpy(), table.column("copies").to_numpy()
            x = np.frombuffer(b"".join(table.column("row").to_pylist()), np.float64).reshape(len(nodes), width)
            turned = unit(x) @ axes
            payload = nodes.tobytes() + copies.tobytes() + x.tobytes()
            values = [pa.array([turned.min(axis=0)], pa.list_(pa.float64())), pa.array([turned.max(axis=0)], pa.list_(pa.float64()))]
            return pa.RecordBatch.from_arrays([pa.array([int(nodes[0])]), *values, pa.array([payload], pa.binary())], ["block", "low", "high", "payload"])

        for batch in batches:
            held.append(batch)
            table = pa.Table.from_batches(held).combine_chunks()
            full = table.num_rows // BLOCK * BLOCK
            for at in range(0, full, BLOCK):
                yield write(table.slice(at, BLOCK))
            held = table.slice(full).to_batches()
        if sum(x.num_rows for x in held):
            yield write(pa.Table.from_batches(held).combine_chunks())

    blocks = cut(located.mapInArrow(block, "block long, low array<double>, high array<double>, payload binary"))
    met = min(MET, width)

    def reachable(edge: float) -> DataFrame:
        """A row for each cell of the leading axes that a block's box, widened by ``edge``, has a part in."""
        out = blocks.select("block", "low", "high")
        for k in range(met):
            first, last = F.floor((F.col("low")[k] - edge) / side), F.floor((F.col("high")[k] + edge) / side)
            out = out.withColumn(f"m{k}", F.explode(F.sequence(first, last)))
        return out

    cells = [f"m{k}" for k in range(met)]
    other = reachable(side).select(*cells, F.col("block").alias("other"), F.col("low").alias("low_"), F.col("high").alias("high_"))
    gap = F.zip_with(
        F.zip_with("low", "high_", lambda x, y: x - y), F.zip_with("low_", "high", lambda x, y: x - y), lambda x, y: F.greatest(x, y, F.lit(0.0))
    )
    far = F.aggregate(gap, F.lit(0.0), lambda s, x: s + x * x)
    pairs = reachable(0.0).join(other, cells).where(far <= side * side + SLACK).select("block", "other").distinct()
    # both orders of a pair are there; it is worked on beside its larger or its smaller block, by hash
    larger, smaller = F.greatest("block", "other"), F.least("block", "other")
    mine = F.when(F.pmod(F.xxhash64(larger, smaller), F.lit(2)) == 0, larger).otherwise(smaller)
    pairs = pairs.where(F.col("block") == mine).withColumn("itself", F.col("block") == F.col("other"))
    work = pairs.join(blocks.select(F.col("block").alias("other"), "payload"), "other")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine, left = None, None
        for batch in batches:
            for k in range(batch.num_rows):
                right = Sequence(batch.column("payload")[k].as_py(), width, axes)
                if batch.column("itself")[k].as_py():
                    mine, left = batch.column("block")[k].as_py(), right
                if batch.column("block")[k].as_py() != mine:
                    raise ValueError("a block came before its own rows")
                i, j = join(left, right, cosine)
                a, b = left.nodes[i], right.nodes[j]
                star = stars(a, b)
                counts = [(left.nodes, np.bincount(i, right.copies[j], len(left.nodes))), (right.nodes, np.bincount(j, left.copies[i], len(right.nodes)))]
                node = np.concatenate([star[0], *(n[c > 0] for n, c in counts)])
                root = np.concatenate([star[1], *(n[c > 0] for n, c in counts)])
                weight = np.concatenate([np.zeros(star.shape[1]), *(c[c > 0] for _, c in counts)]).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root), pa.array(weight)], ["a", "b", "linked"])

    work = work.repartition("block").sortWithinPartitions("block", F.desc("itself"))
    found = cut(work.select("block", "itself", "payload").mapInArrow(compare, "a long, b long, linked long"))
    return found.where("a <> b").select("a", "b"), found.where("linked > 0").groupBy(F.col("a").alias("node")).agg(F.sum("linked").alias("linked"))


def near_vectors(vectors: DataFrame, cosine: float = 0.95) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of (vec_id, embedding)."""
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("vector"))
    rows = rows.withColumn("vector", F.when(is_valid("vector"), F.col("vector")))
    points = rows.where("vector IS NOT NULL").groupBy("vector").agg(F.count("*").alias("copies"), F.min("vec_id").alias("low"))
    points = cut(points.withColumn("node", F.monotonically_increasing_id()))
    width = points.agg(F.max(F.size("vector"))).first()[0] or 1
    edges, weights = links(points, cosine, width)
    found = points.join(components(edges), "node", "left").withColumn("component", F.coalesce("component", "node"))
    lowest = found.groupBy("component").agg(F.min("low").alias("component_id"))
    found = found.join(lowest, "component").join(weights, "node", "left")
    found = found.select("vector", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), "component_id")
    out = rows.join(found, "vector", "left")
    component = F.coalesce("component_id", "vec_id")
    kept = F.coalesce(F.col("vec_id") == component, F.col("component_id").isNull())
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), kept.alias("kept"))
