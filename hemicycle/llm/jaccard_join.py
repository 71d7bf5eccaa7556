"""Jaccard join of word-shingle sets by group counts.

Shingles are hashed into ``m`` groups. Two sets that are similar enough differ in at most ``d`` shingles, so at least
``m - d`` groups hold the same shingles in both. Documents of which so many groups occur elsewhere meet over the
contents of equal groups, of each the rarest, as a partner must share one of them; those that meet, directly or through
others, form a cluster; the others are similar to nothing. Within a cluster the counts of a set over fixed groups are a point; points are packed into an R-tree whose nodes keep the largest count of each group, and the sum of the smaller
counts bounds the overlap. Only pairs that pass the bound are compared shingle by shingle.

Identical sets are one point. A cluster too large for a task is dealt by set size into pieces, and only pieces whose
sizes can be similar are joined, so no link is lost. Within a piece, documents already connected are not compared
again: the result is the connected groups, not all pairs.

Defined results: null and empty texts, and texts of white space, have no shingles and are a group of their own; fewer
words than a shingle make one shingle; rows with the same or a null id are documents of their own; the id of a group is
its smallest id that is not null; ties in size change nothing. Extra columns travel inside blocks. An empty table
gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hemicycle.llm.components import components
from hemicycle.llm.hashing import LOWER, U64, Words, mix, windows
from hemicycle.llm.shared_keys import n_ranges, rows, shared, times, with_answers
from hemicycle.llm.storage import cut, pack, text_bytes, unpack, whole_groups

#: Ratio of the set sizes at the two ends of a size band, and groups for each shingle that similar sets may differ in.
BAND, SPARE = 1.5, 1.3
#: Upper bytes of a group's key that are counted over the corpus; as many groups must agree, chance ones do no harm.
WIDTH = 6
#: Coordinates of a point, points of a leaf, children of a node.
GROUPS, LEAF, FAN = 64, 16, 8
#: Sets of a piece; a cluster with more is dealt by size.
PIECE = 1024


UPPER = U64((1 << 64) - (1 << 8 * (8 - WIDTH)))


@dataclass(frozen=True)
class Similarity:
    """Sets a and b are similar if 100 * |a & b| >= percent * |a | b|."""

    words: int = 5
    percent: int = 80

    def needed(self, a, b):
        """Least overlap of similar sets of these sizes."""
        return -(-self.percent * (a + b) // (100 + self.percent))

    def differ(self, largest):
        """How many elements at most are in one only of two similar sets of up to this size."""
        return 2 * largest * (100 - self.percent) // (100 + self.percent)

    def bands(self, largest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each size band: its first size, the smallest partner size, and the number of groups.

        A pair belongs to the band of its larger set. Sets of a band without groups are similar only if equal.
        """
        first = [1]
        while first[-1] <= 100 * largest // self.percent:
            first.append(max(first[-1] + 1, int(first[-1] * BAND)))
        least = [-(-self.percent * lo // 100) for lo in first[:-1]]
        differ = [self.differ(hi - 1) for hi in first[1:]]
        return np.array(first), np.array(least), np.array([math.ceil(SPARE * d) + 1 if d else 0 for d in differ])


class Sets:
    """Distinct shingles of each document of a block, as sorted hashes."""

    def __init__(self, payload: bytes, alike: Similarity):
        self.table, self.alike = unpack(payload), alike
        data, offsets = text_bytes(self.table.column("text"))
        words = Words(LOWER[data], offsets)
        values, counts, row = words.hashes(), words.counts, words.row()
        place = np.arange(len(words)) - words.bounds[row]
        length = np.minimum(alike.words, counts)[row]
        at = np.flatnonzero(place + length <= counts[row])
        hashes, length, row = np.zeros(len(at), U64), length[at], row[at]
        for n in range(1, alike.words + 1):
            some = length == n
            if some.any():
                hashes[some] = windows(values, n)[at[some]]
        order = np.lexsort((hashes, row))
        hashes, row = hashes[order], row[order]
        new = np.ones(len(row), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
        self.hashes, self.row = hashes[new], row[new]
        self.sizes = np.bincount(self.row, minlength=self.table.num_rows).astype(np.int64)
        self.bounds = np.concatenate([[0], np.cumsum(self.sizes)])

    def identity(self) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of each set that do not depend on order."""
        out = []
        for seed in (0x51ED2701, 0xA24BAED5):
            sums = np.zeros(len(self.sizes), U64)
            np.add.at(sums, self.row, mix(self.hashes ^ U64(seed)))
            out.append(mix(sums).view(np.int64))
        return out[0], out[1]

    def signatures(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(case, key) and the row of each case: for each document and band the contents of its groups, hashed.

        ``needed`` holds how many of a case's keys must occur elsewhere if the document is similar to another.
        """
        first, least, groups = self.alike.bands(int(self.sizes.max(initial=1)))
        own = np.searchsorted(first, self.sizes, "right") - 1
        found, rows_, needed, cases = [], [], [], 0
        for shift in range(len(least)):  # its own band, and those of larger partners
            band = own + shift
            ok = (self.sizes > 0) & (band < len(least))
            band = np.minimum(band, len(least) - 1)
            ok &= self.sizes >= least[band]
            if not ok.any():
                break
            n = np.where(ok, groups[band], 0)
            base = np.concatenate([[0], np.cumsum(n)])
            inside = n[self.row] > 0
            row, hashes = self.row[inside], self.hashes[inside]
            if not len(row):
                continue
            at = base[row] + (mix(hashes ^ U64(0x7F4A7C15)) % n[row].astype(U64)).astype(np.int64)
            sums = np.zeros(base[-1], U64)
            np.add.at(sums, at, hashes)
            full = np.bincount(at, minlength=base[-1]) > 0
            owner = np.repeat(np.arange(len(n)), n)
            group = np.arange(base[-1]) - base[owner]
            keys = mix(sums ^ mix((band[owner].astype(U64) << U64(32)) | group.astype(U64)))
            must = n - self.alike.differ(first[band + 1] - 1) - np.bincount(owner[~full], minlength=len(n))
            use = full | (must <= 0)[owner]  # all equal groups of a similar pair may be empty
            found.append((owner[use] + cases, keys[use]))
            rows_.append(np.arange(len(n)))
            needed.append(np.maximum(must, 1))
            cases += len(n)
        if not found:
            self.needed = np.zeros(0, np.int64)
            return np.zeros(0, np.int64), np.zeros(0, U64), np.zeros(0, np.int64)
        self.needed = np.concatenate(needed)
        case, keys = (np.concatenate(x) for x in zip(*found, strict=True))
        return case, keys, np.concatenate(rows_)

    def counted(self) -> np.ndarray:
        """The keys as they are counted over the corpus."""
        return self.signatures()[1] & UPPER

    def met(self, answer: list[dict] | None, ranges: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, key) of the keys that occur elsewhere, of the cases with as many as a similar document asks for.

        As two similar documents share so many keys, they share one already among those of each that come first in any order
        of all keys, when so many others are left. The order is by count, so documents meet over their rarest contents.
        """
        case, keys, rows_ = self.signatures()
        if not len(keys):
            return case, keys
        count = times(keys & UPPER, answer, ranges)
        again = count > 1
        passes = np.bincount(case[again], minlength=len(rows_)) >= self.needed
        some = np.flatnonzero(passes[case])
        order = some[np.lexsort((keys[some], count[some], case[some]))]
        held = np.bincount(case[some], minlength=len(rows_))
        place = np.arange(len(order)) - (np.cumsum(held) - held)[case[order]]
        order = order[(place <= (held - self.needed)[case[order]]) & again[order]]
        return rows_[case[order]], keys[order]


class CountTree:
    """Packed R-tree over group counts. Nodes keep the largest count of each group and the range of sizes."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, alike: Similarity):
        self.alike = alike
        slab = max(1, int(math.sqrt(len(sizes) / LEAF))) * LEAF
        by_size = np.argsort(sizes, kind="stable")
        widest = int(points.var(axis=0).argmax())
        slabs = [by_size[i : i + slab] for i in range(0, len(by_size), slab)]
        self.order = np.concatenate([s[np.argsort(points[s, widest], kind="stable")] for s in slabs])
        self.levels = [(points[self.order], sizes[self.order], sizes[self.order])]
        fan = LEAF
        while len(self.levels[-1][1]) > 1:
            most, low, high = self.levels[-1]
            at = np.arange(0, len(low), fan)
            self.levels.append((np.maximum.reduceat(most, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)))
            fan = FAN

    def search(self, point: np.ndarray, size: int, open_: np.ndarray) -> np.ndarray:
        """Points whose overlap with this one may suffice, among the open ones."""
        at = np.arange(len(self.levels[-1][1]))
        for level in range(len(self.levels) - 1, -1, -1):
            most, low, high = self.levels[level]
            if level == 0:
                at = at[open_[self.order[at]]]
            bound = np.minimum(np.minimum(most[at], point).sum(axis=1), np.minimum(high[at], size))
            near = low[at] * self.alike.percent <= 100 * size
            at = at[near & (bound >= self.alike.needed(size, np.maximum(low[at], -(-self.alike.percent * size // 100))))]
            if level:
                fan = LEAF if level == 1 else FAN
                at = (at[:, None] * fan + np.arange(fan)).ravel()
                at = at[at < len(self.levels[level - 1][1])]
        return self.order[at]


def points_of(sets: list[np.ndarray]) -> np.ndarray:
    out = np.zeros((len(sets), GROUPS), np.int32)
    for i, s in enumerate(sets):
        out[i] = np.bincount((s % U64(GROUPS)).astype(np.int64), minlength=GROUPS)
    return out


def forest(sets: list[np.ndarray], side: np.ndarray, alike: Similarity) -> list[tuple[int, int]]:
    """Links that connect what similar pairs connect. Members of side 1 and 2 are compared only across, of 0 all."""
    sizes = np.array([len(s) for s in sets])
    points = points_of(sets)
    groups = (np.flatnonzero(side <= 1), np.flatnonzero(side != 1))  # those that start, and those that they are compared with
    if not side.any():
        groups = (groups[0], groups[0])
    across = bool(side.any())
    trees = [CountTree(points[g], sizes[g], alike) for g in groups]
    open_ = [np.ones(len(g), bool) for g in groups] if across else [np.ones(len(groups[0]), bool)] * 2
    links: list[tuple[int, int]] = []
    for at, start in enumerate(groups[0].tolist()):
        if not open_[0][at]:
            continue
        open_[0][at] = False
        queue = [(start, 1)]
        while queue:  # nobody is found twice, so there are fewer links than members
            i, other = queue.pop()
            found = similar(sets, sizes, i, groups[other], trees[other].search(points[i], sizes[i], open_[other]), alike)
            open_[other][found] = False
            who = groups[other][found].tolist()
            links += [(i, j) for j in who]
            queue += [(j, 1 - other if across else 1) for j in who]
    return links


def similar(sets: list[np.ndarray], sizes: np.ndarray, i: int, theirs: np.ndarray, candidates: np.ndarray, alike: Similarity) -> np.ndarray:
    """Of the candidates, those whose sets are similar to set i."""
    if not len(candidates):
        return candidates
    who = theirs[candidates]
    every = np.concatenate([sets[j] for j in who])
    at = np.searchsorted(sets[i], every)
    hit = sets[i][np.minimum(at, len(sets[i]) - 1)] == every
    both = np.add.reduceat(hit, np.concatenate([[0], np.cumsum(sizes[who])[:-1]]), dtype=np.int64)
    return candidates[100 * both >= alike.percent * (sizes[i] + sizes[who] - both)]


def near_groups(docs: DataFrame, alike: Similarity = Similarity()) -> tuple[DataFrame, DataFrame]:  # noqa: B008
    """Blocks of the documents, and for each document (block_id, place, doc_id, n_shingles, component_id, kept).

    ``kept`` marks the first of each group, by id and place.
    """
    blocks = pack(docs)
    ranges = n_ranges(blocks)
    met = shared(blocks, lambda r: Sets(r["payload"], alike).counted(), ranges, WIDTH, counted=True)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in rows(batches):
            found = Sets(block["payload"], alike)
            n = found.table.num_rows
            owner, keys = found.met(block["met"], ranges)
            keys = keys.view(np.int64)
            order = np.argsort(owner, kind="stable")
            at = np.searchsorted(owner[order], np.arange(n + 1))
            one, two = found.identity()
            b = found.bounds
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, block["block_id"])),
                    pa.array(np.arange(n)),
                    found.table.column("doc_id").combine_chunks().cast(pa.int64()),
                    pa.array(found.sizes),
                    pa.array(one),
                    pa.array(two),
                    pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(keys[order])),
                    pa.array([found.hashes[b[i] : b[i + 1]].tobytes() if at[i] < at[i + 1] else None for i in range(n)], pa.binary()),
                ],
                ["block_id", "place", "doc_id", "n_shingles", "one", "two", "keys", "shingles"],
            )

    described = cut(
        with_answers(blocks, met, "met").mapInArrow(
            describe, "block_id long, place long, doc_id long, n_shingles long, one long, two long, keys array<long>, shingles binary"
        )
    ).withColumn("rid", F.col("block_id") * (1 << 16) + F.col("place"))
    same = ["n_shingles", "one", "two"]
    distinct = cut(described.where("n_shingles > 0").groupBy(*same).agg(F.min("rid").alias("rep"), F.min("doc_id").alias("low")))
    points = described.where("shingles IS NOT NULL").join(distinct.select(F.col("rep").alias("rid")), "rid", "left_semi")
    links = cut(similar_pairs(points, alike))
    found = distinct.join(components(links).withColumnRenamed("node", "rep"), "rep", "left")
    found = found.withColumn("component", F.coalesce("component", "rep"))
    lowest = found.groupBy("component").agg(F.min("low").alias("component_id"))
    found = found.join(lowest, "component").select(*same, "component", "component_id")
    out = described.select("block_id", "place", "rid", "doc_id", *same).join(found, same, "left")
    first = (
        out.where("component IS NOT NULL")
        .groupBy("component")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "rid")).getField("rid").alias("first"))
    )
    out = out.join(first, "component", "left").withColumn("kept", F.coalesce(F.col("rid") == F.col("first"), F.lit(True)))
    return blocks, out.select("block_id", "place", "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), "kept")


def similar_pairs(points: DataFrame, alike: Similarity) -> DataFrame:
    """Links (a, b) between row numbers, from points (rid, n_shingles, keys, shingles)."""
    keyed = points.select("rid", F.explode("keys").alias("key"))
    met = keyed.groupBy("key").agg(F.min("rid").alias("a"), F.max("rid").alias("z")).where("a < z").select("key", "a")
    clusters = components(keyed.join(met, "key").select("a", F.col("rid").alias("b")).where("a <> b").distinct())
    clusters = cut(clusters.select(F.col("node").alias("rid"), F.col("component").alias("cluster")))
    step = (100 / alike.percent) ** 0.25
    members = clusters.join(points.select("rid", "n_shingles"), "rid").withColumn("size", F.floor(F.log(F.col("n_shingles")) / math.log(step)))
    sizes = cut(members.groupBy("cluster", "size").agg(F.count("*").alias("n")))
    large = sizes.groupBy("cluster").agg(F.sum("n").alias("all")).where(F.col("all") > PIECE).select("cluster")
    pieces = (
        sizes.join(large, "cluster")
        .withColumn("pieces", F.ceil(F.col("n") / PIECE))
        .withColumn("piece", F.explode(F.expr("sequence(0, pieces - 1)")))
        .select("cluster", "size", "pieces", "piece")
    )
    right = pieces.select("cluster", F.col("size").alias("size_b"), F.col("piece").alias("piece_b"))
    left = pieces.withColumn("size_b", F.explode(F.expr("sequence(size, size + 5)")))
    jobs = left.join(right, ["cluster", "size_b"]).where("size_b > size OR piece_b >= piece")
    jobs = jobs.withColumn("job", F.xxhash64("cluster", "size", "piece", "size_b", "piece_b"))
    itself = (F.col("size") == F.col("size_b")) & (F.col("piece") == F.col("piece_b"))
    sides = jobs.select("cluster", "size", "pieces", "piece", "job", F.when(itself, 0).otherwise(1).alias("side"))
    other = pieces.select("cluster", F.col("size").alias("size_b"), F.col("piece").alias("piece_b"), F.col("pieces").alias("pieces_b"))
    other = jobs.where(~itself).select("cluster", "size_b", "piece_b", "job").join(other, ["cluster", "size_b", "piece_b"])
    sides = sides.unionByName(other.select("cluster", F.col("size_b").alias("size"), F.col("pieces_b").alias("pieces"), F.col("piece_b").alias("piece"), "job", F.lit(2).alias("side")))
    sides = cut(sides)
    counts = sides.select("cluster", "size", "pieces").distinct()
    dealt = members.join(counts, ["cluster", "size"], "left").withColumn("piece", F.pmod(F.xxhash64("rid"), F.coalesce("pieces", F.lit(1))))
    small = dealt.where("pieces IS NULL").select("rid", F.xxhash64("cluster").alias("job"), F.lit(0).alias("side"))
    split = dealt.where("pieces IS NOT NULL").join(sides.drop("pieces"), ["cluster", "size", "piece"]).select("rid", "job", "side")
    work = small.unionByName(split).join(points.select("rid", "shingles"), "rid")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "job", 256):
            job, rid, side = (table.column(c).to_numpy() for c in ("job", "rid", "side"))
            sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
            at = np.concatenate([[0], np.flatnonzero(job[1:] != job[:-1]) + 1, [len(job)]])
            links = [
                (rid[a + i], rid[a + j]) for a, z in zip(at[:-1], at[1:], strict=True) for i, j in forest(sets[a:z], side[a:z], alike)
            ]
            if links:
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], ["a", "b"])

    return work.repartition("job").sortWithinPartitions("job").mapInArrow(join, "a long, b long")


def one_of_each(docs: DataFrame, alike: Similarity = Similarity()) -> DataFrame:  # noqa: B008
    """The documents without those that are similar, directly or through others, to one that stays."""
    blocks, found = near_groups(docs, alike)
    gone = found.where("NOT kept").groupBy("block_id").agg(F.collect_list("place").alias("gone"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in rows(batches):
            table = unpack(block["payload"])
            stays = np.ones(table.num_rows, bool)
            stays[np.array(block["gone"] or [], np.int64)] = False
            yield from table.filter(pa.array(stays)).to_batches()

    return blocks.join(gone.hint("shuffle_hash"), "block_id", "left").mapInArrow(keep, docs.schema)
