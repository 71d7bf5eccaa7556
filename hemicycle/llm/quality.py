"""Quality scores by regularised quadratic discriminant analysis of document statistics.

A document is a vector of transformed statistics of its bytes, words and lines. Each class has a mean and a covariance,
shrunk towards the diagonal of the pooled one; its Cholesky factor is inverted once. The score is the logistic function
of the difference of the two log densities, from Mahalanobis distances, plus the log odds of the classes.

Defined results: null and empty texts have the statistics of a text without bytes and get a score; null ids match no
label; repeated rows are scored each; a label that is neither 0 nor 1 teaches nothing, a document with two labels teaches
both; with fewer than two documents of a class every score is 0.5. Extra columns are not read. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hemicycle.llm.hashing import Words
from hemicycle.llm.storage import slices, text_bytes

#: Part of the pooled variances in each covariance, and least variance relative to it.
SHRINKAGE, FLOOR = 0.5, 1e-3
#: Added to every variance, so that labelled texts with equal statistics have a density too.
LEAST_VARIANCE = 1e-6
#: Scores from here on are accepted.
ACCEPT = 0.7

_codes = np.arange(256)
_letters = ((_codes | 32) >= ord("a")) & ((_codes | 32) <= ord("z")) & (_codes < 128)
CLASSES = {
    "upper": _letters & (_codes < ord("a")),
    "digit": (_codes >= 0x30) & (_codes <= 0x39),
    "stop": np.isin(_codes, list(b".,;:")),
    "bang": np.isin(_codes, list(b"!?")),
    "pipe": np.isin(_codes, list(b"|")),
    "symbol": np.isin(_codes, list(b"#$%&*@=_~^<>/\\+[]{}\"'`()-")),
    "line": _codes == 0x0A,
    "wide": _codes >= 128,
}
NEWLINE = _codes == 0x0A
N_STATISTICS = len(CLASSES) + 7


def statistics(column: pa.ChunkedArray) -> np.ndarray:
    """A row of transformed statistics for each text."""
    data, offsets = text_bytes(column)
    n = len(offsets) - 1
    counts = np.zeros((n, 256))
    words, lines = Words(data, offsets), Words(data, offsets, NEWLINE)
    hashes = words.hashes()
    distinct, repeated_lines = np.ones(n), np.zeros(n)
    line_hashes = lines.hashes()
    for i in range(n):
        counts[i] = np.bincount(data[offsets[i] : offsets[i + 1]], minlength=256)
        a, b = words.bounds[i], words.bounds[i + 1]
        if b > a:
            distinct[i] = len(np.unique(hashes[a:b])) / (b - a)
        a, b = lines.bounds[i], lines.bounds[i + 1]
        if b > a:
            repeated_lines[i] = 1 - len(np.unique(line_hashes[a:b])) / (b - a)
    total = counts.sum(axis=1)
    size = np.maximum(total, 1)
    shares = counts / size[:, None]
    out = [np.sqrt(shares[:, mask].sum(axis=1)) for mask in CLASSES.values()]
    row, length = words.row(), words.end - words.start
    n_words = np.maximum(words.counts, 1)
    again = np.zeros(len(words), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    longest = np.ones(n)
    np.maximum.at(longest, row, length)
    out += [
        np.log1p(total),
        np.log(np.bincount(row, length, n) / n_words + 1),
        np.log(longest),
        np.sqrt(np.bincount(row, again, n) / n_words),
        np.log(distinct) / np.log(n_words + 2),
        np.sqrt(repeated_lines),
        -(shares * np.log(np.maximum(shares, 1e-12))).sum(axis=1),
    ]
    return np.stack(out, axis=1)


@dataclass(frozen=True)
class Model:
    """Log odds of the classes; for each class its mean, inverted Cholesky factor and half the log of its determinant."""

    odds: float
    classes: tuple[tuple[np.ndarray, np.ndarray, float], ...]

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not self.classes:
            return np.full(len(x), 0.5)
        bad, good = (-0.5 * (((x - mean) @ inverse.T) ** 2).sum(axis=1) - half for mean, inverse, half in self.classes)
        return 1 / (1 + np.exp(-np.clip(good - bad + self.odds, -500, 500)))


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that no label is learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Model:
    """Moments of the statistics by class, summed over all labelled rows that are not held out."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in slices(batches):
            x = statistics(table.column("text"))
            flat = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), N_STATISTICS).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([table.column("doc_id").combine_chunks(), flat], ["doc_id", "x"])

    found = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(describe, "doc_id long, x array<double>")
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).alias("label")).where("label IN (0, 1)").where(~held_out())
    pairs = found.join(known, "doc_id").select("label", F.concat(F.array(F.lit(1.0)), "x").alias("x"))
    pairs = pairs.select("label", "x", F.posexplode("x").alias("i", "left"))
    sums = pairs.select("label", "i", F.posexplode(F.transform("x", lambda v: v * F.col("left"))).alias("j", "v"))
    d = N_STATISTICS + 1
    moments = np.zeros((2, d, d))
    for r in sums.groupBy("label", "i", "j").agg(F.sum("v").alias("v")).collect():  # 2 * d * d numbers
        moments[r.label, r.i, r.j] = r.v
    n = moments[:, 0, 0]
    if n.min() < 2:
        return Model(0.0, ())
    means = moments[:, 0, 1:] / n[:, None]
    spread = [moments[k, 1:, 1:] - n[k] * np.outer(means[k], means[k]) for k in (0, 1)]
    pooled = np.diag(sum(spread) / n.sum())
    classes = []
    for k in (0, 1):
        covariance = (1 - SHRINKAGE) * spread[k] / n[k] + np.diag(SHRINKAGE * pooled + FLOOR * pooled.max() + LEAST_VARIANCE)
        factor = np.linalg.cholesky(covariance)
        classes.append((means[k], np.linalg.inv(factor), float(np.log(np.diag(factor)).sum())))
    return Model(float(np.log(n[1] / n[0])), tuple(classes))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in slices(batches):
            scores = model.scores(statistics(table.column("text")))
            yield pa.RecordBatch.from_arrays([table.column("doc_id").combine_chunks(), pa.array(scores)], ["doc_id", "score"])

    found = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))


def accepted(docs: DataFrame, model: Model, least: float = ACCEPT) -> DataFrame:
    """The rows that score at least ``least``, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in slices(batches):
            yield from table.filter(pa.array(model.scores(statistics(table.column("text"))) >= least)).to_batches()

    return docs.mapInArrow(run, docs.schema)
