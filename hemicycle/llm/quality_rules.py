"""Quality rules of single documents and a log-likelihood ratio of hashed n-grams.

Words and runs of signs fall by their CRC-32, and neighbouring pairs of them by 31 times the one's and once the other's,
into a fixed number of buckets. Two multinomials over the buckets, one of trusted documents and one of the whole corpus, each with one more count a
bucket, give each bucket the logarithm of its ratio. A document's score is the mean of its n-grams' ratios, so that its
length does not matter. Every document is kept whose score reaches the threshold; nothing is drawn at random.

Ratios are whole millionths and sums whole numbers, so results do not depend on order. All steps are DataFrame functions:
the counts are one aggregate over all documents, the scores one pass without a shuffle.

Defined results: null and empty texts have no words and fail the base rules; a text without n-grams scores 0; rows with
the same id, null ids and repeated rows are judged each (a trusted id makes all its rows trusted, a null id none); no
trusted rows make every score a matter of the corpus alone. Extra columns are not read. An empty table gives an empty
result. A document is one row and its words one array, so a text is held whole in memory a few times.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What separates words, the signs that are counted, and the words and runs of signs that n-grams are made of.
SEPARATORS = " \t\n\x0b\x0c\r"
SIGNS = "#*$%&|<>"
TOKEN = r"[0-9A-Za-z_\x{80}-\x{10FFFF}]+|[\x21-\x2F\x3A-\x40\x5B-\x5E\x60\x7B-\x7F]+"
UNIT = 1_000_000
#: The lower half of a number of 64 bits.
HALF = (1 << 32) - 1


@dataclass(frozen=True)
class Rules:
    """Parameters: buckets of n-grams, the least mean ratio in millionths, trusted documents at most, the least number
    of words, words of a window, and how many in a hundred words may lie in repeated windows.
    """

    buckets: int = 8192
    least: int = -300_000
    trusted: int = 100_000
    words: int = 50
    window: int = 3
    repeated: int = 50


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often it is named there."""
    return F.element_at(F.transform(F.array(value), use), 1)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, f"[{SEPARATORS}]+", -1), "")


def heads(words: Column, n: int) -> Column:
    """The words that begin a window of ``n``."""
    return F.slice(words, F.lit(1), F.greatest(F.size(words) - (n - 1), F.lit(0)))


def in_repeats(words: Column, n: int) -> Column:
    """How many words lie in windows of ``n`` that stand more than once.

    Upper halves of the windows' hashes are sorted with the windows' places behind them, as single numbers, and the windows
    whose half stands more than once by themselves.
    """

    def twice(sorted_: Column, of: Callable[[Column], Column]) -> Column:
        alike = lambda s, j: (of(s) == of(F.get(sorted_, j - 1))) | (of(s) == of(F.get(sorted_, j + 1)))
        return F.filter(sorted_, alike)

    def compared(sorted_: Column) -> Column:
        place = lambda s: s.bitwiseAND(F.lit(HALF)).cast("int")
        window = lambda i: F.struct(F.concat_ws(" ", *[F.get(words, i + k) for k in range(n)]).alias("w"), i.alias("i"))
        some = F.transform(twice(sorted_, lambda s: F.shiftright(s, 32)), lambda s: window(place(s)))
        at = let(F.sort_array(some), lambda x: twice(x, lambda s: s["w"]))
        return F.size(F.array_distinct(F.flatten(F.transform(at, lambda s: F.sequence(s["i"], s["i"] + (n - 1))))))

    hashes = F.transform(heads(words, n), lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, n)]))
    sorted_ = lambda h: F.sort_array(F.transform(h, lambda x, i: x.bitwiseAND(F.lit(~HALF)).bitwiseOR(i.cast("long"))))
    return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), let(sorted_(h), compared)).otherwise(0))


def codes_of(text: Column) -> Column:
    """The checksum of each token of a text."""
    return F.transform(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0)), lambda t: F.crc32(t.cast("binary")))


def grams_of(text: Column, buckets: int) -> Column:
    """The buckets of a text's tokens, and of its pairs of neighbouring tokens."""

    def both(codes: Column) -> Column:
        pairs = F.transform(heads(codes, 2), lambda c, i: ((c * 31 + F.get(codes, i + 1)) % buckets).cast("int"))
        return F.concat(F.transform(codes, lambda c: (c % buckets).cast("int")), pairs)

    return let(codes_of(text), both)


def summed(text: Column, table: Column, buckets: int) -> Column:
    """The sum of the ratios of a text's n-grams and their number, in one pass that keeps the token before."""
    ratio = lambda code: F.get(table, (code % buckets).cast("int"))

    def step(s: Column, code: Column) -> Column:
        pair = F.coalesce(ratio(s["before"] * 31 + code), F.lit(0).cast("long"))  # the first token has none before it
        return F.struct((s["sum"] + ratio(code) + pair).alias("sum"), code.alias("before"))

    start = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(None).cast("long").alias("before"))
    n = lambda codes: (F.size(codes) + F.greatest(F.size(codes) - 1, F.lit(0))).cast("long")
    return let(codes_of(text), lambda codes: F.struct(F.aggregate(codes, start, step)["sum"].alias("sum"), n(codes).alias("n")))


def trusted_ids(labels: DataFrame, rules: Rules = Rules()) -> DataFrame:  # noqa: B008
    """Ids of at most so many documents of good quality, by a hash of the id, without those held out for tests."""
    good = labels.where("quality = 1 AND doc_id IS NOT NULL AND crc32(CAST(doc_id AS STRING)) % 4 <> 2").select("doc_id").distinct()
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rules.trusted)


def fit(docs: DataFrame, trusted: DataFrame, rules: Rules = Rules()) -> list[int]:  # noqa: B008
    """The ratio of each bucket in millionths, from the counts of all documents and of the trusted ones.

    ``trusted`` has at most ``rules.trusted`` rows, which bounds the broadcast; the driver gets one row a bucket.
    """
    marked = docs.select("doc_id", "text").join(F.broadcast(trusted.select("doc_id", F.lit(1).alias("trusted"))), "doc_id", "left")
    grams = marked.select("trusted", F.explode(grams_of(F.coalesce("text", F.lit("")), rules.buckets)).alias("bucket"))
    counted = grams.groupBy("bucket").agg(F.count("*").alias("n"), F.count("trusted").alias("t"))
    raw, target = [0] * rules.buckets, [0] * rules.buckets
    for row in counted.collect():
        raw[row["bucket"]], target[row["bucket"]] = row["n"], row["t"]
    all_, good = sum(raw) + rules.buckets, sum(target) + rules.buckets
    return [math.floor(UNIT * (math.log((t + 1) / good) - math.log((n + 1) / all_)) + 0.5) for n, t in zip(raw, target, strict=True)]


def judge(docs: DataFrame, ratios: list[int], rules: Rules = Rules()) -> DataFrame:  # noqa: B008
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, log_ratio) of every row."""
    table = F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<long>")
    t = F.col("t")
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(f"[^{SEPARATORS}]"))
    rows = docs.select(F.col("doc_id"), F.coalesce("text", F.lit("")).alias("t"))
    rows = rows.select(
        "doc_id",
        let(words_of(t), lambda w: F.struct(
            F.size(w).cast("long").alias("n"),
            in_repeats(w, rules.window).cast("long").alias("repeated"),
        )).alias("w"),
        (F.char_length(t) - F.regexp_count(t, F.lit(f"[{SEPARATORS}]"))).cast("long").alias("word_chars"),
        F.regexp_count(t, F.lit(f"[{SIGNS}]")).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        summed(t, table, rules.buckets).alias("g"),
    )
    failed = (F.col("w.n") < rules.words) | (100 * F.col("w.repeated") > rules.repeated * F.col("w.n"))
    return rows.select(
        "doc_id", F.col("w.n").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", F.col("w.repeated").alias("n_repeat_words"),
        failed.alias("base_failed"), (~failed & (F.col("g.sum") >= rules.least * F.col("g.n"))).alias("kept"),
        F.when(F.col("g.n") > 0, F.col("g.sum").cast("double") / (UNIT * F.col("g.n")).cast("double")).otherwise(0.0).alias("log_ratio"),
    )
