"""Quality rules, fill-in-the-middle and periodic runs on awkward rows against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from hemicycle.llm import fill_in_middle, periodic_runs, quality_rules
from hemicycle.llm.queries import with_repeats


def words_of(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# Quality rules --------------------------------------------------------------------------------


TOKEN = quality_rules.TOKEN.replace(r"\x{80}-\x{10FFFF}", "\x80-\U0010ffff")


def grams(text: str | None, buckets: int) -> list[int]:
    codes = [zlib.crc32(x.encode()) for x in re.findall(TOKEN, text or "")]
    return [c % buckets for c in codes] + [(a * 31 + b) % buckets for a, b in zip(codes, codes[1:], strict=False)]


def base_of(text: str | None) -> tuple[int, ...]:
    text = text or ""
    words = words_of(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if words_of(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def awkward_lines(spark, awkward):
    extra = ["a b c a b c", "x\n\n x\nx\nx ", "|" * 70, "#1 $2 %3 &4 <5> *6*", "\U0001f600 é\n" * 60, "one two three " * 40]
    rows = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(extra)], "doc_id long, text string")
    return awkward.unionByName(rows, allowMissingColumns=True)


def test_ratios_are_summed_in_one_pass(spark):
    """A text of so many tokens is gone over twice only: for their checksums, and for the sums of all its n-grams."""
    plan = quality_rules.judge(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), [0] * 8192)
    text = plan.select("log_ratio")._jdf.queryExecution().analyzed().toString()
    assert text.count("aggregate(") == 1


def test_repeats_of_windows_with_one_upper_half(spark, monkeypatch):
    """Windows that look alike by the part of the hash that is sorted are told apart by their words."""
    texts = ["a b c a b c", "a b c d a b c", "x x x x", "one two three four five six", "a b", None, "p q r s p q r t p q r"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    same_half = lambda *words: F.length(F.concat(*words)).cast("long") * 0 + F.pmod(F.hash(*words), F.lit(1 << 20))
    found = lambda: docs.select("text", quality_rules.in_repeats(quality_rules.words_of(F.coalesce("text", F.lit(""))), 3).alias("n"))
    expected = Counter((t, base_of(t)[4]) for t in texts)
    assert Counter(tuple(r) for r in found().collect()) == expected
    monkeypatch.setattr(quality_rules.F, "xxhash64", same_half)  # upper halves of all windows are 0
    assert Counter(tuple(r) for r in found().collect()) == expected


def test_rules_and_ratios(spark, awkward):
    docs = awkward_lines(spark, awkward)
    rules = quality_rules.Rules(buckets=64)
    trusted = spark.createDataFrame([(i,) for i in (5, 6, 8, 13, 30, 31)], "doc_id long")
    rows = docs.collect()
    raw, good = np.ones(64), np.ones(64)
    for r in rows:
        for b in grams(r.text, 64):
            raw[b] += 1
            good[b] += r.doc_id in (5, 6, 8, 13, 30, 31)
    ratios = quality_rules.fit(docs, trusted, rules)
    assert np.allclose(np.array(ratios) / 1e6, np.log(good / good.sum()) - np.log(raw / raw.sum()), atol=1e-6)
    means = sorted(np.mean([ratios[b] for b in found]) for r in rows if (found := grams(r.text, 64)) and base_of(r.text)[0] >= 50)
    least = int(means[len(means) // 2])
    expected = []
    for r in rows:
        n, *_, repeated = base = base_of(r.text)
        found = grams(r.text, 64)
        total = sum(ratios[b] for b in found)
        failed = n < 50 or 100 * repeated > 50 * n
        expected.append((r.doc_id, *base, failed, not failed and total >= least * len(found), round(total / 1e6 / len(found), 9) if found else 0.0))
    got = [(*r[:-1], round(r[-1], 9)) for r in quality_rules.judge(docs, ratios, quality_rules.Rules(buckets=64, least=least)).collect()]
    assert Counter(got) == Counter(expected)
    assert len({x[7] for x in expected if not x[6]}) == 2


def test_rules_on_nothing(spark, nothing):
    none = spark.createDataFrame([], "doc_id long, quality int")
    trusted = quality_rules.trusted_ids(none)
    ratios = quality_rules.fit(nothing, trusted)
    assert ratios == [0] * 8192 and quality_rules.judge(nothing, ratios).count() == 0


def test_trusted_ids_are_bounded_and_not_held_out(spark):
    labels = spark.createDataFrame([(i // 2, 1 if i % 3 else 0) for i in range(400)] + [(None, 1)], "doc_id long, quality int")
    every = {r.doc_id for r in quality_rules.trusted_ids(labels).collect()}
    assert every == {i // 2 for i in range(400) if i % 3 and zlib.crc32(str(i // 2).encode()) % 4 != 2}
    few = [r.doc_id for r in quality_rules.trusted_ids(labels, quality_rules.Rules(trusted=10)).collect()]
    assert len(few) == len(set(few)) == 10 and set(few) <= every


def test_ratio_parts_good_from_bad_labels(spark):
    """Held-out labels: no good text is lost to the ratio, most bad ones that pass the base rules are."""
    sf_dir = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_rules.judge(docs, quality_rules.fit(docs, quality_rules.trusted_ids(labels))).join(labels, "doc_id").collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2 and not r.base_failed]
    good, bad = [r.kept for r in held if r.quality == 1], [r.kept for r in held if r.quality == 0]
    assert good and all(good) and bad and sum(bad) <= 0.3 * len(bad)


def test_rules_have_no_python_in_their_plan(spark, sf_dir):
    plan = quality_rules.judge(spark.read.parquet(f"{sf_dir}/documents.parquet"), [0] * 8192)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Exchange", plan)


# Fill in the middle ---------------------------------------------------------------------------


def filled(doc_id: int | None, text: str | None) -> tuple:
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    code = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(code[8 * i : 8 * i + 8], 16) for i in range(4))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    a, z = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:z], units[z:]))
    if h4 % 100 < 20:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("piece", [1, 7, 8192])
def test_middles_and_restored_texts(spark, awkward, monkeypatch, piece):
    monkeypatch.setattr(fill_in_middle, "PIECE", piece)
    extra = ["a<P>b", "x <S> y", "<M>", "<P", "P>", "<", "<<P", "S><", "é<\U0001f600é", "<S" * 30, "q" * 300, "<" * 300, "\x00 \x00"] * 3
    extra = spark.createDataFrame([(2000 + i, t) for i, t in enumerate(extra)], "doc_id long, text string")
    docs = awkward.unionByName(extra, allowMissingColumns=True)
    if piece < 100:  # pieces of a byte or two, of shorter texts
        docs = docs.where("text IS NULL OR length(text) < 1500")
    rows = docs.collect()
    expected = [filled(r.doc_id, r.text) for r in rows]
    texts = [(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in fill_in_middle.texts(docs).collect()]
    assert Counter(texts) == Counter(expected)
    assert {"plain", "psm", "spm"} == {e[2] for e in expected}
    got = Counter(tuple(r) for r in fill_in_middle.digests(docs).collect())
    assert got == Counter((*e[:5], digest(e[5]), digest(r.text or "")) for e, r in zip(expected, rows, strict=True))


def test_fill_in_middle_shuffles_once(spark, sf_dir):
    plan = fill_in_middle.digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"\bExchange", plan)) == 1 and len(re.findall(r"\bSort \[", plan)) == 2


def test_restoring_reads_only_output_and_form(spark):
    """Pieces of other outputs than the operator's own are restored all the same."""
    docs = spark.createDataFrame([(i, "one two, three") for i in range(40)], "doc_id long, text string")
    pieces = fill_in_middle.assembled(docs).withColumn("piece", F.expr("encode(replace(decode(piece, 'UTF-8'), 'two', 'other'), 'UTF-8')"))
    found = fill_in_middle.restored(pieces).collect()
    texts: dict[int, bytes] = {}
    for r in found:
        texts[r.rid] = texts.get(r.rid, b"") + bytes(r.piece or b"")
    assert set(texts.values()) == {b"one other, three"}


def test_fill_in_middle_on_nothing(nothing):
    assert fill_in_middle.digests(nothing).count() == 0 and fill_in_middle.texts(nothing).count() == 0


# Periodic runs --------------------------------------------------------------------------------


def brute_runs(words) -> list[tuple[int, int, int]]:
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((a, z - a, q) for (a, z), q in found.items())


def sequences(seed: int) -> list[int]:
    rng = random.Random(seed)
    out: list[int] = []
    while len(out) < 400:
        part = [rng.randrange(rng.choice((2, 3, 50))) for _ in range(rng.choice((1, 1, 2, 3, 5, 8, 13, 40)))]
        out += part * rng.choice((1, 2, 4, 5, 9)) + part[: rng.randrange(len(part) + 1)]
        if rng.random() < 0.2:
            out += out[-rng.randrange(1, 60) :]
    return out


@pytest.mark.parametrize("seed", range(25))
def test_catchers_find_all_runs_at_any_step(seed):
    words = np.array(sequences(seed))
    expected = brute_runs(words.tolist())
    for step in (1, 7, 64, len(words)):
        catchers = periodic_runs.Catchers()
        for at in range(0, len(words), step):
            catchers.append(words[at : at + step])
            if step == 7:
                assert catchers.runs() == brute_runs(words[: at + step].tolist())
        assert catchers.runs() == expected
    assert expected


@pytest.mark.parametrize("names", ["one for all", "two"])
def test_misleading_names_change_nothing(monkeypatch, names):
    monkeypatch.setattr(periodic_runs, "names_of", lambda w: (w % (1 if names == "one for all" else 2)).astype(np.uint64))
    monkeypatch.setattr(periodic_runs, "names_of_pairs", lambda a, b: a ^ b)
    for seed in range(8):
        words = np.array(sequences(seed))
        for step in (33, 1000):
            catchers = periodic_runs.Catchers()
            for at in range(0, len(words), step):
                catchers.append(words[at : at + step])
            assert catchers.runs() == brute_runs(words.tolist())


def test_long_runs_take_little_time():
    words = np.concatenate([np.zeros(300_000, np.int64), np.tile(np.arange(1000), 300), np.arange(10**6, 10**6 + 5)])
    catchers = periodic_runs.Catchers()
    for at in range(0, len(words), 1 << 16):
        catchers.append(words[at : at + (1 << 16)])
    assert catchers.runs() == [(0, 300_001, 1), (300_000, 300_000, 1000)]


def collapsed(words: list[str], runs) -> list[str]:
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def test_runs_of_documents(spark, awkward):
    extra = ["a a a a a", "a a a a a a", "a b a b a b a b", "x a b a b a b a b a y", "a " * 50 + "b " * 50, "s té s té s té s té s", "a b\n" * 40]
    extra += ["end with z z z z z z", "z z z z z z begin"]  # rows that would run on into each other
    extra = spark.createDataFrame([(3000 + i, t) for i, t in enumerate(extra)], "doc_id long, text string")
    docs = awkward.unionByName(extra, allowMissingColumns=True)
    expected = []
    for r in docs.collect():
        words = words_of(r.text)
        runs = brute_runs(words[:2500]) if len(words) <= 2500 else []
        expected.append((r.doc_id, len(words), tuple(runs), " ".join(collapsed(words, runs))))
    got = [(r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.collapsed) for r in periodic_runs.find_runs(docs).collect()]
    assert Counter(got) == Counter(expected)


def test_documents_that_go_on_in_a_period(spark, awkward):
    rows = awkward.collect()
    expected = []
    for r in rows:
        words = words_of(r.text)
        h = zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + math.floor((n - a) / (3 + g % 8))
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        expected.append((r.doc_id, tuple(words)))
    assert Counter((r.doc_id, tuple(words_of(r.text))) for r in with_repeats(awkward).collect()) == Counter(expected)


def test_runs_on_nothing(nothing):
    assert periodic_runs.find_runs(nothing).count() == 0
