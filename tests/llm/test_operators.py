"""Operators on awkward rows against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import awkward_texts, prose

from hemicycle.llm import embedding_dedup, jaccard_join, license_scan, mixing, quality, search, shared_keys, storage, substring_dedup, suffix_dedup, url_rules, word_bpe
from hemicycle.llm.components import components
from hemicycle.llm.suffix_array import DEPTH, SuffixArray


def words_of(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def test_passages_of_words(awkward):
    window = 35
    rows = awkward.collect()
    seen = Counter(tuple(w[i : i + window]) for r in rows for w in [words_of(r.text)] for i in range(len(w) - window + 1))
    expected = []
    for r in rows:
        w = words_of(r.text)
        gone = {p for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for p in range(i, i + window)}
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        expected.append((r.doc_id, len(w), len(gone), digest(kept.encode())))
    found = substring_dedup.remove_repeats(awkward)
    got = [(r.doc.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found.collect()]
    assert Counter(got) == Counter(expected)
    assert {digest(r.kept_text.encode()) for r in found.collect()} == {e[3] for e in expected}
    texts = substring_dedup.with_kept_text(found, awkward.columns)
    assert texts.columns == awkward.columns


@pytest.mark.parametrize("window", [1, 2, 5, 12, 50])
def test_passages_of_other_lengths(spark, window):
    rng = random.Random(window)
    texts = [" ".join(rng.choice("ab cd ef".split()) for _ in range(rng.randint(0, 120))) for _ in range(12)]
    seen = Counter(tuple(w[i : i + window]) for t in texts for w in [t.split()] for i in range(len(w) - window + 1))
    expected = Counter()
    for k, t in enumerate(texts):
        w = t.split()
        expected[k] = len({p for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for p in range(i, i + window)})
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc.doc_id: r.n_removed for r in substring_dedup.remove_repeats(docs, window).collect()} == dict(expected)


def test_byte_strings(awkward, monkeypatch):
    rows = awkward.collect()
    texts = [(r.text or "").encode() for r in rows]
    seen = Counter(t[i : i + DEPTH] for t in texts for i in range(len(t) - DEPTH + 1))
    expected = []
    for r, t in zip(rows, texts, strict=True):
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - DEPTH + 1):
            if seen[t[i : i + DEPTH]] > 1:
                gone[i : i + DEPTH] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(b for b, g in zip(t, gone, strict=False) if not g)
        expected.append((r.doc_id, len(t), int(gone.sum()), spans, digest(kept)))
    for crowd in (suffix_dedup.CROWD, 1):  # with 1, all least hashes with two runs are dealt to several tasks
        monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
        got = [(r.doc.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(awkward).collect()]
        assert Counter(got) == Counter(expected)


@pytest.mark.parametrize("seed", range(6))
def test_suffix_order_and_common_prefixes(seed):
    rng = random.Random(seed)
    base = bytes(rng.choice(b"ab\x00c") for _ in range(4000))
    strings, windows = [], []
    for _ in range(rng.randint(1, 25)):
        n, more = rng.randint(1, 200), rng.choice([0, 16])
        a = rng.randint(0, len(base) - n - DEPTH - 20)
        text = bytearray(rng.choice([base[a : a + n + DEPTH - 1 + more], b"a" * (n + DEPTH - 1 + more)]))
        if rng.random() < 0.3:
            text[rng.randrange(len(text))] = ord("z")
        strings.append(bytes(text))
        windows.append(n)
    weight = np.array([rng.choice([1, 1, 2]) for _ in strings])
    array = SuffixArray(strings, windows)
    order = array.order()
    content = [bytes(array.bytes[p : p + DEPTH]) for p in order]
    assert content == sorted(content) and sorted(order) == sorted(array.places)
    seen = Counter()
    for s, n, w in zip(strings, windows, weight, strict=True):
        for i in range(n):
            seen[s[i : i + DEPTH]] += int(w)
    for s, n, again in zip(strings, windows, array.repeated(weight), strict=True):
        assert [seen[s[i : i + DEPTH]] >= 2 for i in range(n)] == again.tolist()


def shingles(text: str | None, n: int) -> frozenset:
    w = words_of(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def groups(sets: list[frozenset], percent: int) -> list[int]:
    label = list(range(len(sets)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                x, y = sorted((root(i), root(j)))
                label[y] = x
    return [root(i) for i in range(len(sets))]


@pytest.mark.parametrize("words,percent,piece", [(3, 90, 1024), (5, 80, 4), (1, 60, 3)])
def test_similar_sets(spark, awkward, monkeypatch, words, percent, piece):
    rng = random.Random(percent)
    family = prose(rng, 60).split()
    near = []
    for _ in range(40):
        copy = list(family)
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(len(copy))] = rng.choice("x y z".split())
        near.append(" ".join(copy))
    extra = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(near)], "doc_id long, text string")
    docs = awkward.select("doc_id", "text").unionByName(extra)
    monkeypatch.setattr(jaccard_join, "PIECE", piece)
    alike = jaccard_join.Similarity(words, percent)
    _, found = jaccard_join.near_groups(docs, alike)
    rows = docs.collect()
    sets = [shingles(r.text, words) for r in rows]
    member = groups(sets, percent)
    lowest = {g: min((r.doc_id for r, m in zip(rows, member, strict=True) if m == g and r.doc_id is not None), default=None) for g in member}
    expected = Counter((r.doc_id, len(s), lowest[m]) for r, s, m in zip(rows, sets, member, strict=True))
    got = found.collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == expected
    assert sum(r.kept for r in got) == len(set(member))
    assert jaccard_join.one_of_each(docs, alike).count() == len(set(member))


def test_documents_meet_over_their_rarest_contents():
    """Families of near copies that take paragraphs from a common stock are not one cluster."""
    rng = random.Random(3)
    stock = [prose(rng, 40) for _ in range(24)]
    texts = []
    for _ in range(40):
        own = " ".join([prose(rng, 30), *rng.sample(stock, 4), prose(rng, 30)]).split()
        texts += [" ".join(own), " ".join([*own[:50], "other", *own[51:]])]
    alike = jaccard_join.Similarity(5, 80)
    found = jaccard_join.Sets(storage.payload_of(pa.table({"text": texts})), alike)
    _, counts = np.unique(found.counted(), return_counts=True)
    row, keys = found.met([{"part": 0, "bits": np.minimum(counts, 255).astype(np.uint8).tobytes()}], 1)
    holders: dict[int, set] = {}
    for r, k in zip(row.tolist(), keys.tolist(), strict=True):
        holders.setdefault(k, set()).add(r)
    met = {(a, b) for h in holders.values() for a in h for b in h if a < b}
    assert {(2 * i, 2 * i + 1) for i in range(40)} <= met
    assert len(met) < 4 * 40


def test_counts_of_shared_keys(spark):
    blocks = spark.createDataFrame([(b, 1000) for b in range(40)], "block_id long, n_bytes long").repartition(4)
    own = lambda b: jaccard_join.mix(np.array([0, 0, *range(1, 2 + b), *range(100 * b, 100 * b + 9 * b)], np.uint64)) & jaccard_join.UPPER
    every = Counter(k for b in range(40) for k in own(b).tolist())
    answers = shared_keys.shared(blocks, lambda row: own(row["block_id"]), 7, jaccard_join.WIDTH, counted=True).collect()
    assert len(answers) == 40
    for r in answers:
        keys = own(r["block_id"])
        assert shared_keys.times(keys, r["answer"], 7).tolist() == [min(every[k], 255) for k in keys.tolist()]


def test_vectors(spark, monkeypatch):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(60, 8))
    vectors = [list(map(float, v)) for v in np.concatenate([base, base[:25] + 0.08 * rng.normal(size=(25, 8)), base[:5], 3 * base[5:8]])]
    odd = [None, [], [0.0] * 8, [float("nan")] * 8, [1.0, None] + [0.0] * 6, [float("inf")] + [1.0] * 7, [1.0, 2.0], [2.0, 4.0] + [0.0] * 6]
    rows = [(i, v, None) for i, v in enumerate(vectors + odd)] + [(3, vectors[3], 1), (None, vectors[9], 2)]
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    monkeypatch.setattr(embedding_dedup, "LEAF", 4)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, node int")
    valid = [v is not None and any(v) and all(x is not None and np.isfinite(x) for x in v) for _, v, _ in rows]
    full = np.array([np.pad(v, (0, 8 - len(v))) if ok else np.zeros(8) for (_, v, _), ok in zip(rows, valid, strict=True)])
    full = full / np.maximum(np.linalg.norm(full, axis=1, keepdims=True), 1e-300)
    linked = (full @ full.T >= 0.95) & np.outer(valid, valid) & ~np.eye(len(rows), dtype=bool)
    reach = np.linalg.matrix_power((linked | np.eye(len(rows), dtype=bool)).astype(float), 64) > 0
    ids = [r[0] for r in rows]
    expected = Counter()
    for i, row in enumerate(reach):
        low = min((ids[j] for j in np.flatnonzero(row) if ids[j] is not None), default=None)
        expected[ids[i], int(linked[i].sum()), low, low is None or ids[i] == low] += 1
    got = Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_vectors(table).collect())
    assert got == expected


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(200, 260)] + [(5, 5), (7, 200)]
    found = {r.node: r.component for r in components(spark.createDataFrame(chain + star, "a long, b long")).collect()}
    assert found == {i: 100 for i in range(100, 161)} | {i: 7 for i in [7, *range(200, 260)]}


def test_whole_queries_ask_for_all_their_words(awkward):
    rows = awkward.select("doc_id", "text").collect()
    docs = [Counter(words_of(re.sub("[A-Z]", lambda m: m[0].lower(), r.text or ""))) for r in rows]
    n, mean = len(docs), sum(sum(d.values()) for d in docs) / len(docs)
    df = Counter(w for d in docs for w in d)
    weight = {w: np.log(1 + (n - c + 0.5) / (c + 0.5)) for w, c in df.items()}
    expected = Counter()
    for r, d in zip(rows, docs, strict=True):
        scored = []
        for k, e in enumerate(docs):
            length = sum(e.values())
            parts = [np.floor(e[t] * 2.2 / (e[t] + 1.2 * (0.25 + 0.75 * length / mean)) * weight[t] * 1e6 + 0.5) for t in d if t in e]
            if parts:
                scored.append((-int(sum(parts)), rows[k].doc_id is None, rows[k].doc_id or 0))
        for rank, (score, _, _) in enumerate(sorted(scored)[:10], 1):
            expected[r.doc_id, rank, -score] += 1
    got = search.search(awkward, awkward["doc_id"].isNull() | (awkward["doc_id"] >= 0)).collect()
    assert Counter((r.query_id, r.rank, r.score) for r in got) == expected


@pytest.mark.parametrize("seed", range(12))
def test_skipped_blocks_hold_no_best_row(seed, monkeypatch):
    monkeypatch.setattr(search, "ROWS", 3)
    monkeypatch.setattr(search, "FIRST", 2)
    rng = random.Random(seed)
    names = [f"t{i}" for i in range(12)]
    texts = [" ".join(rng.choice(names[: rng.randint(1, 12)]) for _ in range(rng.randint(0, 9))) for _ in range(90)]
    table = pa.table({"doc_id": pa.array(range(90)), "text": texts})
    index = search.Index(storage.payload_of(table), 4.5)
    asked = rng.sample(names, 5)
    idfs = np.array([rng.random() * 3 for _ in asked])
    expected = []
    for row, text in enumerate(texts):
        words = text.split()
        parts = [words.count(t) * 2.2 / (words.count(t) + 1.2 * (0.25 + 0.75 * len(words) / 4.5)) for t in asked]
        score = sum(int(np.floor(p * i * search.UNIT + 0.5)) for p, i in zip(parts, idfs, strict=True))
        expected += [(score, row)] if score else []
    expected.sort(key=lambda x: (-x[0], x[1]))
    found = index.top(search.hashes_of(asked), idfs, 7)
    assert [r for _, r in found] == [r for _, r in expected[:7]]
    least = found[3][0]
    assert index.top(search.hashes_of(asked), idfs, 7, least) == [f for f in found if f[0] >= least]
    assert np.allclose([s for s, _ in found], [s for s, _ in expected[:7]], atol=5)


@pytest.mark.parametrize("seed", range(6))
def test_words_of_many_rows_have_columns_and_scores_stay_exact(seed, monkeypatch):
    monkeypatch.setattr(search, "ROWS", 4)
    monkeypatch.setattr(search, "GROUP_CELLS", 300)
    rng = random.Random(seed)
    frequent, rare = [f"f{i}" for i in range(9)], [f"r{i}" for i in range(400)]
    texts = [" ".join(rng.choices(frequent, k=rng.randint(0, 12)) + rng.choices(rare, k=rng.randint(0, 5))) for _ in range(120)]
    index = search.Index(storage.payload_of(pa.table({"doc_id": pa.array(range(120)), "text": texts})), 9.0)
    names = frequent + rare
    hashes, idfs = search.hashes_of(names), np.array([rng.random() * 4 for _ in names])
    # the postings that are walked are those of rare words
    assert (np.diff(index.start)[index.column < 0] < 16).all() and len(index.dense) == 9 < len(index.hash)
    queries = [sorted(rng.sample(range(len(names)), rng.randint(1, 60)) + [rng.randrange(9)]) for _ in range(20)]
    queries = [sorted(set(q)) for q in queries]
    expected = []
    for q in queries:
        found = []
        for row, text in enumerate(texts):
            words = text.split()
            parts = [words.count(names[t]) * 2.2 / (words.count(names[t]) + 1.2 * (0.25 + 0.75 * len(words) / 9.0)) for t in q]
            score = sum(int(np.floor(p * idfs[t] * search.UNIT + 0.5)) for p, t in zip(parts, q, strict=True))
            found += [(score, row)] if score else []
        expected.append(sorted(found, key=lambda x: (-x[0], x[1]))[:10])
    codes, starts = np.concatenate(queries), np.append(0, np.cumsum([len(q) for q in queries])).tolist()
    order = np.argsort(hashes)
    codes = np.argsort(order)[codes]
    assert index.tops(hashes[order], idfs[order], codes, starts, 10, [0] * 20) == expected
    least = [found[rng.randrange(len(found))][0] if found else 0 for found in expected]
    assert index.tops(hashes[order], idfs[order], codes, starts, 10, least) == [[f for f in found if f[0] >= at] for found, at in zip(expected, least, strict=True)]


def test_mix_meets_its_targets(awkward):
    slots, found = mixing.mix(awkward)
    rows = found.collect()
    assert len(rows) == awkward.count()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in awkward.collect())
    for source in {r.source for r in rows}:
        own = [r for r in rows if r.source == source]
        assert sum(r.taken for r in own) == int(own[0].target) and sum(r.size for r in own) == own[0].source_size
        assert all(0 <= r.taken <= 2 * r.size for r in own)
    order = sorted((r.slot, r.number, r.block) for r in slots.collect())
    assert len({s for s, *_ in order}) == len(order)
    for number in {n for _, n, _ in order}:
        assert [b for _, n, b in order if n == number] == list(range(sum(n == number for _, n, _ in order)))
    again = mixing.mix(awkward.repartition(3))[1]
    key = lambda r: (str(r.doc_id), str(r.source), r.size, r.taken)
    assert sorted(map(key, again.collect())) == sorted(map(key, rows))
    assert mixing.mixed(awkward).columns == awkward.columns


def test_schedule_is_even(spark):
    rows = [(i, "w " * 20000, "abc"[i % 3]) for i in range(60)]
    slots, _ = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    order = [n for _, n in sorted((r.slot, r.number) for r in slots.collect())]
    half = len(order) // 2
    for number in set(order):
        assert abs(order[:half].count(number) - order.count(number) / 2) <= 0.1 * order.count(number) + 3


def test_scores_of_awkward_texts(spark, awkward, nothing):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(10, 50)] + [(11, 1, 0), (12, None, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    model = quality.fit(awkward, labels)
    rows = quality.score(awkward, model).collect()
    assert len(rows) == awkward.count() and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in quality.score(awkward, quality.fit(awkward, labels.where("quality = 1"))).collect()} == {0.5}
    assert quality.accepted(awkward, model).columns == awkward.columns
    assert quality.score(nothing, quality.fit(nothing, labels)).count() == 0


def test_codes_of_awkward_texts(spark, awkward, monkeypatch):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    rng = random.Random(3)
    letters = "aAbB 'sStré́Σßİ<|endoftext|>ǅ\x00\x1c\x85\xa0 字١Ⅷ½👍🏽.!?"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    texts += ["<|endoftext|>x<|startoftext|><|endoftext|>", "'S'LL'd", "q" * 3000]
    docs = awkward.select("doc_id", "text").unionByName(spark.createDataFrame([(5000 + i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    assert 0 < len(word_bpe.frequent_words(docs, word_bpe.Vocabulary.load(path), 50)) <= 50
    for most in (50, 0):
        monkeypatch.setattr(word_bpe, "LEXICON", most)
        got = Counter((r.doc_id, r.n_tokens, tuple(r.ids)) for r in word_bpe.encode(docs, path).collect())
        expected = Counter()
        for r in docs.collect():
            ids = library.encode(r.text or "", add_special_tokens=False).ids
            expected[r.doc_id, len(ids), tuple(ids)] += 1
        assert got == expected


def test_lexicon_shares_endings():
    entries = {w.encode(): [i] for i, w in enumerate("tap taps top tops stop stops".split())}
    lexicon = word_bpe.Lexicon(word_bpe.compile_lexicon(entries))
    assert len(lexicon.final) == 7
    found = lexicon.find([b"tops", b"to", b"topss", b"", b"stop"])
    assert [None if x is None else np.frombuffer(x, "<u4").tolist() for x in found] == [[3], None, None, None, [4]]


def test_urls(spark):
    cases = {
        None: ("", "", None, "allow"),
        "no scheme": ("", "", None, "allow"),
        "http://A.Org/x?y": ("a.org", "/x", "org/", "allow"),
        "http://org": ("org", "", None, "allow"),
        "https://m.example.org/es/1": ("m.example.org", "/es/1", "example.org/es/", "block"),
        "https://example.org/es": ("example.org", "/es", "org/", "allow"),
        "https://example.org/en/17": ("example.org", "/en/17", "example.org/en/1", "block"),
        "https://notexample.org/en/17": ("notexample.org", "/en/17", "org/", "allow"),
        "x://b.com/fr/": ("b.com", "/fr/", "com/fr/", "allow"),
        "x://b.com/de/#t": ("b.com", "/de/", "com/de/", "block"),
        "x://b.com/DE/": ("b.com", "/DE/", None, "allow"),
        "x://casino.net/a": ("casino.net", "/a", None, "block"),
        "x://casinos.net/a://z/?b": ("casinos.net", "/a://z/", None, "allow"),
        "": ("", "", None, "allow"),
        "://": ("", "", None, "allow"),
    }
    rows = [(i, u, "r", "v") for i, u in enumerate(cases)] + [(0, None, "", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, rule string, host string")
    got = {(r.page_id): (r.host, r.path, r.rule, r.verdict) for r in url_rules.judge(pages).collect()}
    assert got == dict(enumerate(cases.values()))
    assert url_rules.judge(pages).count() == len(rows)


def test_contained_detections_are_dropped():
    scan = license_scan.Scanner()
    assert len(scan.rules) > 200
    base, found = scan(b"this is licensed under the gnu lesser general public license, version 2.1 or the mit license.")
    assert [label for _, label in base] == ["mit"]
    assert [r.label for *_, r in sorted(found, key=lambda d: d[0])] == ["lgpl", "mit"]


def test_keywords_pass_all_detections(spark):
    plain = [
        "All rights reserved", "put in the public domain", "without any warranty", "copyright (c) 2001", "licensed under the terms of the mit license",
        "spdx-license-identifier: gpl", "gnu lesser general public license version 2.1", "copy of the apache licence", "cc by nc sa 4.0",
        "under the conditions of the university of illinois/ncsa open source license", "do what the fuck you want to public license",
    ]
    texts = [t.replace(" ", gap) for t in plain for gap in (" ", "\n", "\t", "  ", "\r\n ")]
    scanner = license_scan.Scanner()
    expected = {}
    for i, text in enumerate(texts):
        low = text.lower().encode()
        every = license_scan.surviving([(*m.span(), rule) for rule in scanner.rules for m in re.finditer(rule.pattern, low)])
        assert every, text
        expected[i] = sorted((a, b, r.label, r.priority) for a, b, r in every)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: sorted((d.start, d.end, d.label, d.priority) for d in r.detections) for r in license_scan.scan(docs).collect()}
    assert got == expected


def test_whole_queries_of_an_empty_table(nothing):
    assert search.search(nothing, nothing["doc_id"] % 20 == 0).count() == 0


def test_empty_tables(spark, nothing):
    assert substring_dedup.remove_repeats(nothing).count() == 0
    assert suffix_dedup.remove_repeats(nothing).count() == 0
    assert jaccard_join.near_groups(nothing)[1].count() == 0
    assert jaccard_join.one_of_each(nothing).count() == 0
    assert mixing.mix(nothing)[1].count() == 0 and mixing.mixed(nothing).count() == 0
    assert search.search(nothing, nothing["doc_id"] % 20 == 0).count() == 0
    assert license_scan.scan(nothing).count() == 0
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embedding_dedup.near_vectors(vectors).count() == 0
    assert url_rules.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_texts_are_awkward():
    assert len(awkward_texts()) > 50


@pytest.mark.parametrize("text", ["", "the same words again"])
def test_labelled_texts_that_are_all_alike(spark, text):
    docs = spark.createDataFrame([(i, text) for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    rows = quality.score(docs, quality.fit(docs, labels)).collect()
    assert len(rows) == 40 and len({r.score for r in rows}) == 1 and 0 <= rows[0].score <= 1


def test_scores_are_those_of_class_densities(spark):
    """The discriminant against densities worked out from the statistics themselves."""
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["one", "two", "three,", "4", "#", "|"][: 3 + 3 * (i % 2)]) for _ in range(rng.randint(20, 90))) for i in range(120)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(120)], "doc_id long, quality int")
    rows = {r.doc_id: r for r in quality.score(docs, quality.fit(docs, labels)).collect()}
    x = quality.statistics(pa.chunked_array([pa.array(texts)]))
    known = [np.array([i for i in range(120) if 1 - i % 2 == k and not rows[i].held_out]) for k in (0, 1)]
    pooled = sum(x[i].var(axis=0) * len(i) for i in known) / sum(map(len, known))
    density = []
    for i in known:
        covariance = (1 - quality.SHRINKAGE) * np.cov(x[i].T, bias=True)
        covariance += np.diag(quality.SHRINKAGE * pooled + quality.FLOOR * pooled.max() + quality.LEAST_VARIANCE)
        off = x - x[i].mean(axis=0)
        density.append(-0.5 * (off * np.linalg.solve(covariance, off.T).T).sum(axis=1) - 0.5 * np.linalg.slogdet(covariance)[1] + math.log(len(i)))
    expected = 1 / (1 + np.exp(-np.clip(density[1] - density[0], -500, 500)))
    assert np.allclose([rows[i].score for i in range(120)], expected, atol=1e-6)


def test_mixed_documents_keep_columns_of_any_name(spark):
    rows = [(i, f"word {i} and more", f"s{i % 3}", i, "x", "y", "z") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n long, _uses string, _digest string, uses string")
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    assert {tuple(r) for r in mixed.collect()} <= {tuple(r) for r in docs.collect()} and mixed.count() > 30


def test_many_notices_in_one_text():
    rng = random.Random(2)
    some = license_scan.rules()[:40]
    found = [(a, a + rng.randint(1, 60), rng.choice(some)) for a in (rng.randrange(1200) for _ in range(1500))]
    order = sorted(found, key=lambda d: (-d[2].priority, d[0] - d[1], d[0], d[2].label))
    kept = []
    for a, z, rule in order:
        if not any(x <= a and z <= y for x, y, _ in kept):
            kept.append((a, z, rule))
    assert license_scan.surviving(found) == kept
    notices = b"this work is licensed under the gnu general public license, version 3. " * 70_000
    _, detections = license_scan.Scanner()(notices)
    assert len(detections) == 70_000
