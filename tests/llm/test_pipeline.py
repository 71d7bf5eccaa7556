"""Every stage of the pipeline against brute force over its own input."""

from __future__ import annotations

from collections import Counter

import pytest
from test_operators import groups, shingles, words_of

import corpus_pipeline
from hemicycle.llm import quality

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    frames = [spark.read.parquet(f"{SF_DIR}/documents.parquet")]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, frames[-1], SF_DIR).write.parquet(f"{folder}/{k}")
        frames.append(spark.read.parquet(f"{folder}/{k}"))
    return frames


def test_columns(stages):
    assert len(corpus_pipeline.STAGES) == 5
    assert all(f.columns == stages[0].columns and f.dtypes == stages[0].dtypes for f in stages[:5])
    assert all(f.count() > 0 for f in stages)


def test_quality_drops_what_scores_below(spark, stages):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    scores = quality.score(stages[0], quality.fit(stages[0], labels)).collect()
    assert sorted(r.doc_id for r in stages[1].collect()) == sorted(r.doc_id for r in scores if r.score >= 0.7)
    known = {r.doc_id: r.quality for r in labels.collect()}
    kept = {r.doc_id for r in stages[1].collect()}
    clean = [d for d, q in known.items() if q == 1]
    assert sum(d in kept for d in clean) >= 0.95 * len(clean)


def test_one_of_each_group_stays(stages):
    rows = stages[1].collect()
    member = groups([shingles(r.text, 5) for r in rows], 80)
    first = {}
    for r, m in zip(rows, member, strict=True):
        first[m] = min(first.get(m, r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted(first.values())


def test_passages_go(stages):
    rows = stages[2].collect()
    seen = Counter(tuple(w[i : i + 35]) for r in rows for w in [words_of(r.text)] for i in range(len(w) - 34))
    expected = {}
    for r in rows:
        w = words_of(r.text)
        gone = {p for i in range(len(w) - 34) if seen[tuple(w[i : i + 35])] > 1 for p in range(i, i + 35)}
        expected[r.doc_id] = " ".join(x for p, x in enumerate(w) if p not in gone)
    assert {r.doc_id: r.text for r in stages[3].collect()} == expected
    assert all(r.n_chars == len(r.text) for r in stages[3].collect())


def test_sources_are_mixed(stages):
    before = {r.doc_id: r for r in stages[3].collect()}
    uses = Counter(r.doc_id for r in stages[4].collect())
    assert all(n <= 2 and words_of(before[d].text) for d, n in uses.items())
    size = Counter()
    for r in before.values():
        size[r.source] += len(words_of(r.text))
    names = sorted(size)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, free, left = {}, set(names), 1.5 * sum(size.values())
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 2 * size[s]}
        if not over:
            break
        target |= {s: 2 * size[s] for s in over}
        left, free = left - sum(2 * size[s] for s in over), free - over
    target |= share
    taken = Counter()
    for d, n in uses.items():
        taken[before[d].source] += n * len(words_of(before[d].text))
    largest = Counter()
    for r in before.values():
        largest[r.source] = max(largest[r.source], len(words_of(r.text)))
    assert all(abs(taken[s] - target[s]) <= largest[s] + 1 for s in names)


def test_ids_are_those_of_the_library(stages):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = {r.doc_id: r.text for r in stages[4].collect()}
    for r in stages[5].collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.ids == ids and r.n_tokens == len(ids)


def test_the_query_runs_all_stages(spark, stages):
    assert corpus_pipeline.run(spark, SF_DIR).count() == stages[5].count()
