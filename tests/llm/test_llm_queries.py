"""Registered queries of the operators against SQL, brute force, a library or held-out labels."""

from __future__ import annotations

import hashlib
import re
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from compare import connect, difference

from corpus_pipeline import CHECKS, QUERIES

SMALL = "/root/testdata/sf0.001"
#: As SQL takes long over all texts of the larger table, it is the smallest here; the driver compares at sf0.01.
PHRASES = {"gpl": "gnu general public license", "apache": "apache license", "cc-by": "cc by", "mit": "mit license"}


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_matches_sql(spark, duck, name):
    problem, _ = difference(spark, duck, SMALL, QUERIES[name], CHECKS[name])
    assert problem is None


def test_all_are_registered():
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES if n.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in QUERIES


def test_quality_is_right_on_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = QUERIES["op4_quality_classifier"](spark, sf_dir).collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in held) >= 0.97 * len(held) > 0
    clean = [r for r in held if labels[r.doc_id] == 1]
    assert sum(r.predicted for r in clean) >= 0.97 * len(clean)


def test_ids_are_those_of_the_library(spark):
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for row in QUERIES["op7_bpe_codec"](spark, SMALL).collect():
        ids = library.encode(texts[row.doc_id] or "", add_special_tokens=False).ids
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def brute_places(text: str | None) -> tuple[int, list[tuple[int, str]]]:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    found = []
    for label, phrase in PHRASES.items():
        parts = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    return len(words), found


def test_base_phrases_are_those_of_brute_force(spark, awkward):
    from hemicycle.llm.license_scan import scan

    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for rows, texts in (
        (QUERIES["op9_license_scan"](spark, sf_dir).collect(), docs.collect()),
        (scan(awkward).where("doc_id > 3").collect(), awkward.where("doc_id > 3").collect()),
    ):
        expected = sorted((t.doc_id, *brute_places(t.text)) for t in texts)
        for row, (doc_id, n, found) in zip(sorted(rows, key=lambda r: (r.doc_id, r.n_words)), sorted(expected, key=lambda e: e[:2]), strict=True):
            starts = [i for i, _ in found]
            labels = ",".join(sorted({x for _, x in found}))
            assert (row.doc_id, row.n_words, row.n_base, row.base_labels) == (doc_id, n, len(found), labels)
            assert (row.first_word, row.last_word) == ((min(starts), max(starts)) if starts else (None, None))
            assert {x for _, x in found} <= set(row.labels.split(",")) and 0 <= row.score <= 1
