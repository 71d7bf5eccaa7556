from __future__ import annotations

import random

import pytest

WORDS = [f"w{i}" for i in range(400)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, block_id long, rid string, component string"


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) for _ in range(n))


def awkward_texts() -> list[str | None]:
    """Nulls, empty and white texts, copies, near copies, repeats inside a text, shared passages, and a very long text."""
    rng = random.Random(7)
    passage, base = prose(rng, 90), prose(rng, 120)
    near = base.split()
    near[60] = "other"
    longest = prose(rng, 6000)
    # a very regular word, and the same with its two letters swapped
    regular = "".join("ab"[bin(i).count("1") & 1] for i in range(1024))
    swapped = regular.translate(str.maketrans("ab", "ba"))
    return [
        None, "", "  \n\t ", "one", "one", "ONE two", base, base, " ".join(near), base.upper(), f"{prose(rng, 40)} {passage} {prose(rng, 30)}",
        f"{passage}\n{prose(rng, 50)}", f"{prose(rng, 10)} {passage} x {passage}", longest, longest + " end", "a" * 5000, "é" * 900 + " ß " + "é" * 900,
        "ab " * 700, prose(rng, 34), prose(rng, 35), "gnu general public license \x00 cc by", "x" * 399, "y" * 400,
        *(f"{prose(rng, rng.randint(1, 200))}" for _ in range(30)),
        regular, swapped, f"{base[:60]} {regular} {base[60:160]}", f"{base[:60]} {swapped} {base[60:160]}",
    ]


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents whose other columns have the names that operators use, with null and repeated ids and repeated rows."""
    texts = awkward_texts()
    rows = [(i, t, None if i % 5 == 0 else "en", None if i % 7 == 0 else f"s{i % 4}", i, i, "rid", None) for i, t in enumerate(texts)]
    rows += [rows[6], rows[6], (3, "one more of the same id", None, "é", 0, None, None, None), (None, texts[10], "en", "s1", 1, 1, "", "")]
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
