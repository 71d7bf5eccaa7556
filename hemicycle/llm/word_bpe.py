"""Encoding with a vocabulary of merged words through a minimal acyclic transducer, and decoding.

The most frequent words of the corpus are merged once and compiled into an acyclic automaton that shares equal endings.
Each transition carries how many words come before it, so the sum along a path is the word's number and leads to its
ids. Tasks map the automaton into memory and look up all words of a slice at once; words that it lacks are merged by
the rules of the vocabulary. Both ways give the same ids, so the size of the lexicon changes no result.

Defined results: null and empty texts have no ids and decode to an empty text; words of any length are merged whole;
special tokens are found in the raw text; null ids and repeated rows are encoded each; extra columns are not read. An
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import tempfile
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hemicycle.llm.storage import cut, slices

#: Words in the lexicon, and results that a task keeps for words outside it.
LEXICON, KEPT = 32_768, 400_000
#: Bytes up to which words are merged together, a merge of each at a time; longer ones are merged one by one.
SHORT = 32
NEVER = 1 << 30


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself where it prints, else the next letter from U+0100 on."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in prints else chr(next(rest)) for b in range(256)]


@dataclass
class Vocabulary:
    """What a tokenizer file says: ids by token, the rank and result of each merge, the word pattern, special tokens."""

    tokens: list[str]
    first: list[int]  # id of a byte inside a word
    last: list[int]  # id of a byte at its end
    merges: dict[tuple[int, int], tuple[int, int]]
    pattern: str
    special: dict[str, int]

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        spec = json.loads(Path(path).read_text(encoding="utf-8"))
        ids, end = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        tokens = [""] * (1 + max(*ids.values(), *special.values()))
        for token, number in (ids | special).items():
            tokens[number] = token
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        merges = {(ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in enumerate(pairs)}
        letters = byte_letters()
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        return cls(tokens, [ids[c] for c in letters], [ids[c + end] for c in letters], merges, pattern, special)

    def merge(self, word: bytes) -> list[int]:
        """Ids of a word: the merge of lowest rank first, the leftmost of equal ones."""
        ids = [self.first[b] for b in word[:-1]] + [self.last[b] for b in word[-1:]]
        n = len(ids)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(*self.merges[p], i, p) for i, p in enumerate(zip(ids, ids[1:], strict=False)) if p in self.merges]
        heapq.heapify(heap)
        while heap:
            _, new, i, pair = heapq.heappop(heap)
            j = after[i] if alive[i] else n
            if j >= n or (ids[i], ids[j]) != pair:
                continue
            ids[i], alive[j], after[i] = new, False, after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (ids[a], ids[b]) in self.merges:
                    heapq.heappush(heap, (*self.merges[ids[a], ids[b]], a, (ids[a], ids[b])))
        return [x for x, a in zip(ids, alive, strict=True) if a]


WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def latin(kind: str) -> str:
    """The letters or numbers below U+0100, for a character class."""
    return "".join(re.escape(chr(c)) for c in range(256) if unicodedata.category(chr(c))[0] == kind)


class Merger:
    """Merges many words at once."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.size = vocabulary, len(vocabulary.tokens)
        pairs = sorted((a * self.size + b, rank, new) for (a, b), (rank, new) in vocabulary.merges.items())
        self.pairs, self.ranks, self.new = (np.array(x, np.int64) for x in zip(*pairs, strict=True)) if pairs else [np.zeros(0, np.int64)] * 3
        self.first, self.last = np.array(vocabulary.first, np.int64), np.array(vocabulary.last, np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of merging, or NEVER; ids below 0 are no ids."""
        if not len(self.pairs):
            return np.full(left.shape, NEVER), np.zeros(left.shape, np.int64)
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where((self.pairs[at] == key) & (left >= 0) & (right >= 0), self.ranks[at], NEVER), self.new[at]

    def __call__(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word as little-endian bytes."""
        out = [b""] * len(words)
        lengths = np.array([len(w) for w in words], np.int64)
        for i in np.flatnonzero(lengths > SHORT).tolist():
            out[i] = np.array(self.vocabulary.merge(words[i]), "<u4").tobytes()
        here = np.flatnonzero(lengths <= SHORT)
        here = here[np.argsort(lengths[here], kind="stable")]  # words of like lengths make narrow tables
        for some in np.array_split(here, len(here) // 10_000 + 1):
            ids = self.together([words[i] for i in some.tolist()])
            ends = 4 * np.cumsum((ids >= 0).sum(axis=1))
            flat = ids[ids >= 0].astype("<u4").tobytes()
            for i, a, b in zip(some.tolist(), [0, *ends.tolist()], ends.tolist(), strict=False):
                out[i] = flat[a:b]
        return out

    def together(self, words: list[bytes]) -> np.ndarray:
        """Rows of ids, with -1 after the last."""
        n = np.array([len(w) for w in words], np.int64)
        width = int(n.max(initial=0)) + 1
        place = np.arange(width)
        ids = np.full((len(words), width), -1, np.int64)
        ids[place < n[:, None]] = self.first[np.frombuffer(b"".join(words), np.uint8)]
        full = np.flatnonzero(n)
        ids[full, n[full] - 1] = self.last[[words[i][-1] for i in full.tolist()]]
        ranks, new = self.rank(ids[:, :-1], ids[:, 1:])
        active = np.arange(len(words))
        while len(active):
            r = ranks[active]
            at = r.argmin(axis=1)
            found = r[np.arange(len(active)), at] < NEVER
            active, at = active[found], at[found]
            row = np.arange(len(active))
            old, left = ids[active], new[active, at]
            moved = np.concatenate([old[:, 1:], np.full((len(active), 1), -1)], axis=1)
            ids[active] = now = np.where(place > at[:, None], moved, old)
            now[row, at] = ids[active, at] = left
            for table in (ranks, new):
                old = table[active]
                moved = np.concatenate([old[:, 1:], np.full((len(active), 1), NEVER if table is ranks else 0)], axis=1)
                table[active] = np.where(place[:-1] > at[:, None], moved, old)
            for i in (np.maximum(at - 1, 0), at):
                ranks[active, i], new[active, i] = self.rank(now[row, i], now[row, np.minimum(i + 1, width - 1)])
        return ids


class Splitter:
    """Words and special tokens of a text, normalised as the vocabulary asks: composed, in lower case, white space dropped."""

    def __init__(self, pattern: str, special: Iterable[str]):
        self.every = regex.compile(pattern.replace(r"\s", WHITE))
        self.controls = re.compile("[\x1c-\x1f]")
        near = pattern.replace(r"\s", "\t-\r \x85\xa0").replace(r"\p{L}", latin("L")).replace(r"\p{N}", latin("N"))
        self.latin = re.compile(near)  # the same for texts below U+0100, and faster
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")")
        self.marks = [s for s in special if s]

    def words(self, chunk: str) -> list[str]:
        """The words of a normalised text."""
        return (self.latin if chunk.isascii() or max(chunk) < "\u0100" else self.every).findall(chunk)

    def normal(self, text: str) -> str:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # each letter by itself, so no final sigma
        return text.lower()

    def plain(self, text: str) -> list[str]:
        text = self.normal(text)
        # str.split also splits at four control characters that are no white space here
        return self.words(text) if self.controls.search(text) else text.split()

    def __call__(self, text: str) -> list[str | tuple[str]]:
        """Pieces between white space, which no word crosses, as strings, and special tokens as tuples."""
        if not any(m in text for m in self.marks):
            return self.plain(text)
        out: list[str | tuple[str]] = []
        for i, part in enumerate(self.special.split(text)):
            out += [(part,)] if i % 2 else self.plain(part)
        return out


def compile_lexicon(entries: dict[bytes, list[int]]) -> bytes:
    """A minimal acyclic automaton over the words in order, as flat arrays behind their lengths."""
    words = sorted(entries)
    register: dict[tuple, int] = {}
    nodes: list[tuple] = []  # (final, ((byte, node), ...)), children before parents

    def close(state: list) -> int:
        key = (state[0], tuple(state[1]))
        if key not in register:
            register[key] = len(nodes)
            nodes.append(key)
        return register[key]

    path: list[list] = [[False, []]]  # states along the last word
    last = b""

    def fold(down_to: int) -> None:
        while len(path) > down_to + 1:
            state = path.pop()
            path[-1][1].append((last[len(path) - 1], close(state)))

    for word in words:
        common = next((i for i, (a, b) in enumerate(zip(last, word, strict=False)) if a != b), min(len(last), len(word)))
        fold(common)
        path += [[False, []] for _ in range(len(word) - common)]
        path[-1][0] = True
        last = word
    fold(0)
    root = close(path[0])
    below = np.zeros(len(nodes), np.int64)
    keys, targets, skips = [], [], []
    for number, (final, children) in enumerate(nodes):
        below[number] = final
        for byte, child in children:
            keys.append(number << 8 | byte)
            targets.append(child)
            skips.append(below[number])
            below[number] += below[child]
    bounds = np.cumsum([0, *(len(entries[w]) for w in words)])
    arrays = [
        np.array([root]), np.array([f for f, _ in nodes]), np.array(keys), np.array(targets), np.array(skips), bounds,
        np.array([i for w in words for i in entries[w]]),
    ]
    return np.array([len(a) for a in arrays], np.int64).tobytes() + b"".join(a.astype(np.int64).tobytes() for a in arrays)


class Lexicon:
    """The automaton, mapped from a file of the task's own that goes when it is closed."""

    def __init__(self, data: bytes):
        self.file = tempfile.TemporaryFile()
        self.file.write(data)
        self.file.flush()
        whole = np.asarray(np.memmap(self.file, np.int64, "r"))
        ends = 7 + np.cumsum(whole[:7])
        root, self.final, self.keys, self.targets, self.skips, self.bounds, self.ids = (whole[e - n : e] for e, n in zip(ends, whole[:7], strict=True))
        self.root = int(root[0])
        self.bounds, self.codes = self.bounds.tolist(), self.ids.astype("<u4").tobytes()

    def find(self, words: list[bytes]) -> list[bytes | None]:
        """Ids of each word as little-endian bytes, or None; all words advance together, byte by byte."""
        lengths = np.array([len(w) for w in words])
        data = np.frombuffer(b"".join(words), np.uint8)
        start = np.cumsum(lengths) - lengths
        state, number = np.full(len(words), self.root), np.zeros(len(words), np.int64)
        here = np.arange(len(words)) if len(self.keys) else np.zeros(0, np.int64)
        depth, alive = 0, np.full(len(words), bool(len(self.keys)))
        while len(here := here[lengths[here] > depth]):
            key = state[here] << 8 | data[start[here] + depth]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            alive[here[~hit]] = False
            here, at = here[hit], at[hit]
            number[here] += self.skips[at]
            state[here] = self.targets[at]
            depth += 1
        alive &= self.final[state] > 0
        return [self.codes[4 * self.bounds[k] : 4 * self.bounds[k + 1]] if ok else None for ok, k in zip(alive.tolist(), number.tolist(), strict=True)]


class Coder:
    """Ids of words, from the lexicon or by merging, as little-endian bytes; kept for the pieces of texts."""

    def __init__(self, vocabulary: Vocabulary, lexicon: bytes):
        self.vocabulary, self.lexicon = vocabulary, Lexicon(lexicon)
        self.merge = Merger(vocabulary)
        self.split = Splitter(vocabulary.pattern, vocabulary.special)
        self.special = {(s,): np.array([i], "<u4").tobytes() for s, i in vocabulary.special.items()}
        tokens = [t.encode() + b" " for t in vocabulary.tokens]
        self.tokens = np.frombuffer(b"".join(tokens), np.uint8)
        self.lengths = np.array([len(t) - 1 for t in tokens])
        self.starts = np.cumsum(self.lengths + 1) - self.lengths - 1
        self.forget()

    def forget(self) -> None:
        self.codes: dict[str | tuple[str], bytes] = dict(self.special)

    def learn(self, pieces: set) -> None:
        if len(self.codes) > KEPT:
            self.forget()
        new = pieces - self.codes.keys()
        mixed = {piece: self.split.words(piece) for piece in new if not piece.isalpha()}  # letters only are one word
        words = [*(new - mixed.keys()), *(set().union(*mixed.values()) - self.codes.keys() - new)]
        words += [p for p, of in mixed.items() if of == [p]]
        encoded = [w.encode() for w in words]
        found = self.lexicon.find(encoded)
        unseen = [i for i, ids in enumerate(found) if ids is None]
        for i, ids in zip(unseen, self.merge([encoded[i] for i in unseen]), strict=True):
            found[i] = ids
        self.codes.update(zip(words, found, strict=True))
        for piece, of in mixed.items():
            if len(of) > 1:
                self.codes[piece] = b"".join(map(self.codes.__getitem__, of))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        split = [self.split(t) if t else [] for t in texts]
        self.learn(set().union(*split))
        return [b"".join(map(self.codes.__getitem__, pieces)) for pieces in split]

    def decode(self, codes: list[bytes]) -> list[bytes]:
        """The tokens of each text, joined by spaces, as UTF-8; all texts at once."""
        ids = np.frombuffer(b"".join(codes), "<u4")
        lengths = self.lengths[ids] + 1  # and a space
        ends = np.cumsum(lengths)
        source = np.repeat(self.starts[ids] - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)
        whole = self.tokens[source].tobytes()
        bounds = np.concatenate([[0], ends])[np.cumsum([0, *(len(c) // 4 for c in codes)])].tolist()
        return [whole[a : max(a, b - 1)] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def frequent_words(docs: DataFrame, vocabulary: Vocabulary, most: int = LEXICON) -> list[str]:
    """The words that all texts hold most often: at most ``most``, and all that are as frequent as one of them."""
    pattern, special = vocabulary.pattern, list(vocabulary.special)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = Splitter(pattern, special)
        for table in slices(batches):
            pieces: Counter = Counter()
            for text in table.column("text").to_pylist():
                pieces.update(split(text) if text else ())
            found: Counter = Counter()
            for piece, n in pieces.items():
                if isinstance(piece, str):
                    for word in (piece,) if piece.isalpha() else split.words(piece):
                        found[word] += n
            words = list(found)
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([found[w] for w in words], pa.int64())], ["word", "n"])

    counts = docs.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = cut(counts.where("n > 1"))
    # the least count of which no more than ``most`` words have it or more, on a scale of 16 steps for each doubling
    scale = F.floor(F.log2("n") * 16)
    held, least = 0, None
    for r in sorted(counts.groupBy(scale.alias("step")).agg(F.count("*").alias("words")).collect(), key=lambda r: -r.step):
        held += r.words
        if held > most:
            break
        least = r.step
    if least is None:
        return []
    return sorted(r.word for r in counts.where(scale >= least).select("word").collect())


def encode(docs: DataFrame, path: str, digests: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids) of every text; with ``digests`` (doc_id, n_tokens, ids_sha256, decoded_sha256)."""
    vocabulary = Vocabulary.load(path)
    words = frequent_words(docs, vocabulary)
    raw = [w.encode() for w in words]
    ids = [np.frombuffer(c, "<u4").tolist() for c in Merger(vocabulary)(raw)]
    lexicon = compile_lexicon(dict(zip(raw, ids, strict=True)))
    shared = docs.sparkSession.sparkContext.broadcast((vars(vocabulary), lexicon))  # bounded: one vocabulary, LEXICON words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(Vocabulary(**shared.value[0]), shared.value[1])
        for table in slices(batches):
            texts = table.column("text").to_pylist()
            codes = coder.encode(texts)
            n = pa.array([len(c) // 4 for c in codes], pa.int64())
            columns = {"doc_id": table.column("doc_id").combine_chunks(), "n_tokens": n}
            if digests:
                columns["ids_sha256"] = pa.array([hashlib.sha256(c).hexdigest() for c in codes], pa.string())
                columns["decoded_sha256"] = pa.array([hashlib.sha256(d).hexdigest() for d in coder.decode(codes)], pa.string())
            else:
                ends = np.cumsum([0, *(len(c) // 4 for c in codes)]).astype(np.int32)
                columns["ids"] = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(codes), "<u4").astype(np.int32)))
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    rest = "ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, f"doc_id long, n_tokens long, {rest}")
