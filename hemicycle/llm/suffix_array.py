"""Two-stage suffix sorting of the window starts of many strings at once, and their adjacent common prefixes.

First only suffixes smaller than their successor are sorted, by content. The others follow by induction: buckets of the
first byte are scanned in order, and the suffix before each scanned one, if larger than it, takes the next place of
its own bucket. Suffixes compare by their first DEPTH bytes; equal ones keep the order of their places.
"""

from __future__ import annotations

import numpy as np

#: Bytes by which suffixes are compared: the window.
DEPTH = 400
#: Bytes that a string should have after the last window, so that its last windows have sorted successors.
MARGIN = 16


class SuffixArray:
    """Suffixes of ``strings``: those that start in the first ``windows[i]`` bytes of string i, each with DEPTH bytes.

    Zeros after a string stand for its end. They are appended where no byte after the last window is smaller than its
    successor; else the sorting needs no bytes past the string.
    """

    def __init__(self, strings: list[bytes], windows: list[int]):
        parts, starts, at = [], [], 0
        for text, n in zip(strings, windows, strict=True):
            starts.append(at)
            parts.append(text)
            at += len(text)
            if not any(text[i] < text[i + 1] for i in range(n, len(text) - DEPTH)):
                parts.append(bytes(DEPTH + 8))
                at += DEPTH + 8
        parts.append(bytes(2 * DEPTH + 8 + max(map(len, strings), default=0)))
        whole = b"".join(parts)
        self.bytes = np.frombuffer(whole, np.uint8)
        self.words = np.ndarray((len(whole) - 7,), ">u8", whole, strides=(1,))
        self.starts, self.windows = np.array(starts), np.array(windows)
        self.rising = self._rising()
        self._places()

    def _rising(self) -> np.ndarray:
        """Which suffixes are smaller than their successor; those of zeros up to the end count as such."""
        t = self.bytes
        step = np.append(t[1:].astype(np.int16) - t[:-1], 1)
        turn = np.where(step != 0, np.arange(len(t)), len(t) - 1)
        turn = np.minimum.accumulate(turn[::-1])[::-1]
        return step[turn] > 0

    def _places(self) -> None:
        """The places to sort: windows, and on to the first rising suffix after the last window."""
        up = np.where(self.rising, np.arange(len(self.bytes)), len(self.bytes) - 1)
        up = np.minimum.accumulate(up[::-1])[::-1]
        count = up[self.starts + self.windows] - self.starts + 1
        ends = np.cumsum(count)
        self.owner = np.repeat(np.arange(len(count)), count)
        self.offset = np.arange(ends[-1] if len(ends) else 0) - (ends - count)[self.owner]
        self.places = self.starts[self.owner] + self.offset
        self.valid = self.offset < self.windows[self.owner]
        self.member = np.zeros(len(self.bytes) + 1, bool)
        self.member[self.places] = True

    def word(self, at: np.ndarray) -> np.ndarray:
        return self.words[at].astype(np.uint64)

    def direct(self) -> np.ndarray:
        """Rising suffixes by content, eight bytes a round; only suffixes that still tie go on."""
        at = self.places[self.rising[self.places]]
        word = self.word(at)
        order = np.argsort(word, kind="stable")
        at, word = at[order], word[order]
        new = np.ones(len(at), bool)
        new[1:] = word[1:] != word[:-1]
        tied = None
        for depth in range(8, DEPTH, 8):
            if tied is None:
                tied = np.flatnonzero(~new | np.append(~new[1:], False))
                first = new[tied]
                group = np.cumsum(first) - 1
            if not len(tied):
                break
            here = at[tied]
            word = self.word(here + depth)
            apart = (word[1:] != word[:-1]) & ~first[1:]
            if not apart.any():
                continue
            open_ = np.zeros(group[-1] + 1, bool)
            open_[group[1:][apart]] = True
            some = open_[group]
            rows, word, group_ = tied[some], word[some], group[some]
            order = np.lexsort((word, group_))
            at[rows] = here[some][order]
            word = word[order]
            new[rows[1:]] = (word[1:] != word[:-1]) | (group_[1:] != group_[:-1])
            tied = None
        return at

    def order(self) -> np.ndarray:
        """All places in suffix order."""
        rising = self.direct()
        t, member = self.bytes, self.member
        ends = np.searchsorted(t[rising], np.arange(257), "left")
        induced: list[list[np.ndarray]] = [[] for _ in range(256)]
        out = []
        for byte in range(256):
            fresh = np.concatenate(induced[byte]) if induced[byte] else np.zeros(0, np.int64)
            scanned = []
            while len(fresh):  # runs of this byte: the suffix before is in this bucket too
                scanned.append(fresh)
                before = fresh - 1
                fresh = before[(before >= 0) & member[before] & (t[before] == byte)]
            scanned.append(rising[ends[byte] : ends[byte + 1]])
            bucket = np.concatenate(scanned)
            out.append(bucket)
            before = bucket - 1
            before = before[(before >= 0) & member[before] & (t[before] > byte)]
            if len(before):
                first = t[before]
                by = np.argsort(first, kind="stable")
                before, first = before[by], first[by]
                at = np.flatnonzero(np.append(True, first[1:] != first[:-1]))
                for part in np.split(before, at[1:]):
                    induced[t[part[0]]].append(part)
        return np.concatenate(out)

    def equal_to_previous(self, order: np.ndarray) -> np.ndarray:
        """Whether each suffix of the order shares DEPTH bytes with the one before it.

        Common prefixes shrink by one from a place to the next while the neighbour moves along, so only the first of
        such a run of places is compared.
        """
        near = np.full(len(self.bytes) + 1, -1)
        near[order[1:]] = order[:-1]
        places = self.places
        along = np.zeros(len(places), bool)
        along[1:] = (places[1:] == places[:-1] + 1) & (near[places[1:]] == near[places[:-1]] + 1) & (near[places[:-1]] >= 0)
        head = np.flatnonzero(~along)
        run = np.diff(np.append(head, len(places)))
        at, other = places[head], near[places[head]]
        shared = np.zeros(len(head), np.int64)
        active = np.flatnonzero(other >= 0)
        while len(active):
            # the run ends before either string's zeros do, so that many bytes are there
            a, b = at[active] + shared[active], other[active] + shared[active]
            same = self.word(a) == self.word(b)
            shared[active[same]] += 8
            rest = active[~same]
            if len(rest):
                x, y = at[rest] + shared[rest], other[rest] + shared[rest]
                alike = np.ones(len(rest), bool)
                for k in range(8):
                    alike &= self.bytes[x + k] == self.bytes[y + k]
                    shared[rest] += alike
            active = active[same]
            active = active[shared[active] < DEPTH + run[active]]
        left = np.repeat(shared, run) - (np.arange(len(places)) - np.repeat(head, run))
        equal = np.zeros(len(self.bytes) + 1, bool)
        equal[places] = left >= DEPTH
        found = equal[order]
        found[:1] = False
        return found

    def repeated(self, weight: np.ndarray) -> list[np.ndarray]:
        """For each string, which of its windows occur at least twice, when string i stands for ``weight[i]`` ones."""
        order = self.order()
        group = np.cumsum(~self.equal_to_previous(order)) - 1
        of = np.empty(len(self.bytes) + 1, np.int64)
        of[order] = group
        group = of[self.places]
        held = np.bincount(group[self.valid], weights=weight[self.owner[self.valid]], minlength=len(order))
        again = (held[group] >= 2)[self.valid]
        return np.split(again, np.cumsum(self.windows)[:-1])
