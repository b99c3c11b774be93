"""Generalised suffix automaton of word sequences, and matching statistics of streams against it."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np


class SuffixAutomaton:
    """Accepts every substring of the given sequences; no substring crosses from one to the next.

    A state is a class of substrings with the same end positions; ``longest`` is the length of its longest one, and
    ``link`` leads to the class of the longest suffix that ends in more places.
    """

    def __init__(self, sequences: Iterable[Sequence[int]]):
        self.go: list[dict[int, int]] = [{}]
        self.link, self.longest = [-1], [0]
        self.ends: list[list[int]] = []  # for each sequence, the state of each of its prefixes
        for sequence in sequences:
            last, path = 0, []
            for word in sequence:
                last = self._extended(last, word)
                path.append(last)
            self.ends.append(path)

    def _state(self, longest: int, go: dict[int, int], link: int) -> int:
        self.go.append(go)
        self.link.append(link)
        self.longest.append(longest)
        return len(self.go) - 1

    def _split(self, a: int, word: int) -> int:
        """The state for the longest string of ``a`` followed by ``word``, which must exist; cloned where it is too long."""
        b = self.go[a][word]
        if self.longest[b] == self.longest[a] + 1:
            return b
        copy = self._state(self.longest[a] + 1, dict(self.go[b]), self.link[b])
        self.link[b] = copy
        while a >= 0 and self.go[a].get(word) == b:
            self.go[a][word] = copy
            a = self.link[a]
        return copy

    def _extended(self, last: int, word: int) -> int:
        if word in self.go[last]:  # seen before, at the end of another sequence's prefix
            return self._split(last, word)
        new, a = self._state(self.longest[last] + 1, {}, 0), last
        while a >= 0 and word not in self.go[a]:
            self.go[a][word] = new
            a = self.link[a]
        self.link[new] = 0 if a < 0 else self._split(a, word)
        return new

    def shorter_first(self) -> np.ndarray:
        """States in the order of their longest string; a link leads to an earlier one."""
        return np.argsort(np.array(self.longest), kind="stable")

    def stream(self, words: Iterable[int]) -> Iterator[tuple[int, int]]:
        """State and length of the longest match that ends at each word (-1: a word of no sequence)."""
        go, link, longest = self.go, self.link, self.longest
        state = length = 0
        for word in words:
            while (to := go[state].get(word)) is None and state:
                state = link[state]
                length = longest[state]
            if to is None:
                length = 0
            else:
                state, length = to, length + 1
            yield state, length


class Vocabulary:
    """Word hashes of the sequences, as ids 0, 1, ...; all other words are -1."""

    def __init__(self, hashes: np.ndarray):
        self.sorted = np.unique(hashes)
        # The low bits of the hash decide at once for most words that they are in no sequence.
        self.bits = max(16, int(len(self.sorted) * 16).bit_length())
        self.maybe = np.zeros(1 << self.bits, bool)
        self.maybe[(self.sorted & np.uint64((1 << self.bits) - 1)).astype(np.int64)] = True

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(len(hashes), -1, np.int32)
        if len(self.sorted):
            some = np.flatnonzero(self.maybe[(hashes & np.uint64((1 << self.bits) - 1)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.sorted, hashes[some]), len(self.sorted) - 1)
            out[some] = np.where(self.sorted[at] == hashes[some], at, -1)
        return out


def known_runs(ids: np.ndarray, of: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the maximal runs of known words of at least ``least`` words within each text.

    An unknown word takes the automaton back to its root, so matches of that length lie within these runs.
    """
    known = ids >= 0
    n = len(ids)
    cut = np.zeros(n + 1, bool)
    cut[of] = True
    opens = known & (np.concatenate([[True], ~known[:-1]])[:n] | cut[:n])
    closes = known & (np.concatenate([~known[1:], [True]])[:n] | cut[1:])
    a, b = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    long = b - a >= least
    return a[long], b[long]
