"""A generalised suffix automaton over the words of many test items."""

from __future__ import annotations

from itertools import repeat

import numpy as np

#: Lower case, and everything that is no letter, digit or non-ASCII byte a blank.
_KEPT = set(range(0x30, 0x3A)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
WORDS = bytes((b | 0x20) if 0x41 <= b <= 0x5A else b if b in _KEPT else 0x20 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORDS).split()


class Automaton:
    """All substrings of the items' word sequences, and which items each window occurs in.

    A window is ``window`` consecutive words, or the whole of a shorter item.
    """

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        sequences = []
        for name, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words_of(text)]
            if ids:
                sequences.append((name, ids))
                self._insert(ids)
        self.shortest = min([window, *(len(ids) for _, ids in sequences)])
        self.whole: list[set[str] | None] = [None] * len(self.next)
        self.short: list[list[tuple[int, str]] | None] = [None] * len(self.next)
        for name, ids in sequences:
            self._mark(name, ids)
        # What holds for a state's suffixes holds for the state: pass it on, shortest first.
        for v in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            up = self.link[v]
            if self.length[up] >= window:
                self.whole[v] = self.whole[up]
            if self.short[up]:
                self.short[v] = (self.short[v] or []) + self.short[up]

    def _insert(self, ids: list[int]) -> None:
        nxt, link, length, last = self.next, self.link, self.length, 0
        for c in ids:
            if c in nxt[last]:
                q = nxt[last][c]
                last = q if length[q] == length[last] + 1 else self._clone(last, c, q)
                continue
            new = len(nxt)
            nxt.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in nxt[p]:
                nxt[p][c] = new
                p = link[p]
            if p >= 0:
                q = nxt[p][c]
                link[new] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
            last = new

    def _clone(self, p: int, c: int, q: int) -> int:
        clone = len(self.next)
        self.next.append(dict(self.next[q]))
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def _mark(self, name: str, ids: list[int]) -> None:
        """Note the item at the states of its windows."""
        state, size = 0, min(self.window, len(ids))
        for i, c in enumerate(ids):
            state = self.next[state][c]
            if i + 1 < size:
                continue
            while self.length[self.link[state]] >= size:
                state = self.link[state]
            if size == self.window:
                if self.whole[state] is None:
                    self.whole[state] = set()
                self.whole[state].add(name)
            else:
                self.short[state] = (self.short[state] or []) + [(size, name)]

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Ranges of words inside occurrences of windows, and the items these belong to."""
        if not self.vocabulary or len(words) < self.shortest:
            return [], set()
        ids = np.fromiter(map(self.vocabulary.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        # Only runs of words that the items know can hold a window.
        edge = np.flatnonzero(np.diff(np.concatenate([[False], ids >= 0, [False]])))
        begin, end = edge[::2], edge[1::2]
        long = end - begin >= self.shortest
        ranges: list[tuple[int, int]] = []
        found: set[str] = set()
        for a, b in zip(begin[long].tolist(), end[long].tolist()):
            self._stream(ids[a:b].tolist(), a, ranges, found)
        return ranges, found

    def _stream(self, ids: list[int], at: int, ranges: list[tuple[int, int]], found: set[str]) -> None:
        nxt, link, length, window = self.next, self.link, self.length, self.window
        state, matched = 0, 0
        for i, c in enumerate(ids, at + 1):
            while state and c not in nxt[state]:
                state = link[state]
                matched = length[state]
            if c in nxt[state]:
                state = nxt[state][c]
                matched += 1
            best = 0
            if matched >= window:
                # The items of the last `window` words; states below that length share a suffix.
                found |= self.whole[state]
                best = window
            for size, name in self.short[state] or ():
                if size <= matched:
                    found.add(name)
                    best = max(best, size)
            if best:
                if ranges and ranges[-1][1] >= i - best:
                    start = min(ranges.pop()[0], i - best)
                    while ranges and ranges[-1][1] >= start:
                        start = min(start, ranges.pop()[0])
                    ranges.append((start, i))
                else:
                    ranges.append((i - best, i))
