"""Byte-level BPE by rank-synchronous array merging.

The pre-tokens of a batch of texts are held as one ragged array of symbols. In every round
each pre-token applies its lowest-ranked pair, at all its places at once; pre-tokens without
a known pair leave the array. As a pair can only hold a symbol that an earlier merge made,
this gives what merging one pair at a time gives.

Pre-tokens are found without a pattern engine: characters are classed (letter, number, white
space, other) by a table, and the rules of the pattern become comparisons of neighbours. Each
pre-token gets a 64-bit hash of its characters; only pre-tokens not seen before are merged.
"""

from __future__ import annotations

import json

import numpy as np
import regex

from ledgerlake.llm.base import ragged, runs, sorted_lookup

LETTER, NUMBER, OTHER, SPACE = 1, 2, 3, 0
#: The endings that the pre-tokenizer's pattern keeps with their apostrophe.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
NONE = np.iinfo(np.int32).max
#: Pre-tokens that a worker remembers; beyond that it starts anew.
REMEMBERED = 1_500_000
COMMON_PLANES = 0x3000

_MIX1, _MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_BASE = 0xA0761D6478BD642F | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in the vocabulary: itself where it is
    printable Latin-1, else the next free character from 256 on."""
    plain = {b for lo, hi in ((33, 126), (161, 172), (174, 255)) for b in range(lo, hi + 1)}
    out, free = [], 256
    for b in range(256):
        out.append(chr(b if b in plain else free))
        free += b not in plain
    return out


def char_classes(upto: int) -> np.ndarray:
    """The class of each code point below ``upto``."""
    out = np.full(upto, OTHER, dtype=np.uint8)
    everything = "".join(chr(c) for c in range(upto) if not 0xD800 <= c < 0xE000)
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", SPACE)):
        found = "".join(regex.findall(pattern, everything))
        out[np.frombuffer(found.encode("utf-32-le"), dtype=np.uint32)] = kind
    return out


class PairTable:
    """Rank of a pair of symbols, by two hash tables without chains: a key is in one of two places."""

    def __init__(self, pairs: np.ndarray, bits: int = 18):
        self.shift = np.uint64(64 - bits)
        for seed in range(1, 100):
            self.factors = [np.uint64((0x9E3779B97F4A7C15 * (2 * seed + 1)) % (1 << 64) | 1),
                            np.uint64((0xC2B2AE3D27D4EB4F * (2 * seed + 5)) % (1 << 64) | 1)]
            if self._place(pairs, 1 << bits):
                return
        raise ValueError("no placement of the pairs found")

    def _place(self, pairs: np.ndarray, size: int) -> bool:
        places = [self._slot(pairs, k).tolist() for k in (0, 1)]
        owner: list[dict[int, int]] = [{}, {}]
        for first in range(len(pairs)):
            i, k = first, 0
            for _ in range(500):
                displaced = owner[k].get(places[k][i])
                owner[k][places[k][i]] = i
                if displaced is None:
                    break
                i, k = displaced, 1 - k
            else:
                return False
        self.keys = [np.full(size, -1, dtype=np.int64) for _ in owner]
        self.ranks = [np.full(size, NONE, dtype=np.int32) for _ in owner]
        for k, place in enumerate(owner):
            at = np.fromiter(place.keys(), dtype=np.int64, count=len(place))
            who = np.fromiter(place.values(), dtype=np.int64, count=len(place))
            self.keys[k][at], self.ranks[k][at] = pairs[who], who
        return True

    def _slot(self, pairs: np.ndarray, k: int) -> np.ndarray:
        return ((pairs.astype(np.uint64) * self.factors[k]) >> self.shift).astype(np.int64)

    def __call__(self, pairs: np.ndarray) -> np.ndarray:
        out = np.full(len(pairs), NONE, dtype=np.int32)
        for k in (0, 1):
            at = self._slot(pairs, k)
            out = np.where(self.keys[k][at] == pairs, self.ranks[k][at], out)
        return out


class ByteBpe:
    """Token ids and counts of whole texts, equal to those of the library for the same file.

    No tokens are added at either end; the strings of special tokens inside a text become
    their single id, as is the library's default.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_pattern = regex.compile(
            "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))) if self.special else None
        self.byte_ids = np.array([vocab[c] for c in byte_alphabet()], dtype=np.int32)
        left = np.array([vocab[a] for a, _ in merges], dtype=np.int64)
        right = np.array([vocab[b] for _, b in merges], dtype=np.int64)
        self.merged = np.array([vocab[a + b] for a, b in merges], dtype=np.int32)
        self.ranks = PairTable(left << 20 | right)
        self.classes = char_classes(COMMON_PLANES)
        self._forget()

    def _forget(self) -> None:
        self.known = np.empty(0, dtype=np.uint64)
        self.known_row = np.empty(0, dtype=np.int64)
        self.known_start = np.zeros(1, dtype=np.int64)
        self.known_ids = np.empty(0, dtype=np.int32)

    # -- pre-tokens ------------------------------------------------------------------------

    def _starts(self, chars: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Where pre-tokens begin. ``first`` marks the first character of each text."""
        if len(chars) and (top := int(chars.max())) >= len(self.classes):
            self.classes = char_classes(0x110000 if top >= 0x10000 else 0x10000)
        kind = self.classes[chars]
        space = kind == SPACE
        last = np.empty(len(chars), dtype=bool)
        last[:-1], last[-1:] = first[1:], True
        follows = np.zeros(len(chars), dtype=bool)  # a non-space of the same text comes next
        follows[:-1] = ~space[1:] & ~first[1:]
        before = np.zeros(len(chars), dtype=bool)  # a white space of the same text comes before
        before[1:] = space[:-1] & ~first[1:]
        changes = np.ones(len(chars), dtype=bool)
        changes[1:] = kind[1:] != kind[:-1]
        blank = chars == 32
        led = np.zeros(len(chars), dtype=bool)  # a blank before belongs to this pre-token
        led[1:] = blank[:-1] & ~first[1:]
        start = np.where(space, ~before | follows, changes & ~led) | first
        mark = np.flatnonzero((chars == 39) & start)
        for ending in CONTRACTIONS if len(mark) else ():
            fits = mark + len(ending) < len(chars)
            at = mark[fits]
            ok = np.ones(len(at), dtype=bool)
            for k, c in enumerate(ending, 1):
                ok &= (chars[at + k] == ord(c)) & ~first[at + k]
            at = at[ok]
            start[at + 1] = False
            after = at + len(ending) + 1
            inside = after < len(chars)
            # What follows the ending begins anew, unless a blank before it already does.
            after = after[inside]
            start[after[kind[after] != SPACE]] = True
            mark = np.setdiff1d(mark, at, assume_unique=True)
        return np.flatnonzero(start)

    def _hashes(self, chars: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        n = len(chars)
        if not hasattr(self, "powers") or len(self.powers) < n + 1:
            size = max(n + 1, 1 << 20)
            self.powers = np.full(size, _BASE, dtype=np.uint64)
            self.inverse = np.full(size, _BASE_INVERSE, dtype=np.uint64)
            self.powers[0] = self.inverse[0] = 1
            np.multiply.accumulate(self.powers, out=self.powers)
            np.multiply.accumulate(self.inverse, out=self.inverse)
        v = (chars.astype(np.uint64) + np.uint64(1)) * _MIX1
        v ^= v >> np.uint64(29)
        v *= _MIX2
        v *= self.powers[:n]
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(v, out=sums[1:])
        out = (sums[start + length] - sums[start]) * self.inverse[start]
        return out ^ (out >> np.uint64(31)) ^ (length.astype(np.uint64) << np.uint64(50))

    # -- merging ---------------------------------------------------------------------------

    def merge(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols left, and how many of each sequence, when no known pair is left."""
        counts = lengths.astype(np.int64).copy()
        left: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # sequence numbers, lengths, symbols
        who = np.arange(len(lengths))
        some = counts > 0
        who, size = who[some], counts[some]
        while len(who):
            begin = np.cumsum(size) - size
            rank = np.full(len(symbols), NONE, dtype=np.int32)
            rank[:-1] = self.ranks(symbols[:-1].astype(np.int64) << 20 | symbols[1:])
            rank[begin + size - 1] = NONE
            least = np.minimum.reduceat(rank, begin)
            going = least < NONE
            if not going.all():
                stays = np.repeat(going, size)
                left.append((who[~going], size[~going], symbols[~stays]))
                symbols, rank = symbols[stays], rank[stays]
                who, size, least = who[going], size[going], least[going]
                if not len(who):
                    break
            hit = rank == np.repeat(least, size)
            # Of hits that overlap, as in a run of one symbol, every other one counts.
            at = np.flatnonzero(hit)
            fresh = np.ones(len(at), dtype=bool)
            fresh[1:] = at[1:] != at[:-1] + 1
            if not fresh.all():
                run = np.flatnonzero(fresh)
                nth = np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))
                at = at[nth % 2 == 0]
            symbols = symbols.copy()
            symbols[at] = self.merged[rank[at]]
            keep = np.ones(len(symbols), dtype=bool)
            keep[at + 1] = False
            gone = np.searchsorted(at, np.append(np.cumsum(size) - size, len(symbols)))
            size = size - np.diff(gone)
            symbols = symbols[keep]
        if not left:
            return np.empty(0, dtype=np.int32), counts
        numbers, sizes = (np.concatenate([x[k] for x in left]) for k in (0, 1))
        flat = np.concatenate([x[2] for x in left])
        counts[numbers] = sizes
        order = np.argsort(numbers, kind="stable")
        begin = np.cumsum(sizes) - sizes
        return flat[ragged(begin[order], sizes[order])], counts

    def _learn(self, hashes: np.ndarray, words: list[bytes]) -> None:
        if len(self.known) + len(hashes) > REMEMBERED:
            self._forget()
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        symbols = self.byte_ids[np.frombuffer(b"".join(words), dtype=np.uint8)]
        ids, counts = self.merge(symbols, lengths)
        rows = len(self.known_start) - 1 + np.arange(len(words))
        self.known_start = np.append(self.known_start, self.known_start[-1] + np.cumsum(counts))
        self.known_ids = np.concatenate([self.known_ids, ids])
        known = np.concatenate([self.known, hashes])
        order = np.argsort(known, kind="stable")
        self.known, self.known_row = known[order], np.concatenate([self.known_row, rows])[order]

    def _rows(self, text: str, chars: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The remembered row of each pre-token, and where each begins."""
        start = self._starts(chars, first)
        length = np.diff(np.append(start, len(chars)))
        values, where, back = np.unique(self._hashes(chars, start, length), return_index=True, return_inverse=True)
        at = sorted_lookup(self.known, values)
        if len(new := np.flatnonzero(at < 0)):
            s = start[where[new]]
            words = [text[a:b].encode() for a, b in zip(s.tolist(), (s + length[where[new]]).tolist())]
            kept = len(self.known)
            self._learn(values[new], words)
            if len(self.known) < kept:  # forgotten meanwhile: learn what this batch needs besides
                old = np.flatnonzero(at >= 0)
                s = start[where[old]]
                self._learn(values[old], [text[a:b].encode() for a, b in zip(
                    s.tolist(), (s + length[where[old]]).tolist())])
            at = sorted_lookup(self.known, values)
        return self.known_row[at][back], start

    # -- texts -----------------------------------------------------------------------------

    def _plain(self, texts: list[str], ids: bool):
        """Counts of each text, with ``ids`` the ids of all texts too. No special strings."""
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        counts, flat = np.zeros(len(texts), dtype=np.int64), [np.empty(0, dtype=np.int32)]
        for lo, hi in runs(sizes.tolist()):
            text = "".join(texts[lo:hi])
            if not text:
                continue
            chars = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
            begin = np.cumsum(sizes[lo:hi]) - sizes[lo:hi]
            full = sizes[lo:hi] > 0
            first = np.zeros(len(chars), dtype=bool)
            first[begin[full]] = True
            rows, start = self._rows(text, chars, first)
            n = self.known_start[rows + 1] - self.known_start[rows]
            cut = np.searchsorted(start, begin[full])
            counts[lo:hi][full] = np.add.reduceat(n, cut)
            if ids:
                flat.append(self.known_ids[ragged(self.known_start[rows], n)])
        return counts, np.concatenate(flat) if ids else None

    def _split(self, texts: list[str]):
        """The plain parts of all texts; the text of each; the special id after each, or -1."""
        parts, owner, special = [], [], []
        for k, text in enumerate(texts):
            at = 0
            for m in self.special_pattern.finditer(text):
                parts.append(text[at:m.start()])
                owner.append(k)
                special.append(self.special[m[0]])
                at = m.end()
            parts.append(text[at:])
            owner.append(k)
            special.append(-1)
        return parts, np.array(owner, dtype=np.int64), np.array(special, dtype=np.int64)

    def _has_special(self, texts: list[str]) -> bool:
        return any(s in t for s in self.special for t in texts)

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text."""
        if not self._has_special(texts):
            return self._plain(texts, False)[0]
        parts, owner, special = self._split(texts)
        counts = self._plain(parts, False)[0] + (special >= 0)
        return np.bincount(owner, weights=counts, minlength=len(texts)).astype(np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and the count of each."""
        if not self._has_special(texts):
            counts, ids = self._plain(texts, True)
            return ids, counts
        parts, owner, special = self._split(texts)
        counts, ids = self._plain(parts, True)
        end = np.cumsum(counts)
        ids = np.insert(ids, end[special >= 0], special[special >= 0])
        total = np.bincount(owner, weights=counts + (special >= 0), minlength=len(texts)).astype(np.int64)
        return ids, total
