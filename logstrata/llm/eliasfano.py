"""Elias-Fano sequences and a trie of n-grams over them, as flat arrays that can be mapped from a file or a buffer.

A monotone sequence is kept as its low bits side by side and its high bits in
unary.  Children of a trie node are numbers in ascending order; the numbers of
a level are made monotone by adding the last value of the range before, so a
child is found by a successor search relative to its context's range.
All queries take arrays.
"""

from __future__ import annotations

import json

import numpy as np

#: Steps of a tenfold change in a quantised value; values are rounded down, by less than 0.9 %.
STEPS = 256
NONE = 0xFFFF


def quantised(values: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1] as up to 16 bits of their logarithm, rounded so that they never grow; NONE for 0."""
    with np.errstate(divide="ignore"):
        steps = np.ceil(np.minimum(-np.log10(values) * STEPS, NONE) - 1e-9)
    return steps.astype(np.uint16)


def restored(steps: np.ndarray) -> np.ndarray:
    return np.where(steps == NONE, 0.0, np.power(10.0, -steps.astype(np.float64) / STEPS))


def _words(bits: np.ndarray) -> np.ndarray:
    """Bits (0 or 1) as 64-bit words, lowest first, with one word to spare."""
    packed = np.packbits(bits, bitorder="little")
    return np.concatenate([packed, np.zeros(-len(packed) % 8 + 8, np.uint8)]).view("<u8")


def _select_in_word(word: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Place of the rank-th (from 0) set bit of each word."""
    word, rank, place = word.copy(), rank.astype(np.int64), np.zeros(len(word), np.int64)
    for width in (32, 16, 8, 4, 2, 1):
        below = np.bitwise_count(word & np.uint64((1 << width) - 1)).astype(np.int64)
        up = rank >= below
        rank -= np.where(up, below, 0)
        place += np.where(up, width, 0)
        word = np.where(up, word >> np.uint64(width), word)
    return place


class EliasFano:
    """A monotone sequence of unsigned numbers."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray):
        self.n, self.low_bits, self._low, self._high, self._ones = n, low_bits, low, high, ones
        self._highest = len(high) * 64 - n  # no more high values than zeros

    @classmethod
    def of(cls, values: np.ndarray) -> "EliasFano":
        values = np.ascontiguousarray(values, np.uint64)
        n = len(values)
        low_bits = max(0, (int(values[-1]) // n).bit_length() - 1) if n else 0
        bits = [np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")[:, :low_bits].ravel() for part in np.split(values, range(65536, n, 65536))]
        unary = np.zeros((int(values[-1] >> np.uint64(low_bits)) if n else 0) + n + 1, np.uint8)
        unary[(values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)] = 1
        high = _words(unary)
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(high))]).astype(np.uint32)
        return cls(n, low_bits, _words(np.concatenate(bits)), high, ones)

    def arrays(self) -> list[np.ndarray]:
        return [self._low, self._high, self._ones]

    def _low_at(self, at: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(at), np.uint64)
        bit = at * self.low_bits
        word, shift = bit >> 6, (bit & 63).astype(np.uint64)
        value = (self._low[word] >> shift) | ((self._low[word + 1] << np.uint64(1)) << (np.uint64(63) - shift))
        return value & np.uint64((1 << self.low_bits) - 1)

    def at(self, index: np.ndarray) -> np.ndarray:
        """Values at ``index``."""
        index = np.asarray(index, np.int64)
        word = np.searchsorted(self._ones, index, side="right") - 1
        place = word * 64 + _select_in_word(self._high[word], index - self._ones[word].astype(np.int64))
        return (place - index).astype(np.uint64) << np.uint64(self.low_bits) | self._low_at(index)

    def _below(self, high: np.ndarray) -> np.ndarray:
        """How many values have high bits less than ``high``."""
        out = np.zeros(len(high), np.int64)
        out[high > self._highest] = self.n
        within = np.flatnonzero((high > 0) & (high <= self._highest))
        zero = high[within] - 1
        zeros = np.arange(len(self._ones), dtype=np.int64) * 64 - self._ones
        word = np.searchsorted(zeros, zero, side="right") - 1
        place = word * 64 + _select_in_word(~self._high[word], zero - zeros[word])
        out[within] = place - zero
        return out

    def successor(self, value: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each range [begin, end) the first place that holds ``value`` or more, and whether it holds ``value``."""
        high = np.minimum(value >> np.uint64(self.low_bits), np.uint64(1 << 62)).astype(np.int64)
        wanted = value & np.uint64((1 << self.low_bits) - 1)
        low, stop = np.clip(self._below(high), begin, end), np.clip(self._below(high + 1), begin, end)
        first, left = stop.copy(), np.flatnonzero(low < stop)
        while len(left):  # halve the ranges of equal high bits
            middle = (low[left] + stop[left]) // 2
            less = self._low_at(middle) < wanted[left]
            low[left[less]], stop[left[~less]] = middle[less] + 1, middle[~less]
            left = left[low[left] < stop[left]]
        found = np.zeros(len(value), bool)
        inside = np.flatnonzero(low < first)
        found[inside] = self._low_at(low[inside]) == wanted[inside]
        return low, found


def _relative(children: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Ascending runs (beginning at ``starts``) made one monotone sequence."""
    if not len(children):
        return children
    lengths = np.diff(np.append(starts, len(children)))
    last = children[starts + lengths - 1]
    return children + np.repeat(np.concatenate([[0], np.cumsum(last)[:-1]]).astype(np.uint64), lengths)


class Trie:
    """Bigrams and trigrams of one bucket: quantised shares of the counts, and what each bigram leaves to shorter contexts."""

    def __init__(self, buffer):
        size = int(np.frombuffer(buffer, "<u8", 1)[0])
        head = json.loads(bytes(np.frombuffer(buffer, np.uint8, size, 8)))
        flat = [np.frombuffer(buffer, kind, n, at) for kind, n, at in head["arrays"]]
        self.first, self.first_ends, self.second, self.second_ends, self.third = (
            EliasFano(n, bits, *flat[3 * i:3 * i + 3]) for i, (n, bits) in enumerate(head["levels"])
        )
        self._share2, self._left3, self._share3 = flat[15:]

    @classmethod
    def open(cls, path: str) -> "Trie":
        """A trie mapped from a file."""
        return cls(np.memmap(path, np.uint8, "r"))

    @staticmethod
    def build(pairs: np.ndarray, share2: np.ndarray, left3: np.ndarray, triples: np.ndarray, share3: np.ndarray) -> bytes:
        """``pairs``: ascending first << 32 | second; ``triples``: ascending place among the pairs << 32 | third."""
        half, mask = np.uint64(32), np.uint64(0xFFFFFFFF)
        first, starts = np.unique(pairs >> half, return_index=True)
        owners = (triples >> half).astype(np.int64)
        ends = np.searchsorted(owners, np.arange(len(pairs)), side="right")
        present, third_starts = np.unique(owners, return_index=True)
        levels = [
            EliasFano.of(first), EliasFano.of(np.append(starts[1:], len(pairs)) if len(pairs) else np.zeros(0)),
            EliasFano.of(_relative(pairs & mask, starts)), EliasFano.of(ends), EliasFano.of(_relative(triples & mask, third_starts)),
        ]
        flat = [a for level in levels for a in level.arrays()] + [share2.astype("<u2"), left3.astype("<u2"), share3.astype("<u2")]
        head = {"levels": [(level.n, level.low_bits) for level in levels], "arrays": [[a.dtype.str, len(a), 10**12 + i] for i, a in enumerate(flat)]}
        at = 8 + -(-len(json.dumps(head)) // 8) * 8  # offsets are written with no more digits
        for entry, a in zip(head["arrays"], flat):
            entry[2], at = at, at + -(-a.nbytes // 8) * 8
        text = json.dumps(head).encode()
        text += b" " * (head["arrays"][0][2] - 8 - len(text))
        return b"".join([len(text).to_bytes(8, "little"), text] + [a.tobytes() + b"\0" * (-a.nbytes % 8) for a in flat])

    @staticmethod
    def _range(ends: EliasFano, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        begin = np.zeros(len(node), np.int64)
        later = np.flatnonzero(node > 0)
        begin[later] = ends.at(node[later] - 1).astype(np.int64)
        return begin, ends.at(node).astype(np.int64)

    @staticmethod
    def _child(level: EliasFano, begin: np.ndarray, end: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        base = np.zeros(len(begin), np.uint64)
        later = np.flatnonzero(begin > 0)
        base[later] = level.at(begin[later] - 1)
        return level.successor(base + number, begin, end)

    def pair(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Places of pairs, -1 where there is none."""
        out = np.full(len(first), -1, np.int64)
        if self.first.n:
            node, known = self.first.successor(first, np.zeros(len(first), np.int64), np.full(len(first), self.first.n))
            at = np.flatnonzero(known)
            place, found = self._child(self.second, *self._range(self.first_ends, node[at]), second[at])
            out[at[found]] = place[found]
        return out

    def triple(self, pair: np.ndarray, third: np.ndarray) -> np.ndarray:
        """Places of the triples that go on from the pairs at ``pair``, -1 where there is none."""
        out = np.full(len(pair), -1, np.int64)
        at = np.flatnonzero(pair >= 0)
        if self.third.n and len(at):
            place, found = self._child(self.third, *self._range(self.second_ends, pair[at]), third[at])
            out[at[found]] = place[found]
        return out

    @staticmethod
    def _steps(values: np.ndarray, place: np.ndarray, absent: int) -> np.ndarray:
        out = np.full(len(place), absent, np.uint16)
        out[place >= 0] = values[place[place >= 0]]
        return out

    def pair_steps(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Quantised share of each pair and what it leaves as a context; nothing and all for those absent."""
        return self._steps(self._share2, place, NONE), self._steps(self._left3, place, 0)

    def triple_steps(self, place: np.ndarray) -> np.ndarray:
        return self._steps(self._share3, place, NONE)
