"""An FM-index over short pieces of numbers: backward search and locating, for many phrases at once.

The pieces are laid end to end with 0 between them; a suffix ends at the next 0, and equal
suffixes are ordered by position. As pieces are short, sorting by doubled prefixes takes few
rounds whatever repeats the text has.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 16


class Bits:
    """Bits with counts of the ones before a place."""

    def __init__(self, bits: np.ndarray) -> None:
        packed = np.packbits(np.append(bits, np.zeros(64 - len(bits) % 64, bool)), bitorder="little")
        self.words = packed.view(np.uint64)
        self.before = np.zeros(len(self.words) + 1, np.int64)
        np.cumsum(np.bitwise_count(self.words), out=self.before[1:])
        self.zeros = len(bits) - int(self.before[-1])

    def ones(self, at: np.ndarray) -> np.ndarray:
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        inside = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[word] + np.bitwise_count(inside)

    def get(self, at: np.ndarray) -> np.ndarray:
        return ((self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)


class WaveletTree:
    """Ranks of numbers below 2 ** levels, one bit vector a level."""

    def __init__(self, values: np.ndarray, levels: int) -> None:
        self.levels: list[tuple[int, Bits]] = []
        for shift in reversed(range(levels)):
            bit = (values >> shift) & 1 == 1
            self.levels.append((shift, Bits(bit)))
            values = np.concatenate([values[~bit], values[bit]])

    def follow(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where ``at`` ends up among the places of each symbol; less that of 0, it is the symbol's rank."""
        for shift, bits in self.levels:
            ones = bits.ones(at)
            at = np.where((symbols >> shift) & 1 == 1, bits.zeros + ones, at - ones)
        return at

    def read(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols at places, and where the places end up."""
        symbols = np.zeros(len(at), np.int64)
        for shift, bits in self.levels:
            ones, bit = bits.ones(at), bits.get(at)
            symbols |= bit.astype(np.int64) << shift
            at = np.where(bit, bits.zeros + ones, at - ones)
        return symbols, at


def suffix_order(text: np.ndarray, largest: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions by what follows them up to the next 0, then by position; and the place of each
    position in that order, one place for all that are followed by the same."""
    size = len(text)
    stops = np.flatnonzero(text == 0)
    left = stops[np.searchsorted(stops, np.arange(size))] - np.arange(size)
    bits = max(1, int(largest).bit_length())
    step = 4 if bits <= 16 else 2
    padded = np.append(text, np.zeros(step, text.dtype)).astype(np.uint64)
    key = np.zeros(size, np.uint64)
    for i in range(step):
        key = (key << np.uint64(bits)) | np.where(left > i, padded[i : i + size], np.uint64(0))
    order = np.argsort(key, kind="stable")
    fresh = np.ones(size, bool)
    fresh[1:] = key[order[1:]] != key[order[:-1]]
    place = np.zeros(size, np.int64)
    group = np.maximum.accumulate(np.where(fresh, np.arange(size), 0))
    place[order] = group
    while True:
        shared = ~fresh
        shared[:-1] |= ~fresh[1:]
        slots = np.flatnonzero(shared)
        slots = slots[left[order[slots]] >= step]
        if not len(slots):
            return order, place
        own = order[slots]
        following = place[own + step]
        group = place[own]
        sort = np.lexsort((own, following, group))
        own, following, group = own[sort], following[sort], group[sort]
        order[slots] = own
        new = np.ones(len(own), bool)
        new[1:] = (group[1:] != group[:-1]) | (following[1:] != following[:-1])
        fresh[slots] = new
        place[own] = slots[np.maximum.accumulate(np.where(new, np.arange(len(own)), 0))]
        step *= 2


class FMIndex:
    """``text`` holds numbers from 1 to ``largest`` in pieces that each end with a 0."""

    def __init__(self, text: np.ndarray, largest: int) -> None:
        order, _ = suffix_order(text, largest)
        levels = max(1, int(largest).bit_length())
        self.tree = WaveletTree(text[order - 1].astype(np.int64), levels)
        self.smaller = np.zeros(largest + 2, np.int64)
        np.cumsum(np.bincount(text, minlength=largest + 1), out=self.smaller[1:])
        symbols = np.arange(largest + 1, dtype=np.int64)
        self.origin = self.tree.follow(symbols, np.zeros(largest + 1, np.int64))
        # Places at a distance, and the first of each piece, so that no walk leaves its piece.
        kept = (order % SAMPLE == 0) | (text[order - 1] == 0)
        self.sampled, self.samples = Bits(kept), order[kept]
        self.size = len(text)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``phrase, low, high``: rows of the index that begin with each phrase that occurs; all phrases are equally long."""
        alive = np.arange(len(phrases))
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.size, np.int64)
        for column in reversed(range(phrases.shape[1])):
            symbol = phrases[alive, column].astype(np.int64)
            base = self.smaller[symbol] - self.origin[symbol]
            low, high = base + self.tree.follow(symbol, low), base + self.tree.follow(symbol, high)
            found = low < high
            alive, low, high = alive[found], low[found], high[found]
            if not len(alive):
                break
        return alive, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The text position of each row, by steps to the left up to a sampled one."""
        found, steps = np.zeros(len(rows), np.int64), 0
        index = np.arange(len(rows))
        while len(rows):
            known = self.sampled.get(rows)
            found[index[known]] = self.samples[self.sampled.ones(rows[known])] + steps
            index, rows = index[~known], rows[~known]
            symbol, at = self.tree.read(rows)
            rows = self.smaller[symbol] + at - self.origin[symbol]
            steps += 1
        return found
