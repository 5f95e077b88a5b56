"""Words of many texts at once, as arrays.

Texts arrive as Arrow columns. A batch is walked in slices of a few megabytes; within a
slice, word borders come from a table over bytes and word hashes from running sums of a
polynomial, so that no Python object is made for a word. Texts longer than a slice are
walked in parts that end between words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20
#: Of a part come some arrays of eight bytes for each of its own.
PART_BYTES = 1 << 18
#: A part ends with the word it would cut, which mostly lies in so many bytes.
WORD_BYTES = 1 << 12

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Words between spaces: all bytes but 20 and 09-0D.
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
#: Words of letters and digits in lower case: 0-9, a-z and everything beyond ASCII.
LETTERS = np.zeros(256, dtype=bool)
LETTERS[48:58] = LETTERS[97:123] = LETTERS[128:] = True

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = np.uint64(0xD6E8FEB86659FD93)


@dataclass
class Words:
    """Words of some texts: hash, first and last byte + 1 in ``data``; text i has words first[i] to first[i + 1]."""

    data: np.ndarray
    bounds: np.ndarray
    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


class _Kept(dict):
    """Tables of one process; they do not travel with a job."""

    def __reduce__(self):
        return _Kept, ()


_tables = _Kept()


def _powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of the base and of its inverse."""
    if length not in _tables:
        with np.errstate(over="ignore"):
            up, down = np.full(length + 1, _BASE, np.uint64), np.full(length + 1, _INVERSE, np.uint64)
            up[0] = down[0] = 1
            made = np.cumprod(up), np.cumprod(down)
        if length > PART_BYTES + WORD_BYTES:
            return made
        _tables[length] = made
    return _tables[length]


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(32))) * _MIX
        values = (values ^ (values >> np.uint64(29))) * _MIX
        return values ^ (values >> np.uint64(32))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the n + 1 bounds between them; NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    if not len(column) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    bounds = np.frombuffer(offsets, wide)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``begin, end, data, bounds`` of runs of rows of at most ``most`` bytes, or of one longer text."""
    data, bounds = text_bytes(column)
    begin, rows = 0, len(bounds) - 1
    while begin < rows:
        end = max(begin + 1, int(np.searchsorted(bounds, bounds[begin] + most, side="right")) - 1)
        part = bounds[begin : end + 1]
        yield begin, end, data[part[0] : part[-1]], part - part[0]
        begin = end


def looked_up(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """``table[data]`` of bytes, by the interpreter's own translation, which takes a third of the time."""
    return np.frombuffer(data.tobytes().translate(table.tobytes()), table.dtype)


def find_words(data: np.ndarray, bounds: np.ndarray, table: np.ndarray) -> Words:
    """The words of lower-cased ``data``, which no bound of a text cuts through unnoticed."""
    size = len(data)
    hashes, starts, ends = [], [], []
    begin = 0
    while begin < size:
        stop = min(size, begin + PART_BYTES)
        while stop < size and table[data[stop]] and table[data[stop - 1]]:
            # Only a word longer than a step moves the end of a part far.
            ahead = np.flatnonzero(~table[data[stop : stop + WORD_BYTES]])
            stop = stop + int(ahead[0]) if len(ahead) else min(size, stop + WORD_BYTES)
        part = data[begin:stop]
        inside = looked_up(part, table)
        breaks = np.zeros(len(part) + 1, bool)
        cuts = bounds[(bounds >= begin) & (bounds <= stop)] - begin
        breaks[cuts] = True
        fresh, last = inside.copy(), inside.copy()
        fresh[1:] &= ~inside[:-1] | breaks[1:-1]
        last[:-1] &= ~inside[1:] | breaks[1:-1]
        start, end = np.flatnonzero(fresh), np.flatnonzero(last) + 1
        usual = PART_BYTES + WORD_BYTES
        up, down = _powers(usual if len(part) <= usual else 1 << (len(part) - 1).bit_length())
        with np.errstate(over="ignore"):
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[: len(part)], out=sums[1:])
            hashes.append(mix((sums[end] - sums[start]) * down[start]))
        starts.append(start + begin)
        ends.append(end + begin)
        begin = stop
    join = lambda arrays, kind: np.concatenate(arrays) if arrays else np.zeros(0, kind)
    start = join(starts, np.int64)
    return Words(data, bounds, join(hashes, np.uint64), start, join(ends, np.int64), np.searchsorted(start, bounds))


def lowered_words(data: np.ndarray, bounds: np.ndarray, table: np.ndarray) -> Words:
    return find_words(looked_up(data, LOWER), bounds, table)


def shingles(words: Words, length: int) -> list[np.ndarray]:
    """For each text the sorted hashes of its distinct runs of ``length`` words; a shorter text is one run, none if empty."""
    hash_, counts = words.hash, words.counts()
    found: list[np.ndarray] = []
    with np.errstate(over="ignore"):
        if len(hash_) >= length:
            runs = np.zeros(len(hash_) - length + 1, np.uint64)
            for i in range(length):
                runs = runs * _MIX + hash_[i : i + len(runs)]
            runs = mix(runs)
        for text, count in enumerate(counts):
            begin = words.first[text]
            if count >= length:
                own = np.sort(runs[begin : begin + count - length + 1])
                keep = np.ones(len(own), bool)
                keep[1:] = own[1:] != own[:-1]
                found.append(own[keep])
            elif count:
                run = np.uint64(count)
                for value in hash_[begin : begin + count]:
                    run = run * _MIX + value
                found.append(mix(np.array([run], np.uint64)))
            else:
                found.append(np.zeros(0, np.uint64))
    return found
