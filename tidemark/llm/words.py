"""Words, word hashes and word windows of many texts at once, as numpy arrays.

A word is a run of bytes other than space, tab, newline, vertical tab, form feed and carriage
return. These six are single bytes in UTF-8, so whole texts are scanned as bytes. Everything
here runs inside Spark tasks on one Arrow batch; ``slices`` bounds what is held at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
SAME = np.arange(256, dtype=np.uint8)
LOWER = SAME.copy()
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all bits (a one-to-one map)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def stream(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=np.uint64) * MULTIPLIER + np.uint64(seed))


_BYTE_VALUES = stream(1, 256)
_BASE = int(stream(2, 1)[0]) | 1
_UNBASE = pow(_BASE, -1, 1 << 64)


class _Powers:
    """Powers of an odd number modulo 2**64, grown to the longest slice seen."""

    def __init__(self, base: int):
        self.base, self.values = np.uint64(base), np.ones(1, np.uint64)

    def upto(self, n: int) -> np.ndarray:
        if len(self.values) < n:
            grown = np.full(max(n, SLICE_BYTES + 1), self.base, np.uint64)
            grown[0] = 1
            self.values = np.multiply.accumulate(grown)
        return self.values[:n]


_powers, _unpowers = _Powers(_BASE), _Powers(_UNBASE)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans; equal bytes have equal hashes wherever they stand."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * _powers.upto(len(data)), out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * _unpowers.upto(len(data))[starts]
    return mix(hashes + (ends - starts).astype(np.uint64) * MULTIPLIER)


@dataclass
class Texts:
    """The bytes of some texts and where each begins; a null text has no bytes."""

    data: np.ndarray
    offsets: np.ndarray
    first: int

    def __len__(self) -> int:
        return len(self.offsets) - 1


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[Texts]:
    """The texts of an Arrow column in runs of at most ``most`` bytes; a longer text is a run by itself."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    column = column.cast(pa.large_binary())
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if column.null_count:
        valid = np.asarray(column.is_valid())
        lengths = np.where(valid, np.diff(offsets), 0)
        if (lengths != np.diff(offsets)).any():
            column = column.fill_null(b"")
            _, at, data = column.buffers()
            offsets = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1]
            whole = np.frombuffer(data, np.uint8)
    low = 0
    while low < len(column):
        high = int(np.searchsorted(offsets, offsets[low] + most, side="right")) - 1
        high = min(max(high, low + 1), len(column))
        yield Texts(whole[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], low)
        low = high


@dataclass
class Words:
    """Words of some texts in order; ``bounds[i]:bounds[i + 1]`` are those of text ``i``."""

    starts: np.ndarray
    ends: np.ndarray
    docs: np.ndarray
    bounds: np.ndarray


def find_words(texts: Texts, cuts: np.ndarray | None = None) -> Words:
    """Words; ``cuts`` marks bytes before which a word also ends (one flag per byte)."""
    solid = ~SPACE[texts.data]
    inner = texts.offsets[1:-1]
    inner = inner[inner < len(solid)]
    begins, finishes = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1]
    finishes[:-1] &= ~solid[1:]
    if len(inner):
        begins[inner] = solid[inner]
        before = inner[inner > 0] - 1
        finishes[before] = solid[before]
    if cuts is not None:
        begins |= cuts & solid
        finishes[:-1] |= (cuts & solid)[1:] & solid[:-1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(finishes) + 1
    bounds = np.searchsorted(starts, texts.offsets)
    docs = np.repeat(np.arange(len(texts)), np.diff(bounds))
    return Words(starts, ends, docs, bounds)


def window_hashes(hashes: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """Hashes of all runs of ``size`` consecutive numbers; also of runs that cross texts."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    base = stream(100 + seed, 1)[0] | np.uint64(1)
    total = hashes[:n].copy()
    for j in range(1, size):
        total *= base
        total += hashes[j : j + n]
    return mix(total)


def windows_inside(words: Words, size: int) -> np.ndarray:
    """Which of ``len(words) - size + 1`` windows lie in one text."""
    n = len(words.docs) - size + 1
    if n <= 0:
        return np.zeros(0, bool)
    return words.docs[:n] == words.docs[size - 1 :]


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


@dataclass
class HashedWords:
    """Words with their hashes; see ``Words``."""

    starts: np.ndarray
    ends: np.ndarray
    docs: np.ndarray
    bounds: np.ndarray
    hashes: np.ndarray


def blocks(data: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Byte ranges of about ``most`` bytes that together cover ``data`` and cut no word."""
    low = 0
    while low < len(data):
        high = min(low + most, len(data))
        while high < len(data):
            spaces = np.flatnonzero(SPACE[data[high : high + most]])
            if len(spaces):
                high += int(spaces[0]) + 1
                break
            high = min(high + most, len(data))
        yield low, high
        low = high


def hashed_words(texts: Texts, fold: np.ndarray = SAME) -> HashedWords:
    """Words of texts of any length, hashed after mapping every byte through ``fold``.

    Byte-sized temporaries are held for one block at a time, so a very long text costs a
    few numbers a word.
    """
    starts, ends, hashes = [], [], []
    for low, high in blocks(texts.data) if len(texts) == 1 else [(0, len(texts.data))]:
        part = fold[texts.data[low:high]]
        if len(texts) == 1:
            offsets = np.array([0, high - low])
        else:
            offsets = texts.offsets
        found = find_words(Texts(part, offsets, 0))
        hashes.append(span_hashes(part, found.starts, found.ends))
        starts.append(found.starts + low)
        ends.append(found.ends + low)
    joined = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (starts, ends)]
    bounds = np.searchsorted(joined[0], texts.offsets)
    docs = np.repeat(np.arange(len(texts)), np.diff(bounds))
    return HashedWords(*joined, docs, bounds, np.concatenate(hashes) if hashes else np.zeros(0, np.uint64))


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions ``starts[i] .. starts[i] + lengths[i] - 1`` of all ``i``, one after another."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))
