"""Weighted acyclic automata that give sequences of symbols their counts.

A sequence has a fixed number of places; shorter ones end in empty symbols, which sort first. An
automaton is built from sorted sequences, layer by layer from the last place: what all
continuations of a state have in common of their weight moves to the arc before it, and states with the same
arcs become one. Along a path, weights add up. Read back, an automaton is its sorted
sequences again, so unions are merges that add (or take the larger of) equal sequences' weights.
"""

from __future__ import annotations

import bisect
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidemark.llm.words import gather, mix

EMPTY = b""
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Weighted:
    """Sorted distinct sequences: the sorted alphabet, a column of symbol numbers a place, and weights."""

    alphabet: pa.Array  # of bytes; the empty symbol has number 0
    places: list[np.ndarray]
    weights: np.ndarray

    def __len__(self) -> int:
        return len(self.weights)

    def part(self, low: int, high: int) -> Weighted:
        return Weighted(self.alphabet, [p[low:high] for p in self.places], self.weights[low:high])

    def where(self, chosen: np.ndarray) -> Weighted:
        return Weighted(self.alphabet, [p[chosen] for p in self.places], self.weights[chosen])

    def keys(self, at: Sequence[int]) -> list[tuple[bytes, ...]]:
        columns = [self.alphabet.take(pa.array(p[list(at)])).to_pylist() for p in self.places]
        return list(zip(*columns))


def sorted_alphabet(symbols: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The distinct symbols and the empty one, sorted, and the number of each of ``symbols`` among them."""
    coded = pa.concat_arrays([pa.array([EMPTY], pa.large_binary()), symbols.cast(pa.large_binary())]).dictionary_encode()
    order = np.asarray(pc.sort_indices(coded.dictionary))
    numbers = np.empty(len(order), np.int64)
    numbers[order] = np.arange(len(order))
    return coded.dictionary.take(pa.array(order)), numbers[np.asarray(coded.indices)[1:]]


class Packing:
    """One number for a sequence, which sorts as it does, by the symbols that each place has in use."""

    def __init__(self, size: int, *sets: Sequence[np.ndarray]):
        self.symbols, self.numbers, self.fits = [], [], True
        total = 1
        for columns in zip(*sets):
            used = np.zeros(size, bool)
            for column in columns:
                used[column] = True
            self.symbols.append(np.flatnonzero(used))
            self.numbers.append((np.cumsum(used) - 1).astype(np.uint64))
            total *= max(1, len(self.symbols[-1]))
        self.fits = total <= 1 << 64

    def pack(self, places: Sequence[np.ndarray]) -> np.ndarray:
        key = np.zeros(len(places[0]), np.uint64)
        for place, symbols, numbers in zip(places, self.symbols, self.numbers):
            key *= np.uint64(max(1, len(symbols)))
            key += numbers[place]
        return key

    def unpack(self, key: np.ndarray) -> list[np.ndarray]:
        out = []
        for symbols in self.symbols[::-1]:
            key, digit = np.divmod(key, np.uint64(max(1, len(symbols))))
            out.append(symbols[digit.astype(np.int64)])
        return out[::-1]


def weighted(alphabet: pa.Array, places: list[np.ndarray], weights: np.ndarray | None = None, how: np.ufunc = np.add) -> Weighted:
    """Sequences in any order, repeated ones put together; without weights each occurrence counts one."""
    n = len(places[0])
    packing = Packing(len(alphabet), places)
    if packing.fits:
        key = packing.pack(places)
        if weights is None:
            key.sort()
        else:
            order = np.argsort(key)
            key, weights = key[order], weights[order]
        new = _starts(key[1:] != key[:-1], n)
        places = packing.unpack(key[new])
    else:
        order = np.lexsort(places[::-1])
        places = [p[order] for p in places]
        weights = None if weights is None else weights[order]
        changed = np.zeros(max(n - 1, 0), bool)
        for p in places:
            changed |= p[1:] != p[:-1]
        new = _starts(changed, n)
        places = [p[new] for p in places]
    if weights is None:
        return Weighted(alphabet, places, np.diff(new, append=n))
    return Weighted(alphabet, places, how.reduceat(weights, new) if n else weights)


def _starts(changed: np.ndarray, n: int) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], changed])) if n else np.zeros(0, np.int64)


def together(some: Sequence[Weighted]) -> tuple[pa.Array, list[list[np.ndarray]]]:
    """One alphabet for all, and the places of each in its numbers."""
    alphabet, numbers = sorted_alphabet(pa.concat_arrays([x.alphabet for x in some]))
    ends = np.cumsum([len(x.alphabet) for x in some])
    maps = np.split(numbers, ends[:-1])
    return alphabet, [[m[p] for p in x.places] for m, x in zip(maps, some)]


def union(some: Sequence[Weighted], how: np.ufunc = np.add) -> Weighted:
    """All sequences of ``some``; weights of equal ones are put together by ``how``."""
    alphabet, places = together(some)
    columns = [np.concatenate(c) for c in zip(*places)]
    return weighted(alphabet, columns, np.concatenate([x.weights for x in some]), how)


def compose(asked: Weighted, known: Weighted) -> np.ndarray:
    """The weight that ``known`` gives each sequence of ``asked``; 0 for others."""
    alphabet, (one, two) = together([asked, known])
    packing = Packing(len(alphabet), one, two)
    if packing.fits:
        keys = [packing.pack(one), packing.pack(two)]
    else:  # numbers of the distinct sequences stand for them
        both = np.column_stack([np.concatenate(c) for c in zip(one, two)])
        numbers = np.unique(both, axis=0, return_inverse=True)[1].reshape(-1)
        keys = [numbers[: len(asked)], numbers[len(asked) :]]
    out = np.zeros(len(asked), np.int64)
    if len(known):
        at = np.minimum(np.searchsorted(keys[1], keys[0]), len(known) - 1)
        found = keys[1][at] == keys[0]
        out[found] = known.weights[at[found]]
    return out


def slim(rows: Weighted) -> Weighted:
    """The same with an alphabet of the symbols in use."""
    used = np.zeros(len(rows.alphabet), bool)
    used[0] = True
    for p in rows.places:
        used[p] = True
    numbers = np.cumsum(used) - 1
    return Weighted(rows.alphabet.take(pa.array(np.flatnonzero(used))), [numbers[p] for p in rows.places], rows.weights)


def cut(rows: Weighted, bounds: Sequence[tuple[bytes, ...]]) -> list[tuple[int, Weighted]]:
    """The sequences between successive bounds, with the number of bounds at or before them."""
    names, places = rows.alphabet.to_pylist(), [0]
    for bound in bounds:
        low, high = 0, len(rows)
        for symbol, column in zip(bound, rows.places):
            number = bisect.bisect_left(names, symbol)
            inside = column[low:high]
            known = number < len(names) and names[number] == symbol
            low, high = low + np.searchsorted(inside, number), low + np.searchsorted(inside, number, "right")
            if not known:
                break
        places.append(int(low))
    places.append(len(rows))
    return [(i, rows.part(a, b)) for i, (a, b) in enumerate(zip(places, places[1:])) if a < b]


def range_of(bounds: Sequence[tuple[bytes, ...]], key: tuple[bytes, ...]) -> int:
    return bisect.bisect_right(bounds, key)


def _states(begins: np.ndarray, arcs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The first of each kind of equal groups of arcs, and the kind of each group."""
    sizes = np.diff(begins, append=len(arcs[0]))
    sums = np.zeros(len(arcs[0]), np.uint64)
    for arc in arcs:
        sums = mix(sums * _SPREAD + arc.astype(np.uint64) + np.uint64(1))
    sums = mix(np.add.reduceat(sums, begins) + sizes.astype(np.uint64) * _SPREAD)
    _, first, kind = np.unique(sums, return_index=True, return_inverse=True)
    kind = kind.reshape(-1)
    like = first[kind]
    same = bool((sizes == sizes[like]).all())
    if same:  # equal hashes are not taken on trust
        at = gather(begins[like], sizes)
        same = all(bool((arc == arc[at]).all()) for arc in arcs)
    return (first, kind) if same else (np.arange(len(begins)), np.arange(len(begins)))


def encode(rows: Weighted) -> bytes:
    """The automaton of some sequences, at least one, as compressed bytes."""
    rows = slim(rows)
    n, depth = len(rows), len(rows.places)
    changed = [np.zeros(n, bool)]  # where the first places differ from those of the row before
    for p in rows.places[:-1]:
        differs = changed[-1].copy()
        differs[1:] |= p[1:] != p[:-1]
        changed.append(differs)
    at, weights, targets = np.arange(n), rows.weights, np.zeros(n, np.int64)
    arrays = []
    for place in range(depth - 1, -1, -1):
        starts = changed[place][at].copy()
        starts[0] = True
        begins = np.flatnonzero(starts)
        sizes = np.diff(begins, append=len(at))
        least = np.minimum.reduceat(weights, begins)
        arcs = [rows.places[place][at], weights - np.repeat(least, sizes), targets]
        first, kind = _states(begins, arcs)
        chosen = gather(begins[first], sizes[first])
        arrays = [sizes[first], *(arc[chosen] for arc in arcs), *arrays]
        at, weights, targets = at[begins], least, kind
    text = b"".join(rows.alphabet.to_pylist())
    lengths = np.asarray(pc.binary_length(rows.alphabet)).astype(np.int64)
    return _dump([np.frombuffer(text, np.uint8), lengths, weights, *arrays])


def decode(data: bytes) -> Weighted:
    """The sequences of an automaton, sorted."""
    text, lengths, weights, *arrays = _load(data)
    offsets = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    alphabet = pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(text.astype(np.uint8))])
    places, states = [], np.zeros(1, np.int64)
    for i in range(0, len(arrays), 4):
        sizes, symbols, more, targets = arrays[i : i + 4]
        before = np.cumsum(sizes) - sizes
        counts = sizes[states]
        at = gather(before[states], counts)
        parents = np.repeat(np.arange(len(states)), counts)
        places = [p[parents] for p in places] + [symbols[at]]
        weights = weights[parents] + more[at]
        states = targets[at]
    return Weighted(alphabet, places, weights)


_KINDS = [np.dtype(x) for x in ("u1", "<u2", "<u4", "<u8")]


def _dump(arrays: Sequence[np.ndarray]) -> bytes:
    """Arrays of numbers from 0 in as few bytes each as their largest needs, like bytes side by side."""
    parts = [np.array([len(arrays)], "<u8").tobytes()]
    for a in arrays:
        kind = next(k for k in _KINDS if not len(a) or int(a.max()) <= np.iinfo(k).max)
        parts.append(np.array([kind.itemsize, len(a)], "<u8").tobytes())
        parts.append(np.ascontiguousarray(a.astype(kind).view(np.uint8).reshape(-1, kind.itemsize).T).tobytes())
    raw = b"".join(parts)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def _load(data: bytes) -> list[np.ndarray]:
    raw = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)
    n, at, out = int.from_bytes(raw[:8], "little"), 8, []
    for _ in range(n):
        size, length = np.frombuffer(raw, "<u8", 2, at).tolist()
        at += 16
        planes = np.frombuffer(raw, np.uint8, size * length, at).reshape(size, length)
        out.append(np.ascontiguousarray(planes.T).view(_KINDS[size.bit_length() - 1]).reshape(-1).astype(np.int64))
        at += size * length
    return out
