"""CRC-32 of many byte strings, and of strings put together from them, as numpy arrays.

The checksum of two strings joined follows from the checksums of both and the length of the second:
that of the first is carried over as many zero bytes, which is a linear map, by tables of its
values for each byte.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa

STEP = 256  # bytes that one table lookup carries a checksum over at most


def _tables() -> np.ndarray:
    """``[n, k, b]``: byte ``b`` at place ``k`` of a checksum, carried over ``n`` zero bytes."""
    one = np.array([zlib.crc32(bytes([b]), 0xFFFFFFFF) ^ 0xFFFFFFFF for b in range(256)], np.uint32)
    out = np.zeros((STEP + 1, 4, 256), np.uint32)
    out[0] = np.arange(256, dtype=np.uint32) << (np.arange(4, dtype=np.uint32)[:, None] * np.uint32(8))
    for n in range(STEP):
        out[n + 1] = (out[n] >> np.uint32(8)) ^ one[out[n] & np.uint32(255)]
    return out.reshape(-1)


_TABLES = _tables()


def _step(checksums: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    base = lengths.astype(np.int32) * np.int32(1024)
    out = _TABLES[base + (checksums & np.uint32(255)).astype(np.int32)]
    for k in range(1, 4):
        out ^= _TABLES[base + ((checksums >> np.uint32(8 * k)) & np.uint32(255)).astype(np.int32) + np.int32(256 * k)]
    return out


def carried(checksums: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Checksums carried over ``lengths`` zero bytes."""
    out = _step(checksums, np.minimum(lengths, STEP))
    far = np.flatnonzero(lengths > STEP)
    left = lengths[far] - STEP
    while len(far):
        out[far] = _step(out[far], np.minimum(left, STEP))
        far, left = far[left > STEP], left[left > STEP] - STEP
    return out


def joined(first: np.ndarray, second: np.ndarray, second_lengths: np.ndarray) -> np.ndarray:
    """Checksums of pairs of strings put together."""
    return carried(first, second_lengths) ^ second


def word_checksums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, solid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Checksums of words, and of words with a space after them. ``solid`` marks the words' bytes.

    Equal words are found first, so each costs one call.
    """
    if not len(starts):
        return np.zeros(0, np.uint32), np.zeros(0, np.uint32)
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[solid])])
    coded = words.dictionary_encode()
    plain = np.array([zlib.crc32(w.as_buffer()) for w in coded.dictionary], np.uint32)
    spaced = np.array([zlib.crc32(b" ", c) for c in plain.tolist()], np.uint32)
    codes = np.asarray(coded.indices)
    return plain[codes], spaced[codes]
