"""Word shingles of whole texts as 64-bit numbers, by NumPy over Arrow's own buffers.

Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased. Text is taken as
UTF-8 bytes: no byte of a longer character is one of these separators or letters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WIDTH = 5
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_MASK = np.array([(1 << 8 * k) - 1 for k in range(8)] + [2**64 - 1], dtype=np.uint64)
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every bit depends on every other."""
    x = (x ^ (x >> np.uint64(32))) * _ODD[3]
    x = (x ^ (x >> np.uint64(29))) * _ODD[0]
    return x ^ (x >> np.uint64(32))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the start of each text in them; a null is empty."""
    column = column.fill_null("") if column.null_count else column
    column = column.cast(pa.large_string())
    n, at = len(column), column.offset
    offsets = np.frombuffer(column.buffers()[1], np.int64)[at : at + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words; no word crosses from one text to the next."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    solid = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    first = solid.copy()
    first[1:] &= ~solid[:-1] | edge[1:-1]
    last = solid
    last[:-1] &= ~solid[1:] | edge[1:-1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, eight bytes at a time."""
    size = ends - starts
    hashes = mix(size.astype(np.uint64) + _ODD[4])
    padded = np.concatenate([_LOWER[data], np.zeros(8, np.uint8)])
    eights = np.ndarray((len(data) + 1,), "<u8", padded.tobytes(), strides=(1,))
    live, at = np.arange(len(starts)), 0
    while len(live):
        part = eights[starts[live] + at] & _MASK[np.minimum(8, size[live] - at)]
        hashes[live] = mix(hashes[live] ^ part)
        at += 8
        live = live[size[live] > at]
    return hashes


def shingle_sets(column: pa.Array, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """``(ends, hashes)``: text k has the distinct, sorted ``hashes[ends[k-1]:ends[k]]``.

    A text of fewer words than ``width`` has one shingle, the whole sequence; a text
    without words has none.
    """
    data, offsets = text_buffers(column)
    starts, stops = word_spans(data, offsets)
    words = word_hashes(data, starts, stops)
    bounds = np.searchsorted(starts, offsets)
    sums = np.zeros(len(words), np.uint64)
    for k in range(width):
        sums[: len(words) - k or None] += words[k:] * _ODD[k] if k < len(words) else np.uint64(0)
    found, ends = [], np.zeros(len(offsets) - 1, np.int64)
    whole = mix(sums)
    total = 0
    for k, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
        if b - a >= width:
            own = np.sort(whole[a : b - width + 1])
            own = own[np.concatenate(([True], own[1:] != own[:-1]))]
        elif b > a:
            part = (words[a:b] * _ODD[: b - a]).sum(dtype=np.uint64)
            own = mix(np.array([part ^ np.uint64(b - a)], np.uint64))
        else:
            own = whole[:0]
        found.append(own)
        total += len(own)
        ends[k] = total
    return ends, np.concatenate(found) if found else whole[:0]


def signatures(ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """128 bits for each set, as two columns; equal sets have equal ones."""
    sizes = np.diff(ends, prepend=0)
    out = np.zeros((len(ends), 2), np.uint64)
    held = sizes > 0
    at = (ends - sizes)[held]
    for k in range(2):
        if len(at):
            out[held, k] = mix(np.add.reduceat(mix(hashes ^ _ODD[k]), at) + sizes[held].astype(np.uint64))
    return out


def slices(batch: pa.RecordBatch, text: int, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of ``batch`` of about ``limit`` bytes of text, so that memory stays bounded."""
    _, offsets = text_buffers(batch.column(text))
    a = 0
    while a < batch.num_rows:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        b = min(b, batch.num_rows)
        yield batch.slice(a, b - a)
        a = b
    pa.default_memory_pool().release_unused()  # workers are used again, by other stages too
