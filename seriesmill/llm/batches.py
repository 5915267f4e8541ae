"""Arrow batches of texts as numpy arrays: words, word hashes and shingles of many documents at once."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2 << 20
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
BASE = 0x2545F4914F6CDD1D
_powers: dict[int, np.ndarray] = {}


def mix(values: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values (two multiply and shift rounds)."""
    out = values ^ (values >> np.uint64(32))
    out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xCA5A826395121157)
    out ^= out >> np.uint64(32)
    return out


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * GOLDEN)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True


def powers(base: int, size: int) -> np.ndarray:
    """base ** 0, 1, .. modulo 2 ** 64; kept by the worker."""
    known = _powers.get(base)
    if known is None or len(known) < size:
        grown = np.full(max(size, CHUNK_BYTES) + 4096, base, dtype=np.uint64)
        grown[0] = 1
        known = _powers[base] = np.multiply.accumulate(grown)
    return known[:size]


class Texts(NamedTuple):
    """Texts of consecutive rows: all bytes, where each text begins, and the rows of the batch."""

    data: np.ndarray
    offsets: np.ndarray
    first: int
    last: int


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; a null is an empty text."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset :][: len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Texts]:
    """Cut a text column into runs of whole texts of about ``limit`` bytes (a longer text stands alone)."""
    if not len(column):
        return
    data, offsets = text_bytes(column)
    row, rows = 0, len(column)
    while row < rows:
        stop = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        stop = min(max(stop, row + 1), row + 4095, rows)
        yield Texts(data[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row], row, stop)
        row = stop


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Running polynomial hashes, so that any byte range is hashed by one subtraction."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[data] * powers(BASE, len(data)), out=sums[1:])
    return sums


def range_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    inverse = powers(pow(BASE, -1, 1 << 64), len(sums))
    lengths = (ends - starts).astype(np.uint64)
    return mix((sums[ends] - sums[starts]) * inverse[starts] + lengths * GOLDEN)


class Words(NamedTuple):
    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray  # first word of each text, and the number of words
    hashes: np.ndarray


def words(texts: Texts) -> Words:
    """Words between white space bytes, A-Z lower-cased before hashing."""
    data, offsets = LOWER[texts.data], texts.offsets
    solid = ~SPACE[data]
    begins, ends = solid.copy(), solid.copy()
    if len(data):
        begins[1:] &= ~solid[:-1]
        ends[:-1] &= ~solid[1:]
        edges = offsets[:-1][np.diff(offsets) > 0]
        begins[edges] = solid[edges]
        edges = offsets[1:][np.diff(offsets) > 0] - 1
        ends[edges] = solid[edges]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return Words(starts, stops, np.searchsorted(starts, offsets), range_hashes(prefix_hashes(data), starts, stops))


def shingles(found: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every run of ``size`` words; a shorter text gives its whole sequence, an empty one nothing."""
    counts = np.diff(found.offsets)
    each = np.maximum(counts - size + 1, np.minimum(counts, 1))
    text = np.repeat(np.arange(len(counts)), each)
    place = np.arange(len(text)) - np.repeat(np.cumsum(each) - each, each)
    at, end = found.offsets[:-1][text] + place, found.offsets[1:][text]
    total = np.zeros(len(text), np.uint64)
    padded = np.append(found.hashes, np.zeros(size, np.uint64))
    for step in range(size):
        inside = at + step < end
        weight = mix(np.array([step + 1], np.uint64) * GOLDEN)[0] | np.uint64(1)
        total += np.where(inside, padded[at + step] * weight, np.uint64(0))
    return text, mix(total + np.minimum(counts, size).astype(np.uint64)[text] * GOLDEN)


def as_long(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def lists(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))


def cut_by_bucket(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorting order of hashes, and where each of ``buckets`` equal ranges of values begins in it."""
    order = np.argsort(hashes)
    width = -(-(1 << 64) // buckets)
    limits = np.array([width * i for i in range(1, buckets)], np.uint64)
    inner = np.searchsorted(hashes[order], limits)
    return order, np.concatenate(([0], inner, [len(hashes)])).astype(np.int64)
