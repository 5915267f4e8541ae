"""Levels of an n-gram trie in Elias-Fano form, searched as they are packed, and read through a memory map."""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager
from typing import NamedTuple

import numpy as np

#: Codes of shares for each halving.
STEPS = 1024
#: Ones in a byte, and the place of its r-th one.
ONES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(1).astype(np.int64)
PLACE = np.zeros((256, 9), np.int64)
for _byte in range(256):
    _places = np.flatnonzero(np.unpackbits(np.uint8(_byte), bitorder="little"))
    PLACE[_byte, : len(_places)] = _places


class Level(NamedTuple):
    """Elias-Fano parts of a monotone sequence: ``width`` low bits of each value in ``low`` (whole bytes), the rest unary
    in ``high``, and the number of ones before each 64 bits of it."""

    size: int
    width: int
    low: np.ndarray
    high: np.ndarray
    before: np.ndarray


def encode(values: np.ndarray, universe: int) -> Level:
    """values: sorted, below ``universe``."""
    size = len(values)
    width = max(0, (max(1, universe) // max(1, size)).bit_length() - 1)
    values = values.astype(np.uint64)
    kept = -(-width // 8)
    low = (values & np.uint64((1 << width) - 1)).view(np.uint8).reshape(-1, 8)[:, :kept]
    places = (values >> np.uint64(width)).astype(np.int64) + np.arange(size)
    bits = np.zeros(-(-(size + (universe >> width) + 2) // 64) * 64, np.uint8)
    bits[places] = 1
    high = np.packbits(bits, bitorder="little")
    each = ONES[high].reshape(-1, 8).sum(1)
    return Level(size, width, np.ascontiguousarray(low).reshape(-1), high, (np.cumsum(each) - each).astype(np.uint32))


def _select(level: Level, rank: np.ndarray, zeros: bool) -> np.ndarray:
    """Place of the ``rank``-th one, or zero, of the high bits."""
    before = level.before.astype(np.int64)
    if zeros:
        before = np.arange(len(before)) * 64 - before
    word = np.searchsorted(before, rank, "right") - 1
    rest, at = rank - before[word], word * 8
    flip = np.uint8(255 if zeros else 0)
    for _ in range(7):
        held = ONES[level.high[at] ^ flip]
        move = rest >= held
        rest = rest - np.where(move, held, 0)
        at = at + move
    return at * 8 + PLACE[level.high[at] ^ flip, rest]


def _low(level: Level, at: np.ndarray) -> np.ndarray:
    kept = -(-level.width // 8)
    out = np.zeros(len(at), np.uint64)
    for byte in range(kept):
        out |= level.low[at * kept + byte].astype(np.uint64) << np.uint64(8 * byte)
    return out


def access(level: Level, at: np.ndarray) -> np.ndarray:
    """The values at the given places."""
    upper = (_select(level, at, False) - at).astype(np.uint64)
    return (upper << np.uint64(level.width)) | _low(level, at)


def find(level: Level, values: np.ndarray, first: np.ndarray | int = 0, last: np.ndarray | int | None = None) -> np.ndarray:
    """Place of each value among the places from ``first`` to before ``last``, or -1; values lie below the universe.

    The next value not below the wanted one is searched among those with the same upper bits, which two selects bound.
    """
    if not level.size or not len(values):
        return np.full(len(values), -1)
    values = values.astype(np.uint64)
    upper = (values >> np.uint64(level.width)).astype(np.int64)
    begin = np.where(upper > 0, _select(level, np.maximum(upper - 1, 0), True) - upper + 1, 0)
    end = _select(level, upper, True) - upper
    begin, end = np.maximum(begin, first), np.minimum(end, level.size if last is None else last)
    wanted = values & np.uint64((1 << level.width) - 1)
    low, high = begin.copy(), np.maximum(begin, end)
    active = np.flatnonzero(low < high)
    while len(active):
        middle = (low[active] + high[active]) >> 1
        below = _low(level, middle) < wanted[active]
        low[active] = np.where(below, middle + 1, low[active])
        high[active] = np.where(below, high[active], middle)
        active = active[low[active] < high[active]]
    inside = np.flatnonzero(low < end)
    out = np.full(len(values), -1)
    same = inside[_low(level, low[inside]) == wanted[inside]]
    out[same] = low[same]
    return out


def quantise(values: np.ndarray) -> np.ndarray:
    """Two bytes for each share between 2 ** -63 and 1: its logarithm in steps of 0.07 %, never rounded up."""
    return np.ceil(-np.log2(np.clip(values, 2.0**-63, 1.0)) * STEPS).astype(np.uint16)


def restore(codes: np.ndarray) -> np.ndarray:
    return 2.0 ** (-codes.astype(np.float64) / STEPS)


@contextmanager
def mapped(arrays: list[np.ndarray]):
    """The arrays as memory maps of one file, which goes with the task that uses it."""
    handle, path = tempfile.mkstemp(suffix=".trie")
    try:
        with os.fdopen(handle, "wb") as out:
            for array in arrays:
                out.write(np.ascontiguousarray(array).tobytes())
                out.write(bytes(-array.nbytes % 8))
        views, at = [], 0
        for array in arrays:
            views.append(np.memmap(path, array.dtype, "r", at, array.shape) if array.size else array)
            at += array.nbytes + -array.nbytes % 8
        yield views
    finally:
        os.unlink(path)
