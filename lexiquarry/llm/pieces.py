"""Helpers shared by the tokenising operators: distinct pieces of a block, and lists gathered by index."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def distinct_pieces(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """(index of each piece in the list of distinct ones, that list), for pieces data[start:end] in order."""
    sizes = ends - starts
    inside = np.zeros(len(data) + 1, np.int8)
    inside[starts] += 1
    inside[ends] -= 1  # pieces do not overlap, so no place ends two of them, and sums are 0 or 1
    flat = data[np.cumsum(inside[:-1], dtype=np.int8).view(bool)]
    offsets = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=offsets[1:])
    column = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(flat)])
    coded = column.dictionary_encode()
    return np.array(coded.indices), coded.dictionary.to_pylist()


def marked(n: int, *places: np.ndarray) -> np.ndarray:
    """The given places below n, ascending and each once."""
    marks = np.zeros(n, bool)
    for p in places:
        marks[p[p < n]] = True
    return np.flatnonzero(marks)


def gather(values: np.ndarray, sizes: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenation of list number index[0], index[1], ... and the bounds of each in it.

    `values` holds all lists one after the other, `sizes` their lengths.
    """
    first = np.cumsum(sizes) - sizes
    taken = sizes[index]
    bounds = np.zeros(len(index) + 1, np.int64)
    np.cumsum(taken, out=bounds[1:])
    place = np.arange(bounds[-1]) + np.repeat(first[index] - bounds[:-1], taken)
    return values[place], bounds


class Memo(dict):
    """Results by piece, emptied when it holds `limit` entries."""

    def __init__(self, limit: int = 800_000) -> None:
        super().__init__()
        self.limit = limit

    def lookup(self, keys: list[bytes], compute) -> list:
        """Results for all keys; `compute` makes those of the missing ones."""
        found = list(map(self.get, keys))
        missing = [i for i, value in enumerate(found) if value is None]
        if missing:
            for i, value in zip(missing, compute([keys[i] for i in missing]), strict=True):
                found[i] = value
            full = len(self) + len(missing) > self.limit
            if full:
                self.clear()
            self.update(zip(keys, found, strict=True) if full else ((keys[i], found[i]) for i in missing))
        return found
