"""Numpy views of Arrow text columns: word hashes, word shingles, block-wise row loops.

All functions work on whole texts. Texts of a batch are handled in blocks of about `BLOCK_BYTES`, so the
working memory of a task does not depend on the batch, and a single long text is cut at white space.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

BLOCK_BYTES = 1 << 20
SHINGLE_WORDS = 5

# ASCII white space that separates words.
WHITE_SPACE = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

_STEP = np.uint64(0x9E3779B97F4A7C15)
_MULTIPLIER = 0xD1342543DE82EF95
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)

SPACE_TABLE = np.zeros(256, bool)
SPACE_TABLE[list(WHITE_SPACE)] = True

FOLD = np.arange(256, dtype=np.uint8)
FOLD[ord("A"):ord("Z") + 1] += 32


def mix(values: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values one to one, so that every output bit depends on every input bit."""
    x = values + _STEP
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_VALUES = mix(np.arange(256, dtype=np.uint64))[FOLD]
_SHINGLE_FACTORS = mix(np.arange(1000, 1000 + 64, dtype=np.uint64)) | np.uint64(1)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash multiplier and of its inverse, modulo 2**64."""
    if not _POWERS or len(_POWERS["up"]) < n:
        size = max(n, BLOCK_BYTES + 1)
        for name, base in (("up", _MULTIPLIER), ("down", _INVERSE)):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            _POWERS[name] = np.multiply.accumulate(factors)
    return _POWERS["up"], _POWERS["down"]


def text_buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), bounds


def row_blocks(offsets: np.ndarray, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about `block_bytes` each; a longer row makes a range of its own."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + block_bytes, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of data[start:end], ASCII letters folded to lower case."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * up[:len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_bounds(data: np.ndarray, breaks: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes outside `separators`; a word never crosses a row break."""
    inside = ~separators[data]
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    cuts = breaks[(breaks > 0) & (breaks < len(data))]
    start[cuts] = inside[cuts]
    end[cuts - 1] = inside[cuts - 1]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def _cut_long(data: np.ndarray, separators: np.ndarray) -> list[np.ndarray]:
    """Pieces of one text, cut at separators near every BLOCK_BYTES."""
    pieces, at = [], 0
    while len(data) - at > BLOCK_BYTES:
        gaps = np.flatnonzero(separators[data[at:at + BLOCK_BYTES]])
        if len(gaps):
            cut = at + int(gaps[-1]) + 1
        else:  # one word longer than a block
            cut = at + BLOCK_BYTES
            while cut < len(data) and not separators[data[cut]]:
                cut += 1
        pieces.append(data[at:cut])
        at = cut
    return [*pieces, data[at:]]


def words_by_block(column: pa.Array, separators: np.ndarray = SPACE_TABLE,
                   hashes_of: Callable = hash_words) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, hashes of the words of all rows, bounds of each row's words) for blocks of rows of a text column.

    `hashes_of` may return several values for each word, one word per row of a matrix.
    """
    data, offsets = text_buffers(column)
    for first, last in row_blocks(offsets):
        block = data[offsets[first]:offsets[last]]
        if last - first == 1 and len(block) > BLOCK_BYTES:
            parts = [hashes_of(p, *word_bounds(p, np.zeros(0, np.int64), separators))
                     for p in _cut_long(block, separators)]
            hashes = np.concatenate(parts)
            yield first, hashes, np.array([0, len(hashes)])
            continue
        breaks = offsets[first:last + 1] - offsets[first]
        starts, ends = word_bounds(block, breaks, separators)
        yield first, hashes_of(block, starts, ends), np.searchsorted(starts, breaks)


def words_by_row(column: pa.Array, separators: np.ndarray = SPACE_TABLE,
                 hashes_of: Callable = hash_words) -> Iterator[tuple[int, np.ndarray]]:
    """(row, hashes of its words in order) for every row of a text column, see `words_by_block`."""
    for first, hashes, cuts in words_by_block(column, separators, hashes_of):
        for i in range(len(cuts) - 1):
            yield first + i, hashes[cuts[i]:cuts[i + 1]]


def shingle_hashes(words: np.ndarray, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Hash of every run of `size` words, in order; of all words if there are fewer; none without words."""
    size = min(size, len(words))
    if not size:
        return np.zeros(0, np.uint64)
    n = len(words) - size + 1
    total = np.full(n, size, np.uint64)
    for k in range(size):
        total += words[k:k + n] * _SHINGLE_FACTORS[k]
    return mix(total)


def map_arrow(rows: DataFrame, work: Callable[[pa.RecordBatch], Iterator[dict]], schema: str) -> DataFrame:
    """`mapInArrow` for a function that yields {column: values} per batch or part of a batch."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in batches:
                for out in work(batch):
                    yield pa.record_batch([as_arrow(out[f.name], f.type) for f in arrow], schema=arrow)
        finally:
            give_back_memory()

    return rows.mapInArrow(run, schema)


def give_back_memory() -> None:
    """Return what a task has freed to the system; workers outlive tasks, and idle ones would keep it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # another C library
        pass


def as_arrow(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, kind)


def list_column(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """List column from one numpy array per row."""
    ends = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=ends[1:])
    flat = np.concatenate(parts) if parts else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, kind))


def signed(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values).view(np.int64)
