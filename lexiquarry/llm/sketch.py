"""Counts by hash bucket: a table of fixed size, whatever the number of rows, so it may be broadcast."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

from lexiquarry.llm import arrays as ar

BLOCK = 1 << 12


def bucket_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def id_hashes(column: pa.Array) -> np.ndarray:
    """Hashes of an integer column; nulls count as 0."""
    return ar.mix(np.array(column.fill_null(0).cast(pa.int64())).view(np.uint64))


def bucket_counts(rows: DataFrame, hashes_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]],
                  bits: int) -> np.ndarray:
    """How many of the hashes fall into each of 2**bits buckets, over all rows.

    Every task adds up its own table and passes on its blocks that are not empty. The blocks are added where
    they meet, in bounded memory, and 4 * 2**bits bytes come to the driver.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, np.uint64)
        for batch in batches:
            for hashes in hashes_of(batch):
                np.add.at(total, bucket_of(hashes, bits), np.uint64(1))
        yield from blocks({i: b for i, b in enumerate(total.reshape(-1, min(BLOCK, len(total)))) if b.any()})

    def blocks(found: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        packed = [zlib.compress(np.minimum(b, 2**32 - 1).astype(np.uint32).tobytes(), 1) for b in found.values()]
        yield pa.record_batch([pa.array(found.keys(), pa.int32()), pa.array(packed, pa.binary())], ["block", "n"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                part = np.frombuffer(zlib.decompress(packed), np.uint32).astype(np.uint64)
                found[i] = found[i] + part if i in found else part
        yield from blocks(found)

    schema = "block int, n binary"
    summed = rows.mapInArrow(count, schema).repartition(8, "block").mapInArrow(add, schema).toArrow()
    out = np.zeros((1 << bits) // min(BLOCK, 1 << bits) * min(BLOCK, 1 << bits), np.uint32).reshape(-1, min(BLOCK, 1 << bits))
    for i, packed in zip(summed["block"].to_pylist(), summed["n"].to_pylist(), strict=True):
        out[i] = np.frombuffer(zlib.decompress(packed), np.uint32)
    return out.ravel()


def id_filter(ids: DataFrame, bits: int = 23) -> Broadcast:
    """A bit table of fixed size that holds every integer id of a one-column table, and few others."""
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << bits, bool)
        for batch in batches:
            table[bucket_of(id_hashes(batch.column(0)), bits)] = True
        yield from blocks({i: b for i, b in enumerate(np.packbits(table).reshape(-1, BLOCK)) if b.any()})

    def blocks(found: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        packed = [zlib.compress(b.tobytes(), 1) for b in found.values()]
        yield pa.record_batch([pa.array(found.keys(), pa.int32()), pa.array(packed, pa.binary())], ["block", "marks"])

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                part = np.frombuffer(zlib.decompress(packed), np.uint8)
                found[i] = found[i] | part if i in found else part
        yield from blocks(found)

    schema = "block int, marks binary"
    united = ids.mapInArrow(mark, schema).repartition(8, "block").mapInArrow(unite, schema).toArrow()
    table = np.zeros(((1 << bits) // 8 // BLOCK, BLOCK), np.uint8)
    for i, packed in zip(united["block"].to_pylist(), united["marks"].to_pylist(), strict=True):
        table[i] = np.frombuffer(zlib.decompress(packed), np.uint8)
    return ids.sparkSession.sparkContext.broadcast(table.ravel())


def may_hold(packed: np.ndarray, column: pa.Array) -> np.ndarray:
    """True for the ids that an `id_filter` holds, and for few others; as many bits as the table has."""
    place = bucket_of(id_hashes(column), int(len(packed) * 8).bit_length() - 1)
    return (packed[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 == 1
