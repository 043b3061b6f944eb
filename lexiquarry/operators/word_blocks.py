"""Words of blocks of documents in flat arrays, for work that stays inside documents.

A block has about `BLOCK_WORDS` words; a longer document is a block of its own.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from lexiquarry.operators.normalize import DOCUMENT

BLOCK_WORDS = 1 << 18


@dataclass(frozen=True)
class Words:
    """The words of some documents in order: dictionary, and for each word its number there, its document and sentence."""

    names: pa.Array
    code: np.ndarray
    doc: np.ndarray
    sentence: np.ndarray

    @classmethod
    def of(cls, sentences: pa.Array) -> Words:
        """From an array of sentences a row, words joined by spaces. Sentence numbers run over all rows."""
        parts = pc.split_pattern(sentences.flatten(), " ")
        sentence, doc_of_sentence = np.array(pc.list_parent_indices(parts)), np.array(pc.list_parent_indices(sentences))
        flat = parts.flatten()
        held = pc.fill_null(pc.not_equal(flat, ""), False)
        coded = flat.filter(held).dictionary_encode()
        sentence = sentence[np.array(held)]
        return cls(coded.dictionary, np.array(coded.indices, np.int64), doc_of_sentence[sentence], sentence)


def blocks_of(texts: pa.Array, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of an array of sentences a row, of about `size` words each."""
    # Spaces and sentences tell the number of words well enough.
    n = np.array(pc.fill_null(pc.list_value_length(texts), 0))
    lengths = np.array(pc.fill_null(pc.utf8_length(texts.flatten()), 0))
    ends = np.concatenate([[0], np.cumsum(lengths)])[np.cumsum(n)] // 6
    at = 0
    while at < len(texts):
        last = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right"))
        last = min(max(last, at + 1), len(texts))
        yield at, last
        at = last


def give_back_memory() -> None:
    """Return freed memory to the system; workers outlive tasks and keep it else."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # another C library
        pass


def _changes(column: pa.Array) -> np.ndarray:
    """For each value but the first, whether it differs from the one before; null equals null."""
    last, this = column.slice(0, len(column) - 1), column.slice(1)
    differ = np.array(pc.fill_null(pc.not_equal(last, this), False), bool)
    return differ | (np.array(pc.is_null(last), bool) != np.array(pc.is_null(this), bool))


def whole_groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by `keys`."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        opens = np.zeros(batch.num_rows, bool)
        for name in keys:
            before = held[-1][name].slice(held[-1].num_rows - 1) if held else batch[name].slice(0, 1)
            opens |= _changes(pa.concat_arrays([before, batch[name]]))
        last = np.flatnonzero(opens)[-1:]
        if len(last):
            if held or last[0]:
                yield pa.Table.from_batches([*held, batch.slice(0, last[0])]).combine_chunks()
            held = []
        held.append(batch.slice(last[0] if len(last) else 0))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def column_of(table: pa.Table, name: str) -> pa.Array:
    column = table[name]
    return column.chunk(0) if column.num_chunks == 1 else column.combine_chunks()


def group_numbers(table: pa.Table, keys: Sequence[str]) -> np.ndarray:
    """Number of the group of each row of a table sorted by `keys`."""
    opens = np.zeros(table.num_rows, bool)
    for name in keys:
        opens[1:] |= _changes(column_of(table, name))
    return np.cumsum(opens)


def by_block(sentences: DataFrame, columns: str, work: Callable[[Words], tuple]) -> DataFrame:
    """(doc_id, field, …): rows that `work` gives for blocks of documents, as (document of each row, further columns)."""
    kinds = dict(sentences.dtypes)
    schema = f"doc_id {kinds['doc_id']}, field string, {columns}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2)
            for at, last in blocks_of(texts, BLOCK_WORDS):
                doc, *values = work(Words.of(texts.slice(at, last - at)))
                rows = pa.array(doc + at)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), batch.column(1).take(rows), *values], names)
            give_back_memory()

    names = ["doc_id", "field", *[c.split()[0] for c in columns.split(", ")]]
    return sentences.select(*DOCUMENT, "sentences").mapInArrow(run, schema)
