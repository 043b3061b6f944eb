"""Runs of consecutive words as byte strings, one space between two words, for hashes that a contract fixes."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from lexiquarry.llm import arrays as ar


@dataclass(frozen=True)
class WordBlock:
    """Words of the rows `first` to before `last` of a column: data[starts[i]:ends[i]], A-Z folded.

    A text longer than a block comes in several ones. Each of them begins with the last words of the one before, `old`
    in number; `counts` tells how many words of each row came so far, and `whole` if the rows end here.
    """

    data: bytes
    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray
    first: int
    last: int
    counts: np.ndarray
    old: int = 0
    whole: bool = True

    def runs(self, size: int, shorter: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, start, end) of every run of `size` words that earlier blocks did not hold, by row.

        With `shorter`, all words of a row that has fewer are one run.
        """
        at = np.arange(max(len(self.starts) - size + 1, 0))
        at = at[(self.rows[at] == self.rows[at + size - 1]) & (at + size > self.old)]
        rows, starts, ends = self.rows[at], self.starts[at], self.ends[at + size - 1]
        if shorter and self.whole:
            few = self.first + np.flatnonzero((self.counts > 0) & (self.counts < size))
            head, tail = np.searchsorted(self.rows, few), np.searchsorted(self.rows, few, "right") - 1
            rows = np.concatenate([rows, few])
            order = np.argsort(rows, kind="stable")
            rows = rows[order]
            starts = np.concatenate([starts, self.starts[head]])[order]
            ends = np.concatenate([ends, self.ends[tail]])[order]
        return rows, starts, ends

    def hashes(self, of: Callable[[bytes], int], starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        data = self.data
        return np.fromiter((of(data[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)), np.uint64, len(starts))


def _joined(data: np.ndarray, breaks: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends, starts in `data`) of the words with all separators but one after each word left out."""
    starts, ends = ar.word_bounds(data, breaks, separators)
    keep = ~separators[data]
    keep[ends[ends < len(data)]] = True  # a byte of the next row, or the separator that becomes the space
    place = np.cumsum(keep) - keep
    joined = np.where(separators[data[keep]], np.uint8(0x20), ar.FOLD[data[keep]])
    return joined, place[starts], place[starts] + (ends - starts), starts


def word_blocks(column: pa.Array, separators: np.ndarray, carry: int) -> Iterator[WordBlock]:
    """The words of every row; `carry` words of a long text are seen again in its next block."""
    data, offsets = ar.text_buffers(column)
    for first, last in ar.row_blocks(offsets):
        block = data[offsets[first]:offsets[last]]
        if last - first == 1 and len(block) > ar.BLOCK_BYTES:
            yield from _long_row(block, separators, carry, first)
            continue
        breaks = offsets[first:last + 1] - offsets[first]
        joined, starts, ends, places = _joined(block, breaks, separators)
        rows = np.searchsorted(breaks, places, "right") - 1
        yield WordBlock(joined.tobytes(), starts, ends, first + rows, first, last, np.bincount(rows, minlength=last - first))


def _long_row(text: np.ndarray, separators: np.ndarray, carry: int, row: int) -> Iterator[WordBlock]:
    tail, old, count = np.zeros(0, np.uint8), 0, 0
    pieces = ar._cut_long(text, separators)
    for i, piece in enumerate(pieces):
        part = np.concatenate([tail, piece])
        joined, starts, ends, _ = _joined(part, np.zeros(0, np.int64), separators)
        count += len(starts) - old
        yield WordBlock(joined.tobytes(), starts, ends, np.full(len(starts), row), row, row + 1, np.array([count]), old,
                        i == len(pieces) - 1)
        old = min(carry, len(starts))
        kept = joined[starts[len(starts) - old]:] if old else np.zeros(0, np.uint8)
        tail = np.concatenate([kept, np.array([0x20], np.uint8)]) if old else kept
