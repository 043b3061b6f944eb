"""Benchmark decontamination: SimHash of item-sized windows, a multi-index on Hamming blocks, exact checks.

Each item is a multiset of word shingles with a 64-bit SimHash. A document's windows have as many words as the
item (the whole document, if it is shorter). Fingerprints are cut into 10 blocks of bits: if two differ in
19 bits at most, some block differs in one bit at most, so looking up every block with all its one-bit
changes finds all items within the radius. What is found is verified by the weighted Jaccard similarity
of the two multisets of shingles, each weighing as often as it occurs.

A window without any shingle of an item of its size cannot be similar to one, so windows are fingerprinted
only where such a shingle occurs. Everything happens in one pass over the documents, without a shuffle: the
items travel to the tasks in blocks of bounded size, one pass for each block.

Defined results: words as everywhere here (ASCII white space parts them, A-Z folded); an item of fewer
than `size` words, a null or empty one, and such a document match nothing; repeated items and rows each give
their own matches; empty tables give an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiquarry.llm import arrays as ar
from lexiquarry.llm.sketch import bucket_of

BLOCKS = 10
RADIUS = 2 * BLOCKS - 1
BLOCK_WORDS = 1_000_000
TABLE_BITS = 22
# Fixed by the 64 bits of a fingerprint: where each Hamming block begins.
_EDGES = np.linspace(0, 64, BLOCKS + 1).astype(int)
_BITS = np.uint64(1) << np.arange(64, dtype=np.uint64)


def _signs(shingles: np.ndarray) -> np.ndarray:
    """+1/-1 for every bit of every shingle hash."""
    return np.where(shingles[:, None] & _BITS, np.int32(1), np.int32(-1))


def simhash(sums: np.ndarray) -> np.ndarray:
    """Fingerprints from sums of signs; a bit is set where the sum is above zero."""
    return np.packbits(sums > 0, axis=1, bitorder="little").view(np.uint64).ravel()


def _blocks(prints: np.ndarray) -> np.ndarray:
    """Value of each Hamming block of each fingerprint."""
    parts = [(prints >> np.uint64(a)) & np.uint64((1 << int(b - a)) - 1) for a, b in zip(_EDGES[:-1], _EDGES[1:], strict=True)]
    return np.stack(parts, axis=1).astype(np.int64)


def weighted_jaccard(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """(sum of smaller, sum of larger counts) over the values of two arrays."""
    values, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    in_a = np.bincount(place[:len(a)], minlength=len(values))
    in_b = np.bincount(place[len(a):], minlength=len(values))
    return int(np.minimum(in_a, in_b).sum()), int(np.maximum(in_a, in_b).sum())


class SizeClass:
    """The items of one number of words."""

    def __init__(self, members: list[tuple[int, np.ndarray]]) -> None:
        self.ids = [i for i, _ in members]
        self.shingles = [s for _, s in members]
        self.length = len(self.shingles[0])
        self.known = np.unique(np.concatenate(self.shingles))
        self.sets = [np.unique(s) for s in self.shingles]
        self.prints = simhash(np.stack([_signs(s).sum(axis=0) for s in self.shingles]))
        # near[block][value, item]: the item's block is that value or one bit off.
        values = _blocks(self.prints)
        self.near = []
        for k in range(BLOCKS):
            width = int(_EDGES[k + 1] - _EDGES[k])
            near = np.zeros((1 << width, len(members)), bool)
            for change in [0, *(1 << b for b in range(width))]:
                near[values[:, k] ^ change, np.arange(len(members))] = True
            self.near.append(near)

    def candidates(self, prints: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(window, item, distance) within the radius."""
        values = _blocks(prints)
        found = np.zeros((len(prints), len(self.ids)), bool)
        for k in range(BLOCKS):
            found |= self.near[k][values[:, k]]
        window, item = np.nonzero(found)
        distance = np.bitwise_count(prints[window] ^ self.prints[item])
        ok = distance <= RADIUS
        return zip(window[ok].tolist(), item[ok].tolist(), distance[ok].tolist(), strict=True)


class ItemIndex:
    def __init__(self, items: list[tuple[int, np.ndarray]], size: int, threshold: Fraction) -> None:
        self.size, self.threshold = size, threshold
        by_length: dict[int, list] = {}
        for i, words in items:
            if len(words) >= size:
                shingles = ar.shingle_hashes(words, size)
                by_length.setdefault(len(shingles), []).append((i, shingles))
        self.classes = [SizeClass(m) for _, m in sorted(by_length.items())]
        # A table of fixed size tells most shingles apart from those of items at once.
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.known = np.unique(np.concatenate([c.known for c in self.classes])) if self.classes else np.zeros(0, np.uint64)
        self.table[bucket_of(self.known, TABLE_BITS)] = True

    def matches(self, words: np.ndarray) -> list[tuple[int, int, int, int, float]]:
        """(item, first word, words, distance, similarity): the best window of a document for each item."""
        if len(words) < self.size:
            return []
        shingles = ar.shingle_hashes(words, self.size)
        hits = np.flatnonzero(self.table[bucket_of(shingles, TABLE_BITS)])
        if len(hits):
            place = np.minimum(np.searchsorted(self.known, shingles[hits]), len(self.known) - 1)
            hits = hits[self.known[place] == shingles[hits]]
        out = []
        for c in self.classes if len(hits) else []:
            own = hits[np.isin(shingles[hits], c.known)]
            if len(own):
                out += self._in_class(c, shingles, own)
        return out

    def _in_class(self, c: SizeClass, shingles: np.ndarray, hits: np.ndarray) -> list:
        length = min(c.length, len(shingles))
        cover = np.zeros(len(shingles) - length + 2, np.int64)
        np.add.at(cover, np.maximum(hits - length + 1, 0), 1)
        np.add.at(cover, np.minimum(hits, len(shingles) - length) + 1, -1)
        starts = np.flatnonzero(np.cumsum(cover[:-1]) > 0)
        best: dict[int, tuple] = {}
        for run in np.split(starts, np.flatnonzero(np.diff(starts) > 1) + 1):
            for at in range(0, len(run), 4096):
                part = run[at:at + 4096]
                inside = shingles[part[0]:part[-1] + length]
                sums = np.zeros((len(inside) + 1, 64), np.int32)
                np.cumsum(_signs(inside), axis=0, out=sums[1:])
                prints = simhash(sums[length:] - sums[:-length])
                reach: dict[int, np.ndarray] = {}
                for window, item, distance in c.candidates(prints):
                    if item not in reach:
                        reach[item] = np.concatenate([[0], np.cumsum(np.isin(inside, c.sets[item]))])
                    # At most so many shingles are common; the smaller sum cannot be larger.
                    most = int(reach[item][window + length] - reach[item][window])
                    if most < self.threshold * max(length, c.length):
                        continue
                    low, high = weighted_jaccard(inside[window:window + length], c.shingles[item])
                    new = (low / high, -int(part[0]) - window, distance)
                    if low >= self.threshold * high and new > best.get(item, (0.0,)):
                        best[item] = new
        n_words = length + self.size - 1
        return [(c.ids[i], -start, n_words, distance, similarity) for i, (similarity, start, distance) in best.items()]


def item_blocks(benchmark: DataFrame, key: str, text: str, block_words: int) -> Iterator[list[tuple[int, np.ndarray]]]:
    """The items' word hashes, in blocks of about `block_words` words."""
    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        words = [ar.signed(w) for _, w in ar.words_by_row(batch.column(1))]
        yield {"id": batch.column(0), "words": ar.list_column(words, pa.int64())}

    rows = ar.map_arrow(benchmark.select(F.col(key).cast("long"), text), work, "id long, words array<long>")
    block, held = [], 0
    for row in rows.toLocalIterator():
        block.append((row["id"], np.array(row["words"], np.int64).view(np.uint64)))
        held += len(row["words"])
        if held >= block_words:
            yield block
            block, held = [], 0
    yield block


def _indexes(documents: DataFrame, benchmark: DataFrame, item_key: str, item_text: str, size: int,
             threshold: Fraction, block_words: int) -> Iterator:
    context = documents.sparkSession.sparkContext
    for block in item_blocks(benchmark, item_key, item_text, block_words):
        yield context.broadcast(ItemIndex(block, size, threshold))


def find_leaks(documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
               item_key: str = "item_id", item_text: str = "text", size: int = 5,
               threshold: Fraction = Fraction(4, 5), block_words: int = BLOCK_WORDS) -> DataFrame:
    """(key, item_key, start_word, n_words, distance, similarity): the best window for each row and item."""
    kind = dict(documents.dtypes)[key]
    rows = documents.select(key, text)
    schema = f"{key} {kind}, {item_key} long, start_word int, n_words int, distance int, similarity double"
    found = None
    for index in _indexes(documents, benchmark, item_key, item_text, size, threshold, block_words):
        def work(batch: pa.RecordBatch, index=index) -> Iterator[dict]:
            keys, hits = [], []
            for row, words in ar.words_by_row(batch.column(1)):
                for match in index.value.matches(words):
                    keys.append(row)
                    hits.append(match)
            columns = list(zip(*hits, strict=True)) or [()] * 5
            names = (item_key, "start_word", "n_words", "distance", "similarity")
            yield {key: batch.column(0).take(pa.array(keys, pa.int64()))} | dict(zip(names, columns, strict=True))

        part = ar.map_arrow(rows, work, schema)
        found = part if found is None else found.unionByName(part)
    return found


def without_leaks(documents: DataFrame, benchmark: DataFrame, text: str = "text", item_key: str = "item_id",
                  item_text: str = "text", size: int = 5, threshold: Fraction = Fraction(4, 5),
                  block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows that match no item, with all their columns; rows are filtered where they are."""
    place = documents.columns.index(text)
    for index in _indexes(documents, benchmark, item_key, item_text, size, threshold, block_words):
        def clean(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = [not index.value.matches(words) for _, words in ar.words_by_row(batch.column(place))]
                yield batch.filter(pa.array(keep, pa.bool_()))

        documents = documents.mapInArrow(clean, documents.schema)
    return documents
