"""Token ids as Parquet list columns that can be read selectively.

Texts are range-partitioned by key and encoded inside the sorted partitions, so the files follow the keys and
every row knows its place. Ids are dictionary encoded, keys and counts delta encoded; row groups and pages
have a set size, and page indexes let readers skip to single keys or read the counts alone.

Defined results: a null or empty text has only the end id; rows of one key are ordered by text and all
kept; null keys come first; an empty table gives empty files. Strings of the tokenizer's own special
tokens inside a text become those tokens, as the library does it. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexiquarry.llm import arrays as ar
from lexiquarry.llm.pieces import Memo, distinct_pieces, gather, marked

BLOCK_BYTES = 8 << 20
ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_OTHER = np.zeros(256, bool)
_OTHER[:128] = True
_OTHER &= ~_LETTER & ~ar.SPACE_TABLE


class WordEncoder:
    """Encodes texts word by word with a tokenizer that lower-cases, drops white space and splits at words.

    No token of such a tokenizer spans white space, nor an ASCII letter followed by another ASCII
    character, so the text is cut there and each distinct piece goes through the library once. A text that
    contains a special token's string is given to the library whole.
    """

    def __init__(self, path: str, end_id: int) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.end_id = end_id
        specials = self.tokenizer.get_added_tokens_decoder()
        self.specials = {t.content.encode(): i for i, t in specials.items()}
        self.comma, self.comma_id = next((t.content, i) for i, t in specials.items())
        self.memo = Memo()

    def _library(self, pieces: list[bytes]) -> Iterator[bytes]:
        comma = self.comma.encode()
        for at in range(0, len(pieces), 1000):
            text = comma.join(pieces[at:at + 1000]).decode("utf-8", "replace")
            # The special token between two pieces shows where the ids of each end.
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int32)
            ends, raw, first = np.flatnonzero(ids == self.comma_id).tolist(), ids.tobytes(), 0
            for end in [*ends, len(ids)]:
                yield raw[4 * first:4 * end]
                first = end + 1

    def whole(self, text: bytes) -> np.ndarray:
        coded = self.tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False)
        return np.array([*coded.ids, self.end_id], np.int32)

    def block(self, data: np.ndarray, breaks: np.ndarray, ended: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the rows of a block, each with its end id if `ended`, and their bounds."""
        starts, ends = ar.word_bounds(data, breaks, ar.SPACE_TABLE)
        # Between two rows there is a border anyway, if both touch it with a word.
        cuts = np.flatnonzero(_LETTER[data[:-1]] & _OTHER[data[1:]]) + 1
        starts, ends = marked(len(data), starts, cuts), marked(len(data) + 1, ends, cuts)
        index, distinct = distinct_pieces(ar.FOLD[data], starts, ends)
        known = self.memo.lookup(distinct, self._library)
        values = np.frombuffer(b"".join(known) + np.int32(self.end_id).tobytes(), np.int32)
        sizes = np.array([len(k) // 4 for k in known] + [1], np.int64)
        rows = np.searchsorted(starts, breaks)
        if ended:
            index = np.insert(index, rows[1:], len(known))
            rows = rows + np.arange(len(rows))
        ids, bounds = gather(values, sizes, index)
        return ids, bounds[rows]

    def batches(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first row, last row, ids, bounds of each row's ids) for blocks of a text column."""
        data, offsets = ar.text_buffers(column)
        for first, last in ar.row_blocks(offsets, BLOCK_BYTES):
            block = data[offsets[first]:offsets[last]]
            raw = block.tobytes()
            if any(s in raw for s in self.specials):
                for row in range(first, last):
                    own = data[offsets[row]:offsets[row + 1]]
                    if any(s in own.tobytes() for s in self.specials):
                        ids = self.whole(own.tobytes())
                        yield row, row + 1, ids, np.array([0, len(ids)])
                    else:
                        yield row, row + 1, *self.long_row(own)
            elif last - first == 1:
                yield first, last, *self.long_row(block)
            else:
                yield first, last, *self.block(block, offsets[first:last + 1] - offsets[first])

    def long_row(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        parts = [self.block(p, np.array([0, len(p)]), ended=False)[0] for p in ar._cut_long(data, ar.SPACE_TABLE)]
        ids = np.concatenate([*parts, np.array([self.end_id], np.int32)])
        return ids, np.array([0, len(ids)])


_ENCODERS: dict[tuple[str, int], WordEncoder] = {}


def encoder(path: str, end_id: int) -> WordEncoder:
    """One encoder per worker; it lives on with the worker and keeps its memo."""
    if (path, end_id) not in _ENCODERS:
        _ENCODERS[path, end_id] = WordEncoder(path, end_id)
    return _ENCODERS[path, end_id]


def encode_in_order(documents: DataFrame, tokenizer_path: str, end_id: int, key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """(key, part, start_in_part, n_tokens, ids), range-partitioned and sorted by key."""
    kind = dict(documents.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, part, start = encoder(tokenizer_path, end_id), TaskContext.get().partitionId(), 0
        for batch in batches:
            for first, last, ids, bounds in work.batches(batch.column(1)):
                counts = np.diff(bounds)
                before = start + np.cumsum(counts) - counts
                start += int(counts.sum())
                yield pa.record_batch(
                    [batch.column(0).slice(first, last - first), pa.array(np.full(last - first, part, np.int32)),
                     pa.array(before), pa.array(counts),
                     pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids))],
                    names=[key, "part", "start_in_part", "n_tokens", "ids"])

    ordered = documents.select(key, text).repartitionByRange(key).sortWithinPartitions(key, text)
    return ordered.mapInArrow(run, f"{key} {kind}, part int, start_in_part long, n_tokens long, ids array<int>")


def write_token_files(tokens: DataFrame, path: str) -> None:
    (tokens.write.mode("errorifexists").option("compression", "zstd")
     .option("parquet.writer.version", "v2")
     .option("parquet.enable.dictionary", "false")
     .option("parquet.enable.dictionary#ids.list.element", "true")
     .option("parquet.dictionary.page.size", str(1 << 20))
     .option("parquet.block.size", str(ROW_GROUP_BYTES))
     .option("parquet.page.size", str(PAGE_BYTES))
     .parquet(path))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(key, start, n_tokens, ids): `start` counts the ids of all rows before. Columns not used are not read."""
    rows = spark.read.parquet(path)
    # One row per file part; the sums run over the parts, the rows keep their order inside them.
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(Window.orderBy("part")) - F.col("n")
    # There are at most spark.sql.shuffle.partitions parts, so their sums may be broadcast.
    placed = rows.join(F.broadcast(parts.select("part", before.alias("before"))), "part")
    return placed.withColumn("start", F.col("before") + F.col("start_in_part")).drop("part", "before", "start_in_part")


def ids_checksum(rows: DataFrame) -> DataFrame:
    """Replaces `ids` by ids_crc32, the checksum of the ids as little-endian unsigned 32-bit integers."""
    others = [c for c in rows.columns if c != "ids"]
    schema = ", ".join(f"{c} {t}" for c, t in rows.dtypes if c != "ids") + ", ids_crc32 long"

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        column = batch.column(batch.schema.get_field_index("ids"))
        flat, ends = np.array(column.values, dtype="<u4"), np.array(column.offsets)
        sums = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        yield {c: batch.column(c) for c in others} | {"ids_crc32": pa.array(sums, pa.int64())}

    return ar.map_arrow(rows.select(*others, "ids"), work, schema)
