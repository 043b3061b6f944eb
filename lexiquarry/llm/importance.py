"""Importance resampling: draw the documents that look most like a target collection.

1. Features are runs of words, hashed into buckets. One pass counts the buckets of all documents, one those of the
   target; the log of the ratio of both shares, in whole thousandths, is the gain of a bucket.
2. A second pass scores each document by looking its buckets up in the array of gains and adding them.
   A Gumbel value made from the id's hash is added, so the best scores are a draw without replacement
   in proportion to the weights.
3. Which score is the last to be drawn is found by quickselect on the written scores. In each round some random
   keys are pivots; one pass counts the rows below, at and between them, and only the part that holds the
   k-th key goes on. Keys are (score, id, number of features, row), so no two are equal.
4. Only the drawn rows are sorted: by ranges, and each row's rank is its place in its range plus the sizes of the
   ranges before.

What grows with the data stays in tables; the driver gets one number for each bucket and pivot.

Defined results: a null or empty text has no features and weight 0. Rows of one id count as documents of their
own and tie in the order of weight, then number of features. A row with a null id is counted and weighed, but has no score
and is never drawn. An empty target gives the gains of its smoothed counts; an empty table, an empty
result. Other columns are ignored.
"""

from __future__ import annotations

import math
import random
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from lexiquarry.llm import arrays as ar
from lexiquarry.llm.runs import word_blocks
from lexiquarry.llm.storage import settle

# Words are runs of ASCII letters, digits and all characters beyond ASCII.
SEPARATORS = np.zeros(256, bool)
SEPARATORS[:128] = True
SEPARATORS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = False

PIVOTS = 15


@dataclass(frozen=True)
class Features:
    """Runs of `least` to `most` consecutive words, hashed into `buckets`."""

    least: int = 1
    most: int = 1
    buckets: int = 10_000

    def of(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
        """(first row, row after the last, row of each feature, its bucket, words of each row) by block."""
        for block in word_blocks(column, SEPARATORS, self.most - 1):
            found = [block.runs(n) for n in range(self.least, self.most + 1)]
            rows, starts, ends = (np.concatenate(p) for p in zip(*found, strict=True))
            buckets = (block.hashes(zlib.crc32, starts, ends) % np.uint64(self.buckets)).astype(np.int64)
            words = np.bincount(block.rows[block.old:] - block.first, minlength=block.last - block.first)
            yield block.first, block.last, rows, buckets, words


def bucket_counts(texts: DataFrame, features: Features, text: str = "text") -> np.ndarray:
    """Features in each bucket over all rows; every task adds up its own and passes on one row a bucket."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(features.buckets, np.int64)
        for batch in batches:
            for _, _, _, buckets, _ in features.of(batch.column(0)):
                total += np.bincount(buckets, minlength=features.buckets)
        held = np.flatnonzero(total)
        yield pa.record_batch([pa.array(held.astype(np.int32)), pa.array(total[held])], ["bucket", "n"])

    found = (texts.select(text).mapInArrow(count, "bucket int, n long")
             .groupBy("bucket").agg(F.sum("n").alias("n")).toArrow())
    out = np.zeros(features.buckets, np.int64)
    out[np.array(found["bucket"])] = np.array(found["n"])
    return out


def log_ratio_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log of target share over source share of each bucket, one added to each count."""
    n, all_source, all_target = len(source), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (all_source + n) / ((s + 1.0) * (all_target + n))))
                     for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def weigh(documents: DataFrame, gains: np.ndarray, features: Features, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_features, n_words, weight) of every row."""
    held = documents.sparkSession.sparkContext.broadcast(gains)  # one number a bucket

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        n = batch.num_rows
        total, count, size = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
        for first, last, rows, buckets, words in features.of(batch.column(1)):
            np.add.at(total, rows, held.value[buckets])
            count[first:last] += np.bincount(rows - first, minlength=last - first)
            size[first:last] += words
        yield {"id": batch.column(0), "n_features": count, "n_words": size, "weight": total}

    rows = documents.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    return ar.map_arrow(rows, work, "id long, n_features long, n_words long, weight long")


def gumbel(key: Column, seed: int) -> Column:
    """Thousandths of a Gumbel value from the first 32 bits of the hash of seed and key."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), key.cast("string")), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def _after(names: list[str], row: Row, or_at: bool) -> Column:
    """If the key of a row of the table stands after that of `row`, or at it."""
    mine, its = F.struct(*names), F.struct(*[F.lit(row[n]).cast("long").alias(n) for n in names])
    return (mine >= its) if or_at else (mine > its)


def kth_row(rows: DataFrame, names: list[str], k: int, pivots: int = PIVOTS) -> Row:
    """The row with the k-th smallest key, k from 1. The columns `names` are the key: longs, different for all rows.

    `rows` is a written table. A round reads it twice and leaves about one part in `pivots` of it.
    """
    draw = random.Random(k)
    while True:
        order = F.xxhash64(*names, F.lit(draw.getrandbits(32)))
        at = sorted(rows.select(*names).orderBy(order).limit(pivots).collect(), key=lambda r: [r[n] for n in names])
        part = sum(_after(names, r, or_at).cast("int") for r in at for or_at in (True, False))
        counts = dict(rows.groupBy(part.alias("part")).count().collect())
        below = 0
        for p in range(2 * len(at) + 1):  # even parts lie between pivots, odd ones are a pivot
            if below + counts.get(p, 0) >= k:
                break
            below += counts.get(p, 0)
        if p % 2:
            return at[p // 2]
        rows, k = settle(rows.where(part == p).select(*names), "narrowed"), k - below


def ranked(rows: DataFrame, names: list[str]) -> DataFrame:
    """The rows with `rank`, from 1, by the key `names`, without bringing them together."""
    placed = settle(
        rows.repartitionByRange(*names).sortWithinPartitions(*names).withColumns({
            "__part": F.spark_partition_id(),
            "__place": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}), "sorted")
    # One row for each range.
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("__part").agg(F.count("*").alias("n"))
    offsets = sizes.select("__part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__offset"))
    return placed.join(F.broadcast(offsets), "__part").withColumn(
        "rank", F.col("__offset") + F.col("__place") + 1).drop("__part", "__place", "__offset")


def resample(documents: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text",
             features: Features = Features(), min_words: int = 20, percent: int = 10, seed: int = 2024) -> DataFrame:
    """(key, n_features, weight, score, rank) of every row; rank is null where a row is not drawn.

    Of the rows with at least `min_words` words, `percent` in a hundred are drawn, rounded down.
    """
    gains = log_ratio_gains(bucket_counts(documents, features, text), bucket_counts(target, features, text))
    weighed = weigh(documents, gains, features, key, text)
    score = F.col("weight") + gumbel(F.col("id"), seed)
    scored = settle(weighed.withColumns({"score": score, "__down": -score, "__row": F.monotonically_increasing_id()}), "scores")
    names = ["__down", "id", "n_features", "__row"]
    eligible = scored.where((F.col("n_words") >= min_words) & F.col("id").isNotNull())
    n_drawn = eligible.count() * percent // 100
    columns = [F.col("id").alias(key), "n_features", "weight", "score"]
    if not n_drawn:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    last = kth_row(eligible, names, n_drawn)
    drawn = (F.col("n_words") >= min_words) & F.col("id").isNotNull() & ~_after(names, last, False)
    won = ranked(scored.where(drawn).select(*names, "weight", "score"), names)
    return won.select(*columns, "rank").unionByName(
        scored.where(~F.coalesce(drawn, F.lit(False))).select(*columns, F.lit(None).cast("long").alias("rank")))
