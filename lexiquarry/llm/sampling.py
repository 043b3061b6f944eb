"""Bounded training samples: chosen by a hash of the key, so they are the same in every run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def held_out(key: Column) -> Column:
    """True for the third of the keys that no model may learn from."""
    return F.coalesce(F.crc32(key.cast("string")) % 3 == 1, F.lit(False))


def sample_labels(labels: DataFrame, key: str, max_rows: int, by: str | None = None,
                  per_value: int | None = None) -> DataFrame:
    """At most `max_rows` rows of a label table, optionally at most `per_value` for each value of `by`.

    Both limits act inside the tasks before any shuffle.
    """
    order = F.xxhash64(F.col(key))
    if by:
        place = F.row_number().over(Window.partitionBy(by).orderBy(order, key))
        labels = labels.withColumn("__place", place).where(F.col("__place") <= per_value).drop("__place")
    return labels.orderBy(order, key).limit(max_rows)


def with_texts(sample: DataFrame, documents: DataFrame, key: str, text: str) -> DataFrame:
    """Texts of the sampled keys; the sample is bounded, so it is broadcast and no text is shuffled."""
    return documents.select(key, text).join(F.broadcast(sample), key)
