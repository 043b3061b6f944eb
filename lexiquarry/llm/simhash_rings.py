"""SimHash near-duplicates: fingerprints of word shingles, linked at a small Hamming distance by pigeonring filtering.

1. Every shingle votes, repeats included: a bit of the fingerprint is set if it is set in over half of their
   hashes. Rows of equal fingerprints are one class.
2. The 64 bits are cut into radius + 1 segments that form a ring. If two fingerprints differ in `radius` bits at most,
   then from some segment on, any chain of l consecutive segments has at most l - 1 differences (its share of
   the budget, l * radius / (radius + 1), rounded down). So the first segment of the chain is equal,
   and the first two differ in one bit at most.
3. The join makes only pairs that pass this for the first two segments: a fingerprint stands under its two
   segments for every start, and meets those under the same two, and under its own two with one set bit of the
   second cleared. Whichever of a pair has the bit finds the other one. For a radius of 2, a pair meets on 42 or 43
   bits, so chance meetings stay rare among many fingerprints.
4. The chains' longer prefixes are checked, then the full distance.
5. Links of fingerprints give components; a class gets the smallest id of its component.

Defined results: a null, empty or wordless text has fingerprint zero and links like any other; with fewer words than
`size` all of them are one shingle. Rows are documents of their own, also those that share an id. A row with a null id gets its
fingerprint, and the component of equal or linked rows that have an id, but makes no links itself. An empty
table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiquarry.llm import arrays as ar
from lexiquarry.llm.components import components
from lexiquarry.llm.runs import word_blocks
from lexiquarry.llm.storage import settle

SIZE = 3
SEED = 42
RADIUS = 2
BITS = 64


def fingerprints(column: pa.Array, size: int = SIZE, seed: int = SEED) -> np.ndarray:
    """SimHash of every row of a text column, as unsigned 64-bit integers."""
    votes = np.zeros((len(column), BITS), np.int64)
    voters = np.zeros(len(column), np.int64)

    def hash_of(run: bytes) -> int:
        return xxhash.xxh64_intdigest(run, seed)

    for block in word_blocks(column, ar.SPACE_TABLE, size - 1):
        rows, starts, ends = block.runs(size, shorter=True)
        if not len(rows):
            continue
        hashes = block.hashes(hash_of, starts, ends).astype("<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        head = np.flatnonzero(np.diff(rows, prepend=-1))
        votes[rows[head]] += np.add.reduceat(bits, head, axis=0, dtype=np.int64)
        voters[rows[head]] += np.diff(head, append=len(rows))
    packed = np.packbits(2 * votes > voters[:, None], axis=1, bitorder="little")
    return np.ascontiguousarray(packed).view("<u8").ravel()


def _signed(value: int) -> Column:
    return F.lit(value - (1 << 64) if value >> 63 else value).cast("long")


def segments(radius: int) -> list[int]:
    """Masks of the ring's segments."""
    bounds = [round(i * BITS / (radius + 1)) for i in range(radius + 2)]
    return [(1 << b) - (1 << a) for a, b in zip(bounds, bounds[1:], strict=False)]


def close_pairs(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): all pairs of different fingerprints of the column `f` (each once) at most `radius` bits apart, once each."""
    if not 0 <= radius < BITS // 2:
        raise ValueError("radius must be at least 0 and below 32")
    if radius == 0:
        return prints.select(F.col("f").alias("a"), F.col("f").alias("b")).limit(0)
    ring = segments(radius)
    f = F.col("f")
    stored, asked = [], []
    for start, first in enumerate(ring):
        second = ring[(start + 1) % len(ring)]
        own = f.bitwiseAND(_signed(first | second))
        stored.append(F.struct(F.lit(start).alias("start"), own.alias("chain")))
        bits = F.array(*[_signed(1 << i) for i in range(BITS) if second >> i & 1])
        cleared = F.transform(F.filter(bits, lambda bit: f.bitwiseAND(bit) != 0), lambda bit: own.bitwiseXOR(bit))
        asked.append(F.transform(F.concat(F.array(own), cleared), lambda c, i: F.struct(
            F.lit(start).alias("start"), c.alias("chain"), (i == 0).alias("same"))))  # noqa: B023
    b = prints.select(f.alias("b"), F.inline(F.array(*stored)))
    a = prints.select(f.alias("a"), F.inline(F.concat(*asked)))
    apart = F.col("a").bitwiseXOR(F.col("b"))
    met = a.join(b, ["start", "chain"]).where(
        # Where the chains are equal, both would find each other.
        (F.col("a") < F.col("b")) | ~F.col("same")).where(_chains_hold(apart, ring)).where(F.bit_count(apart) <= radius)
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _chains_hold(apart: Column, ring: list[int]) -> Column:
    """The chain from `start` stays within its share of the budget: l - 1 differences in l segments, three and more.

    The whole ring is the full distance and left to it.
    """
    holds = F.lit(True)
    for start in range(len(ring)):
        mask, within = ring[start] | ring[(start + 1) % len(ring)], F.lit(True)
        for length in range(3, len(ring)):
            mask |= ring[(start + length - 1) % len(ring)]
            within &= F.bit_count(apart.bitwiseAND(_signed(mask))) <= length - 1
        if len(ring) > 3:
            holds &= (F.col("start") != start) | within
    return holds


def near_duplicates(documents: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE,
                    radius: int = RADIUS) -> DataFrame:
    """(key, fingerprint, component_id) of every row."""
    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            yield {"id": part.column(0), "f": ar.signed(fingerprints(part.column(1), size))}

    docs = documents.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    rows = settle(ar.map_arrow(docs, work, "id long, f long"), "fingerprints")
    classes = settle(rows.groupBy("f").agg(F.min("id").alias("least"), F.count("*").alias("n")).where("least is not null"), "classes")
    found = components(settle(close_pairs(classes.select("f"), radius), "near"))
    members = settle(found.join(classes, found["node"] == classes["f"]).select("f", "component", "least"), "members")
    smallest = members.groupBy("component").agg(F.min("least").alias("component_id"))
    linked = members.join(smallest, "component").select("f", "component_id")
    # A class of one row without links needs no lookup: its id is the answer.
    named = settle(classes.join(linked, "f", "left").where("n > 1 or component_id is not null")
                   .select("f", F.coalesce("component_id", "least").alias("component_id")), "components")
    return rows.join(named, "f", "left").select(
        F.col("id").alias(key), F.lower(F.lpad(F.hex("f"), 16, "0")).alias("fingerprint"),
        F.coalesce("component_id", "id").alias("component_id"))
