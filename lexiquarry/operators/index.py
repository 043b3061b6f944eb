"""Term indexes as tables: postings, term, document and field statistics.

`LiveIndex` looks terms up in a table of words; `stored.StoredIndex` has the same `lookup` on files.
Filter columns (`attributes`) travel with the postings, so date filters need no join.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiquarry.functions.porter import stem_terms
from lexiquarry.operators.fuzzy import fuzzy_expand
from lexiquarry.session import settle

# Bits of the filter that stands for the terms of a batch, whatever its size.
FILTER_BITS = 1 << 17


@dataclass(frozen=True)
class Lookup:
    """What scoring needs. `occurrences` is the postings with one row per position."""

    postings: DataFrame
    term_stats: DataFrame
    field_stats: DataFrame
    occurrences: DataFrame | None = None


def doc_stats(words: DataFrame) -> DataFrame:
    """(field, doc_id, dl) of documents that have at least one word in the field."""
    return (words.select("field", "doc_id", F.size("words").cast("long").alias("dl"))
            .where(F.col("dl") > 0))


def field_stats(lengths: DataFrame) -> DataFrame:
    """(field, n_docs, avgdl) from document lengths."""
    return lengths.groupBy("field").agg(
        F.count("*").alias("n_docs"),
        (F.sum("dl").cast("double") / F.count("*")).alias("avgdl"))


def build_postings(words: DataFrame, attributes: Iterable[str] = (), positions: bool = False) -> DataFrame:
    """(field, term, doc_id, tf, dl, *attributes[, positions]) over the whole vocabulary.

    The rows of a document start in one task, so map-side aggregation is complete before the shuffle
    and the key (doc_id, field, term) spreads frequent terms.
    """
    attributes = list(attributes)
    sized = words.withColumn("dl", F.size("words").cast("long"))
    # Outer form plus null filter: else an added size filter would cut the text into words once more.
    rows = (sized.select("field", "doc_id", "dl", *attributes, F.posexplode_outer("words").alias("pos", "term"))
            .where(F.col("term").isNotNull()))
    measures = [F.count("*").alias("tf")]
    if positions:
        measures.append(F.array_sort(F.collect_list("pos")).alias("positions"))
    keys = ["doc_id", "field", "term", "dl", *attributes]
    columns = ["field", "term", "doc_id", "tf", "dl", *attributes] + (["positions"] if positions else [])
    return rows.groupBy(*keys).agg(*measures).select(*columns)


def term_stats(postings: DataFrame) -> DataFrame:
    """(field, term, df): each posting is one document, so a count is enough."""
    return postings.groupBy("field", "term").agg(F.count("*").alias("df"))


def vocabulary(words: DataFrame) -> DataFrame:
    """(field, term, df) straight from words; the counts combine before the shuffle."""
    return (words.select("field", F.explode(F.array_distinct("words")).alias("term"))
            .groupBy("field", "term").agg(F.count("*").alias("df")))


def stem_index_words(words: DataFrame) -> DataFrame:
    """The same table with every word stemmed, for queries that use the "english" analyser.

    Each distinct word is stemmed once; only words that change are looked up in the text.
    """
    terms = words.select(F.explode(F.array_distinct("words")).alias("term")).distinct()
    stems = settle(terms.select("term", stem_terms("term").alias("stem"))
                   .where(F.col("stem") != F.col("term")), "stems")
    others = [c for c in words.columns if c not in ("doc_id", "field", "words")]
    rows = (words.repartition("doc_id", "field")
            .select("doc_id", "field", *others, F.posexplode_outer("words").alias("pos", "term"))
            .join(stems, "term", "left"))
    stemmed = F.sort_array(F.collect_list(F.when(F.col("term").isNotNull(), F.struct(
        "pos", F.coalesce("stem", "term").alias("w")))))
    return (rows.groupBy("doc_id", "field", *others)
            .agg(F.transform(stemmed, lambda r: r["w"]).alias("words"))
            .select(*words.columns))


def _may_be_listed(word: Column, terms: Iterable[str]) -> Column:
    """True for the given terms and for few other words: a bit for each hash, in a table of fixed size."""
    table = [0] * (FILTER_BITS // 32)
    for term in terms:
        place = zlib.crc32(term.encode()) % FILTER_BITS
        table[place // 32] |= 1 << place % 32
    bits = F.expr(f"array({', '.join(f'{v}L' for v in table)})")
    place = F.crc32(word.cast("binary")) % FILTER_BITS
    return F.get(bits, F.floor(place / 32).cast("int")).bitwiseAND(
        F.call_function("shiftleft", F.lit(1).cast("long"), (place % 32).cast("int"))) != 0


@dataclass(frozen=True)
class LiveIndex:
    """An index over `words` (doc_id, field, words, *attributes), scanned at lookup."""

    words: DataFrame
    attributes: tuple[str, ...] = field(default=())

    def vocabulary(self) -> DataFrame:
        return vocabulary(self.words)

    def fuzzy(self, terms: DataFrame) -> DataFrame:
        return fuzzy_expand(self.vocabulary(), terms)

    def lookup(self, clauses: DataFrame, terms: Iterable[str], positions: bool = False) -> Lookup:
        """Postings and statistics that hold those of the terms of a clause table, and of few other words.

        The text is read once, with one plan for batches of any size: possible hits of each document are found inside the
        row and written, with the document lengths, as a stage table that all statistics and scores read.
        """
        listed = sorted(set(terms))
        if positions:
            placed = F.transform(
                F.col("words"), lambda w, i: F.struct(w.alias("term"), i.cast("long").alias("pos")))
            hits = F.filter(placed, lambda h: _may_be_listed(h["term"], listed))
        else:
            found = F.filter(F.col("words"), lambda w: _may_be_listed(w, listed))
            hits = F.transform(F.array(found), lambda m: F.transform(
                F.array_distinct(m),
                lambda t: F.struct(t.alias("term"),
                                   (F.size(m) - F.size(F.array_remove(m, t))).cast("long").alias("tf"))))[0]
        # Filtered as it is read: before, the filter would be moved below what makes the words, and they be made twice.
        hit_table = settle(
            self.words.select("doc_id", "field", *self.attributes,
                              F.size("words").cast("long").alias("dl"), hits.alias("hits")), "hits").where(F.col("dl") > 0)
        rows = hit_table.select("field", "doc_id", "dl", *self.attributes, F.inline("hits"))
        occurrences = None
        if positions:
            occurrences = rows
            rows = (rows.groupBy("doc_id", "field", "term", "dl", *self.attributes)
                    .agg(F.count("*").alias("tf")))
        return Lookup(rows, term_stats(rows), field_stats(hit_table.select("field", "dl")), occurrences)
