"""Corpus keywords: word and n-gram counts, PMI collocations, phrase dictionaries.

Input is a table in sentence form (doc_id, field, sentences). N-grams run inside one (doc_id, field),
so they are cut within the row and counted by blocks of documents; only these counts are shuffled.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lexiquarry.functions.text import flat_words
from lexiquarry.operators.normalize import explode_words
from lexiquarry.operators.word_blocks import Words, blocks_of, give_back_memory

# How many words and how frequent n-grams are selected.
TOP_WORDS = 1000
BIGRAM_MIN = 7
TRIGRAM_MIN = 5

# Words of the documents whose n-grams are counted at once.
GRAM_WORDS = 1 << 20

_STEP = np.uint64(0x9E3779B97F4A7C15)


def corpus_words(sentences: DataFrame) -> DataFrame:
    """(doc_id, field, sent_no, pos, word) of the whole corpus."""
    return explode_words(sentences)


def corpus_size(sentences: DataFrame) -> DataFrame:
    """One row (n_words, n_distinct)."""
    return word_counts(sentences).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_words"), F.count("*").alias("n_distinct"))


def word_counts(sentences: DataFrame) -> DataFrame:
    return (sentences.select(F.explode(flat_words(F.col("sentences"))).alias("word"))
            .groupBy("word").agg(F.count("*").alias("n")))


def top_unigrams(counts: DataFrame, k: int = TOP_WORDS) -> DataFrame:
    """(rank, word, n) of the k most frequent words, ties alphabetically.

    The limit comes first, so the ranking window sees at most k rows.
    """
    best = counts.orderBy(F.col("n").desc(), "word").limit(k)
    order = W.orderBy(F.col("n").desc(), "word")
    return best.select(F.row_number().over(order).cast("long").alias("rank"), "word", "n")


def _block_grams(sentences: DataFrame, size: int, n_parts: int) -> DataFrame:
    """(part, grams, counts): adjacent words as one text, each once for a block of documents.

    A row has all grams of a block that fall to a part by their hash, sorted and joined by two spaces, which no gram holds, so a gram
    costs little more than its letters, and what is alike lies together when the rows are compressed.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0)
            for at, last in blocks_of(texts, GRAM_WORDS):
                yield grams(Words.of(texts.slice(at, last - at)))
        give_back_memory()

    def grams(words: Words) -> pa.RecordBatch:
        order = np.array(pc.array_sort_indices(words.names), np.int64)
        names, code = words.names.take(pa.array(order)), np.argsort(order)[words.code]
        hashes = np.fromiter((zlib.crc32(w.encode()) for w in names.to_pylist()), np.uint64, len(names))
        first = np.flatnonzero(words.doc[size - 1:] == words.doc[:max(len(words.doc) - size + 1, 0)])
        key = code[first]
        for i in range(1, size):  # numbers of shorter grams instead of their codes, so keys stay below 2^63
            _, key = np.unique(key, return_inverse=True)
            key = key * max(len(names), 1) + code[first + i]
        _, where, n = np.unique(key, return_index=True, return_counts=True)
        part = np.zeros(len(where), np.uint64)
        for i in range(size):
            part = (part + hashes[code[first[where] + i]]) * _STEP
            part ^= part >> np.uint64(29)
        part = (part % np.uint64(n_parts)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        own = [names.take(pa.array(code[first[where[order]] + i])) for i in range(size)]
        found = pc.binary_join_element_wise(*own, " ")
        parts, bounds = np.unique(part[order], return_index=True)
        bounds = pa.array(np.append(bounds, len(order)).astype(np.int32))
        return pa.RecordBatch.from_arrays([
            pa.array(parts, pa.int32()), pc.binary_join(pa.ListArray.from_arrays(bounds, found), "  "),
            pa.ListArray.from_arrays(bounds, pa.array(n[order], pa.int64()))], ["part", "grams", "counts"])

    return sentences.select("sentences").mapInArrow(run, "part int, grams string, counts array<long>")


def ngram_counts(sentences: DataFrame, size: int, min_count: int = 1) -> DataFrame:
    """(w1 .. w<size>, n) of adjacent words that occur at least `min_count` times.

    The counts of blocks are dealt out by gram before they are added up, so no task keeps the grams of all its documents, and a
    frequent gram comes once a block.
    """
    names = [f"w{i + 1}" for i in range(size)]
    n_tasks = int(sentences.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = _block_grams(sentences, size, n_tasks).repartitionById(n_tasks, F.col("part"))
    both = F.arrays_zip(F.split("grams", "  ").alias("gram"), F.col("counts").alias("n"))
    # A gram has one part, by which it was dealt, so nothing is shuffled again.
    counts = blocks.select("part", F.inline(both).alias("gram", "n")).groupBy("part", "gram").agg(F.sum("n").alias("n"))
    part = F.split("gram", " ")
    counts = counts.select(*[part[i].alias(name) for i, name in enumerate(names)], "n")
    return counts.where(F.col("n") >= min_count) if min_count > 1 else counts


def pmi(grams: DataFrame, words: DataFrame) -> DataFrame:
    """(gram, w1 .., n, pmi): log2 of how much more often the words meet than by chance.

    For k words: log2(n * N^(k-1)) - log2(n1 * .. * nk), N = number of words in the corpus. The word
    counts are one shuffled table that all joins share.
    """
    names = [c for c in grams.columns if c != "n"]
    total = words.agg(F.sum("n").cast("double")).scalar()
    joined = grams
    expected: Column | None = None
    for name in names:
        own = words.select(F.col("word").alias(name), F.col("n").cast("double").alias(f"n_{name}"))
        joined = joined.join(own, name)
        expected = F.col(f"n_{name}") if expected is None else expected * F.col(f"n_{name}")
    chance = F.log2(F.col("n") * F.pow(total, F.lit(float(len(names) - 1)))) - F.log2(expected)
    return joined.select(F.concat_ws(" ", *names).alias("gram"), *names, "n", chance.alias("pmi"))


def bigram_pmi(sentences: DataFrame, min_count: int = BIGRAM_MIN) -> DataFrame:
    return pmi(ngram_counts(sentences, 2, min_count), word_counts(sentences))


def trigram_pmi(sentences: DataFrame, min_count: int = TRIGRAM_MIN) -> DataFrame:
    return pmi(ngram_counts(sentences, 3, min_count), word_counts(sentences))


def phrase_rows(phrases: DataFrame, phrase: str, score: str) -> DataFrame:
    """Dictionary form (phrase, clean, n_words, score)."""
    return phrases.select(
        F.col(phrase).alias("phrase"),
        F.replace(F.col(phrase), F.lit(" "), F.lit("_")).alias("clean"),
        F.size(F.split(phrase, " ")).cast("long").alias("n_words"),
        F.col(score).cast("double").alias("score"))


def frequent_dictionary(sentences: DataFrame, k: int = TOP_WORDS, bigram_min: int = BIGRAM_MIN,
                        include_trigrams: bool = False, trigram_min: int = TRIGRAM_MIN) -> DataFrame:
    """Top words (score: frequency) and frequent bigrams (score: PMI); trigrams only on request.

    The parts have different word numbers, so no phrase comes twice.
    """
    words = phrase_rows(top_unigrams(word_counts(sentences), k), "word", "n")
    parts = words.unionByName(phrase_rows(bigram_pmi(sentences, bigram_min), "gram", "pmi"))
    if include_trigrams:
        parts = parts.unionByName(phrase_rows(trigram_pmi(sentences, trigram_min), "gram", "pmi"))
    return parts
