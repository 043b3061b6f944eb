"""Text normalisation over tables in field form: one row per (doc_id, field)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiquarry.functions import text as tx

DOCUMENT = ["doc_id", "field"]
SENTENCE = [*DOCUMENT, "sent_no"]
PROCESSED = {"pr_title": "title", "pr_abstract": "abstract"}


def to_fields(articles: DataFrame, fields: dict[str, str], key: str = "doc_id",
              attributes: Sequence[str] = ()) -> DataFrame:
    """(doc_id, field, text, *attributes): one row per document and field.

    `fields` maps field name to source column.
    """
    pairs = [F.struct(F.lit(name).alias("field"), F.col(column).alias("text"))
             for name, column in fields.items()]
    return (articles.select(F.col(key).alias("doc_id"), *attributes, F.explode(F.array(*pairs)).alias("f"))
            .select("doc_id", "f.field", "f.text", *attributes))


def index_words(fields: DataFrame, standard: bool = False) -> DataFrame:
    """Replace `text` by `words`: normalised words, or those of the standard analyser for raw text."""
    cut = tx.analyze_standard if standard else tx.normalized_words
    return fields.withColumn("words", cut(F.col("text"))).drop("text")


def normalize_fields(articles: DataFrame, fields: dict[str, str] | None = None) -> DataFrame:
    """(doc_id, field, sentences): normalised sentences, words joined by single spaces."""
    return (to_fields(articles, fields or PROCESSED)
            .select("doc_id", "field", tx.normalize_sentences(F.col("text")).alias("sentences")))


def words_of_sentences(sentences: DataFrame) -> DataFrame:
    """(doc_id, field, words) of a table in sentence form."""
    return sentences.select("doc_id", "field", tx.flat_words(F.col("sentences")).alias("words"))


def remove_stop_words(sentences: DataFrame, stop_words: list[str] | None = None) -> DataFrame:
    """Drop stop words and words of up to two letters; sentence positions stay."""
    return sentences.withColumn("sentences", tx.drop_stop_words(F.col("sentences"), stop_words))


def explode_sentences(sentences: DataFrame, column: str = "sentences") -> DataFrame:
    """(doc_id, field, sent_no, sentence), sent_no from 0.

    The outer form plus a null filter: for the plain form the optimizer adds a size filter below the
    projection that makes the array, and the whole text would be normalised twice.
    """
    return (sentences.select("doc_id", "field", F.posexplode_outer(column).alias("sent_no", "sentence"))
            .where(F.col("sentence").isNotNull())
            .withColumn("sent_no", F.col("sent_no").cast("long")))


def explode_words(sentences: DataFrame) -> DataFrame:
    """(doc_id, field, sent_no, pos, word), positions from 0 within the sentence."""
    return (explode_sentences(sentences)
            .select("doc_id", "field", "sent_no",
                    F.posexplode(tx.words_of(F.col("sentence"))).alias("pos", "word"))
            .withColumn("pos", F.col("pos").cast("long")))


def normalize_table(articles: DataFrame) -> DataFrame:
    """Rewrite `pr_title` and `pr_abstract` of an article table as arrays of sentence records."""
    return articles.withColumns({
        new: tx.sentence_records(tx.normalize_sentences(F.col(raw))) for new, raw in PROCESSED.items()})
