"""Sentence ends that know abbreviations, learnt from the corpus itself.

An abbreviation is a short word that nearly always has a stop behind it. How much better "nearly always" explains the counts of a
word than the share of stops among all words is a log-likelihood ratio (after Kiss and Strunk, 2006), weighed by length, inner stops and
occurrences without a stop. All of it comes from one count of words; the abbreviations are a table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiquarry.functions import text as tx
from lexiquarry.operators.normalize import DOCUMENT
from lexiquarry.session import settle

# Share of stops behind an abbreviation, and the least score of one.
ABBREVIATION_SHARE = 0.99
LEAST_SCORE = 0.3
WORD = r"^[a-z]+(\.[a-z]+)*$"
SCORE_DIGITS = 9


def _without_stop(token: Column) -> Column:
    return F.regexp_replace(token, r"\.$", "")


def stop_counts(fields: DataFrame) -> DataFrame:
    """(word, n_stop, n_plain): how often a word stands with a stop right behind it, and without, from (…, text)."""
    tokens = F.split(F.trim(F.regexp_replace(tx.folded(F.col("text")), r"\s+", " ")), " ")
    rows = fields.select(F.explode_outer(tokens).alias("token"))
    counted = rows.select(_without_stop(F.col("token")).alias("word"), F.endswith("token", F.lit(".")).alias("stop"))
    return counted.where(F.col("word").rlike(WORD)).groupBy("word").agg(
        F.count_if("stop").alias("n_stop"), F.count_if(~F.col("stop")).alias("n_plain"))


def score_abbreviations(counts: DataFrame) -> DataFrame:
    """(word, n_stop, n_plain, score) of words that have a stop at least once."""
    totals = counts.agg(F.sum("n_stop").alias("all_stop"), F.sum(F.col("n_stop") + F.col("n_plain")).alias("all_words"))
    rows = counts.where("n_stop > 0").crossJoin(F.broadcast(totals))  # one row
    share = F.col("all_stop") / F.col("all_words")
    as_any = F.col("n_stop") * F.log(share) + F.when(F.col("n_plain") > 0, F.col("n_plain") * F.log(1 - share)).otherwise(0.0)
    as_short = F.col("n_stop") * F.log(F.lit(ABBREVIATION_SHARE)) + F.col("n_plain") * F.log(F.lit(1 - ABBREVIATION_SHARE))
    letters = F.length(F.replace("word", F.lit("."), F.lit("")))
    stops = F.length("word") - letters + 1
    penalty = F.exp(-F.col("n_plain") * F.log(letters.cast("double")))
    score = -2.0 * (as_any - as_short) * F.exp(-letters.cast("double")) * stops * penalty
    return rows.select("word", "n_stop", "n_plain", F.round(score, SCORE_DIGITS).alias("score"))


def abbreviations(scored: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    return scored.where(F.col("score") >= least).select("word")


def split_sentences(fields: DataFrame, known: DataFrame) -> DataFrame:
    """(doc_id, field, sentences): folded sentences; the stop of a known abbreviation (table of `word`) ends none.

    Each document's last words of sentences are looked up, and only those found come back to it, so texts are not cut into rows. Null
    stays null, and an abbreviation at the end of a text ends its last sentence.
    """
    rows = fields.select(*DOCUMENT, tx.split_sentences(F.col("text")).alias("sentences"))

    def last_word(sentence: Column) -> Column:
        return F.when(F.endswith(sentence, F.lit(".")), _without_stop(F.regexp_extract(sentence, r"(\S+)$", 1)))

    asked = rows.select(*DOCUMENT, F.explode_outer(F.array_distinct(F.transform("sentences", last_word))).alias("word"))
    found = (asked.where(F.col("word").isNotNull()).join(settle(known, "abbreviations"), "word")
             .groupBy(*DOCUMENT).agg(F.collect_set("word").alias("short")))
    joined = rows.join(found, DOCUMENT, "left")

    def with_end(sentence: Column) -> Column:
        return F.concat(sentence, F.when(F.array_contains("short", last_word(sentence)), " ").otherwise(tx.SENTENCE_MARK))

    text = F.array_join(F.transform("sentences", with_end), "")
    merged = F.transform(F.array_remove(F.split(text, tx.SENTENCE_MARK), ""), lambda s: F.rtrim(s))
    return joined.select(*DOCUMENT, F.when(F.col("short").isNull(), F.col("sentences")).otherwise(merged).alias("sentences"))
