"""Retrieval pipelines: articles in, a table of index words out, and searches over two of them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiquarry.operators import index as ix
from lexiquarry.operators import keywords as kw
from lexiquarry.operators import lemmatize as lm
from lexiquarry.operators import matching as ma
from lexiquarry.operators import normalize as nz
from lexiquarry.operators import search as se
from lexiquarry.operators import textrank as tr
from lexiquarry.operators import tfidf as ti
from lexiquarry.session import drop_settled, settle, settle_parts

SYSTEMS = ("System_1", "System_2")
INDEX_ATTRIBUTES = ("publish_time",)


def keyword_dictionary(sentences: DataFrame) -> DataFrame:
    """Settled (source, phrase, clean, n_words, score) of both selection methods."""
    # One after the other: what is shuffled for the first goes before the second begins.
    return settle_parts([
        lambda: kw.frequent_dictionary(sentences).withColumn("source", F.lit("frequent")),
        lambda: tr.textrank_dictionary(tr.rank_phrases(sentences)).withColumn("source", F.lit("textrank"))], "dictionary")


def match_both(sentences: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Matches of both sources per document, in sentence order."""
    return ma.matched_sentences(sentences, dictionary)


def merged_keywords(plain: DataFrame) -> DataFrame:
    """Settled sentence form of the dictionary keywords of settled sentences without stop words."""
    return settle_parts([lambda: ma.merge_keywords(match_both(plain, keyword_dictionary(plain)))], "merged")


def best_keywords(texts: DataFrame) -> DataFrame:
    """TF-IDF selection; `texts` is read twice, by the weights and by the reduction."""
    return ti.reduce_to_terms(texts, ti.best_terms(ti.tfidf(texts)))


def select_keywords(sentences: DataFrame) -> DataFrame:
    """Sentence form after stop words, dictionary keywords and TF-IDF selection."""
    # Counts, graphs and matching read these sentences; normalising for each of them would cost more.
    plain = settle(nz.remove_stop_words(sentences), "plain")
    texts = merged_keywords(plain)
    drop_settled(plain)
    return best_keywords(texts)


def lemmatize(sentences: DataFrame, lexicon: DataFrame) -> DataFrame:
    words = ix.vocabulary(nz.words_of_sentences(sentences)).select(F.col("term").alias("word"))
    return lm.lemmatize_sentences(sentences, settle(lm.lemmas(words, lexicon), "lemmas"))


def system1_words(articles: DataFrame, lexicon: DataFrame | None = None) -> DataFrame:
    """Full pipeline: normalise, select keywords, lemmatise. (doc_id, field, words, publish_time)."""
    normal = settle(nz.normalize_fields(articles), "normal")
    if lexicon is None:
        lexicon = settle(lm.corpus_lexicon(ix.vocabulary(nz.words_of_sentences(normal))), "lexicon")
    # Each table goes when the next ones are written, as all of them together would take many times the disk of the texts.
    plain = settle(nz.remove_stop_words(normal), "plain")
    drop_settled(normal)
    texts = merged_keywords(plain)
    drop_settled(plain)
    selected = settle_parts([lambda: best_keywords(texts)], "selected")
    drop_settled(texts)
    words = nz.words_of_sentences(lemmatize(selected, lexicon))
    return words.join(articles.select("doc_id", *INDEX_ATTRIBUTES), "doc_id")


def system2_words(articles: DataFrame) -> DataFrame:
    """Normalise only."""
    return nz.index_words(nz.to_fields(articles, nz.PROCESSED, attributes=INDEX_ATTRIBUTES))


def raw_field_words(articles: DataFrame) -> DataFrame:
    """Unprocessed title and abstract under the standard analyser."""
    fields = {"title": "title", "abstract": "abstract"}
    return nz.index_words(nz.to_fields(articles, fields, attributes=INDEX_ATTRIBUTES), standard=True)


def live(words: DataFrame) -> ix.LiveIndex:
    return ix.LiveIndex(words, INDEX_ATTRIBUTES)


def for_system(query: se.MatchQuery, system: str) -> se.MatchQuery:
    """The query against the fields of one system in a shared index."""
    return replace(query, query_id=f"{query.query_id}@{system}",
                   fields={f"{system}.{name}": boost for name, boost in query.fields.items()})


def shared_words(articles: DataFrame) -> DataFrame:
    """Words of both systems, fields named <system>.<field>."""
    parts = [(SYSTEMS[0], system1_words(articles)), (SYSTEMS[1], system2_words(articles))]
    named = [w.withColumn("field", F.concat(F.lit(f"{s}."), "field")) for s, w in parts]
    columns = ["doc_id", "field", "words", *INDEX_ATTRIBUTES]
    return named[0].select(*columns).unionByName(named[1].select(*columns))


def batch_search(articles: DataFrame, queries: Sequence[se.MatchQuery], spark: SparkSession) -> DataFrame:
    """(query_id, system, rank, doc_id, score): all queries on both systems, scored in one job."""
    batch = [for_system(q, s) for q in queries for s in SYSTEMS]
    # Statistics, fuzzy terms, postings and lengths each read the words; unsettled, both systems would be made for each of them.
    hits = se.search(live(settle_parts([lambda: shared_words(articles)], "words")), batch, spark)
    # System names have no "@", query ids may.
    system = F.substring_index("query_id", "@", -1)
    query_id = F.expr("substring(query_id, 1, length(query_id) - length(substring_index(query_id, '@', -1)) - 1)")
    return hits.select(query_id.alias("query_id"), system.alias("system"), "rank", "doc_id", "score")


def judge(hits: DataFrame, labels: DataFrame) -> DataFrame:
    """(query_id, system, rank, rel): a hit is relevant when its label says so, unlabelled ones are not.

    `hits` should be settled: it has at most size x queries x systems rows and is read twice.
    """
    # The planner knows the size of a settled table.
    wanted = hits.select("doc_id").distinct()
    known = labels.join(wanted, "doc_id", "left_semi").select("doc_id", "quality")
    return hits.join(known, "doc_id", "left").select(
        "query_id", "system", "rank", F.coalesce(F.col("quality").cast("long"), F.lit(0)).alias("rel"))
