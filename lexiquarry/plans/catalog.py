"""The registered queries: every operator applied to the driver tables, next to its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiquarry.functions import text as tx
from lexiquarry.operators import evaluate as ev
from lexiquarry.operators import fuzzy as fz
from lexiquarry.operators import index as ix
from lexiquarry.operators import keywords as kw
from lexiquarry.operators import lemmatize as lm
from lexiquarry.operators import matching as ma
from lexiquarry.operators import normalize as nz
from lexiquarry.operators import search as se
from lexiquarry.operators import sentence_ends as sn
from lexiquarry.operators import stored as st
from lexiquarry.operators import textrank as tr
from lexiquarry.operators import tfidf as ti
from lexiquarry.plans import oracle as o
from lexiquarry.plans import pipelines as pl
from lexiquarry.session import settle, settle_parts, stage_path
from lexiquarry.sources import articles as ar
from lexiquarry.sources import screening as sg
from lexiquarry.sources.corpus import load_corpus

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

FIELDS = {"pr_title": 1.0, "pr_abstract": 5.0}
FIELDS_3 = {"pr_title": 1.0, "pr_abstract": 3.0}

# The three question forms of the comparison, with words of the driver's texts.
SYMPTOMS = se.MatchQuery("query1", "That erblest whou the therinn", FIELDS, fuzziness="AUTO",
                         minimum_should_match="50%")
INFLUENCE = se.MatchQuery(
    "query2", "Eranenes of thtion, ereringre, anthe stings on the erblest tiones of whoo",
    FIELDS_3, analyzer="english", fuzziness="AUTO")
MASKS = se.MatchQuery("query3", "The inating of thereion edes", FIELDS, analyzer="english",
                      minimum_should_match="50%", between=("publish_time", "2020-06-01", "2021-03-01"))
QUESTIONS = (SYMPTOMS, INFLUENCE, MASKS)
FLAGSHIP = se.MatchQuery("flagship", "that erblest whou the", FIELDS, minimum_should_match="50%")
K = 5


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query
    return keep


def _day(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd").alias(column)


def _plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentence form without stop words, the input of keyword selection."""
    return nz.remove_stop_words(nz.normalize_fields(load_corpus(spark, sf_dir)))


def _settled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as a stage table, for operators that read it several times."""
    return settle(_plain(spark, sf_dir), "plain")


def _rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


# ---------------------------------------------------------------- sources

_CORPUS_COLUMNS = "doc_id, title, abstract, title pr_title, abstract pr_abstract, lang, source, publish_raw"


@register("scan_corpus", o._chain(f"select {_CORPUS_COLUMNS} from corpus", "corpus"))
def scan_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ar.with_processed_copies(load_corpus(spark, sf_dir)).select(
        "doc_id", "title", "abstract", "pr_title", "pr_abstract", "lang", "source", "publish_raw")


@register("tail_n", o._chain("select doc_id, title from corpus order by doc_id desc limit 1000", "corpus"))
def tail_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ar.tail_rows(load_corpus(spark, sf_dir).select("doc_id", "title"), 1000, key="doc_id")


@register("head_n", o._chain("select doc_id, title from corpus order by doc_id limit 1000", "corpus"))
def head_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ar.head_rows(load_corpus(spark, sf_dir).select("doc_id", "title"), 1000, key="doc_id")


@register("validate_dates", o._chain(
    "select doc_id, publish_raw, strftime(publish_time, '%Y-%m-%d') publish_time from corpus", "corpus"))
def validate_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load_corpus(spark, sf_dir).select("doc_id", "publish_raw")
    return ar.validate_dates(rows, "publish_raw", "publish_time").select(
        "doc_id", "publish_raw", _day("publish_time"))


@register("rejected_dates", o._chain("""
    select publish_raw rejected, count(*) n_rows from corpus
    where publish_raw is not null and publish_time is null group by 1""", "corpus"))
def rejected_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ar.rejected_dates(load_corpus(spark, sf_dir), "publish_raw")


@register("typed_corpus", o._chain(
    "select cast(doc_id as varchar) cord_uid, "
    + ", ".join({"source_x": "source source_x", "title": "title", "pr_title": "title pr_title",
                 "abstract": "abstract", "pr_abstract": "abstract pr_abstract",
                 "publish_time": "strftime(publish_time, '%Y-%m-%d') publish_time"}.get(
                     n, f"cast(null as varchar) {n}") for n in ar.ARTICLE_FIELDS[1:])
    + " from corpus", "corpus"))
def typed_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ar.with_processed_copies(load_corpus(spark, sf_dir)).select(
        F.col("doc_id").alias("cord_uid"), F.col("source").alias("source_x"), "title", "pr_title",
        "abstract", "pr_abstract", F.col("publish_raw").alias("publish_time"))
    typed = ar.to_typed(rows)
    return typed.withColumn("publish_time", _day("publish_time"))


_JSON_COLUMNS = "doc_id title abstract lang source publish_raw publish_time pr_title pr_abstract".split()


@register("docs_as_json", o._chain(
    "select doc_id, cast(to_json({"
    + ", ".join(f"'{c}': {c.removeprefix('pr_')}" for c in _JSON_COLUMNS)
    + "}) as varchar) document from corpus", "corpus"))
def docs_as_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ar.rows_as_json(ar.with_processed_copies(load_corpus(spark, sf_dir)), "doc_id")


@register("csv_corpus", o._chain("""
    select cast(doc_id as varchar) cord_uid, source source_x, nullif(title, '') title, nullif(abstract, '') abstract, publish_raw publish_time
    from corpus""", "corpus"))
def csv_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus as CSV files with quoted cells over several lines, and read back."""
    path = stage_path(spark, "csv")
    load_corpus(spark, sf_dir).select(
        F.col("doc_id").alias("cord_uid"), F.col("source").alias("source_x"), "title", "abstract",
        F.col("publish_raw").alias("publish_time")).write.csv(path, header=True, quote='"', escape='"', emptyValue="", lineSep="\n",
                                                             ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return ar.read_articles_csv(spark, path).select("cord_uid", "source_x", "title", "abstract", "publish_time")


_LINE_COLUMNS = ["cord_uid", "title", "lang", "source", "publish_time"]


@register("rejected_rows", o._chain("""
    with c as (select *, doc_id % 10 digit, '"' || replace(translate(title, chr(13), ' '), '"', '""') || '"' cell from corpus)
    select 'malformed record' reasons, doc_id || ',' || cell || ',' || lang as record from c where digit = 1
    union all select 'malformed record', doc_id || ',' || cell || ',' || lang || ',' || source || ',' || publish_raw || ',more' from c where digit = 2
    union all select 'no id', nullif(translate(title, chr(13), ' '), '') from c where digit = 3""", "corpus").replace(
        "\n\n    with c as", ",\n c as"))
def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus as lines of text, of which a tenth lacks cells, a tenth has one too many and a tenth has no id."""
    lines, digit = stage_path(spark, "lines"), F.col("doc_id") % 10
    title = F.translate("title", "\r", " ")
    cell = F.concat(F.lit('"'), F.replace(title, F.lit('"'), F.lit('""')), F.lit('"'))
    cells = [F.when(digit != 3, F.col("doc_id").cast("string")).otherwise(""), cell, F.col("lang"),
             F.when(digit != 1, F.col("source")), F.when(digit != 1, F.coalesce("publish_raw", F.lit(""))), F.when(digit == 2, F.lit("more"))]
    load_corpus(spark, sf_dir).select(F.concat_ws(",", *cells)).write.text(lines)
    screened = sg.screen_csv(spark, lines, "cord_uid", stage_path(spark, "screened"), _LINE_COLUMNS, multi_line=False)
    return screened.rejected.select(F.array_join(sg.REASONS, ", ").alias("reasons"), F.coalesce(sg.RECORD, "title").alias("record"))


@register("normalized_table", o._chain("""
    select doc_id, max(array_to_string(sentences, ' | ')) filter (field = 'pr_title') pr_title,
           max(array_to_string(sentences, ' | ')) filter (field = 'pr_abstract') pr_abstract
    from normal group by doc_id""", "normal"))
def normalized_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = nz.normalize_table(ar.with_processed_copies(load_corpus(spark, sf_dir)))
    return table.select("doc_id", *[F.array_join(F.col(c)["sentence"], " | ").alias(c) for c in nz.PROCESSED])


# ---------------------------------------------------------------- index tables

def _words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pl.system2_words(load_corpus(spark, sf_dir))


@register("build_postings", o._chain("select field, term, doc_id, tf from post", "post"))
def build_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ix.build_postings(_words(spark, sf_dir)).select("field", "term", "doc_id", "tf")


@register("term_stats", o._chain("select field, term, df from df", "df"))
def term_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ix.vocabulary(_words(spark, sf_dir))


@register("doc_stats", o._chain("select field, doc_id, dl from dl", "dl"))
def doc_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ix.doc_stats(_words(spark, sf_dir))


@register("field_stats", o._chain("select field, n_docs, round(avgdl, 6) avgdl from fs", "fs"))
def field_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(ix.field_stats(ix.doc_stats(_words(spark, sf_dir))), "avgdl")


# ---------------------------------------------------------------- normalisation

@register("normalize_text", o._chain(
    "select doc_id, field, array_to_string(sentences, ' | ') normal from normal", "normal"))
def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nz.normalize_fields(load_corpus(spark, sf_dir)).select(
        "doc_id", "field", F.array_join("sentences", " | ").alias("normal"))


@register("split_sentences", o._chain("""
    select doc_id, field, cast(generate_subscripts(s, 1) - 1 as bigint) sent_no, unnest(s) sentence
    from (select doc_id, field, list_filter(string_split(regexp_replace(t, ' +', ' ', 'g'), chr(1)),
                 lambda x: x <> '') s from marked)""", "marked"))
def split_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = nz.to_fields(load_corpus(spark, sf_dir), nz.PROCESSED)
    return nz.explode_sentences(fields.select(
        "doc_id", "field", tx.split_sentences(F.col("text")).alias("sentences")))


@register("abbreviations", o._chain(
    "select word, n_stop, n_plain, round(score, 4) score, score >= 0.3 is_short from abbr", "abbr"))
def abbreviations(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = sn.score_abbreviations(sn.stop_counts(nz.to_fields(load_corpus(spark, sf_dir), nz.PROCESSED)))
    return _rounded(scored.withColumn("is_short", F.col("score") >= sn.LEAST_SCORE), "score", digits=4)


@register("learnt_sentences", o._chain(r"""
    select doc_id, field, cast(generate_subscripts(l, 1) - 1 as bigint) sent_no, unnest(l) sentence from (
      select doc_id, field, list_transform(list_filter(string_split(string_agg(sentence || case
               when suffix(sentence, '.') and regexp_replace(regexp_extract(sentence, '(\S+)$', 1), '\.$', '') in (
                 select word from abbr where score >= 0.3) then ' ' else chr(1) end, '' order by sent_no), chr(1)),
               lambda x: x <> ''), lambda x: rtrim(x)) l
      from (select doc_id, field, generate_subscripts(s, 1) sent_no, unnest(s) sentence
            from (select doc_id, field, list_filter(string_split(regexp_replace(t, ' +', ' ', 'g'), chr(1)),
                         lambda x: x <> '') s from marked)) group by doc_id, field)""", "marked", "abbr"))
def learnt_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = nz.to_fields(load_corpus(spark, sf_dir), nz.PROCESSED)
    known = sn.abbreviations(sn.score_abbreviations(sn.stop_counts(fields)))
    return nz.explode_sentences(sn.split_sentences(fields, known))


@register("tokenize", o._chain("select doc_id, field, sent_no, pos, word from tok", "tok"))
def tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nz.explode_words(nz.normalize_fields(load_corpus(spark, sf_dir)))


@register("sentence_records", o._chain("""
    select doc_id, field, sent_no, cast(case when sentence = '' then 0
           else len(string_split(sentence, ' ')) end as bigint) n_tokens, sentence from sent""", "sent"))
def sentence_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = nz.normalize_fields(load_corpus(spark, sf_dir)).select(
        "doc_id", "field", F.posexplode(tx.sentence_records(F.col("sentences"))).alias("sent_no", "r"))
    return records.select("doc_id", "field", F.col("sent_no").cast("long").alias("sent_no"),
                          F.size("r.tokens").cast("long").alias("n_tokens"), "r.sentence")


@register("remove_stop_words", o._chain("select doc_id, field, sent_no, sentence from kw", "kw"))
def remove_stop_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nz.explode_sentences(_plain(spark, sf_dir))


# ---------------------------------------------------------------- keyword selection

@register("corpus_words", o._chain("select doc_id, field, sent_no, pos, word from kwtok", "kwtok"))
def corpus_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kw.corpus_words(_plain(spark, sf_dir))


@register("corpus_size", o._chain(
    "select cast(sum(n) as bigint) n_words, count(*) n_distinct from uni", "uni"))
def corpus_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kw.corpus_size(_plain(spark, sf_dir))


@register("top_unigrams", o._chain("select rank, word, n from topuni", "topuni"))
def top_unigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kw.top_unigrams(kw.word_counts(_plain(spark, sf_dir)))


@register("bigram_counts", o._chain("select w1, w2, n from bi", "bi"))
def bigram_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kw.ngram_counts(_plain(spark, sf_dir), 2)


@register("trigram_counts", o._chain("select w1, w2, w3, n from tri", "tri"))
def trigram_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kw.ngram_counts(_plain(spark, sf_dir), 3)


@register("bigram_pmi", o._chain("select gram, n, round(pmi, 6) pmi from bipmi", "bipmi"))
def bigram_pmi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(kw.bigram_pmi(_settled(spark, sf_dir)), "pmi").select("gram", "n", "pmi")


@register("trigram_pmi", o._chain("select gram, n, round(pmi, 6) pmi from tripmi", "tripmi"))
def trigram_pmi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(kw.trigram_pmi(_settled(spark, sf_dir)), "pmi").select("gram", "n", "pmi")


_DICTIONARY = "select phrase, clean, cast(n_words as bigint) n_words, round(score, 6) score from"


@register("frequent_dictionary", o._chain(f"{_DICTIONARY} freqdict", "freqdict"))
def frequent_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(kw.frequent_dictionary(_settled(spark, sf_dir)), "score")


@register("textrank_words", o._chain("""
    select doc_id, field, word, round(rank, 6) rank from tr_20""", "tr_20"))
def textrank_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = tr.rank_words(_plain(spark, sf_dir))
    return _rounded(ranks, "rank").select("doc_id", "field", "word", "rank")


@register("textrank_phrases", o._chain("""
    select doc_id, field, phrase, cast(n_words as bigint) n_words, round(score, 6) score
    from tr_phrases""", "tr_phrases"))
def textrank_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(tr.rank_phrases(_settled(spark, sf_dir)), "score")


@register("textrank_dictionary", o._chain(f"{_DICTIONARY} trdict", "trdict"))
def textrank_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(tr.textrank_dictionary(tr.rank_phrases(_settled(spark, sf_dir))), "score")


@register("dictionary_sizes", o._chain(
    "select source, count(distinct phrase) n_phrases from dict group by 1", "dict"))
def dictionary_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    plain = _settled(spark, sf_dir)
    return tr.dictionary_sizes({
        "frequent": kw.frequent_dictionary(plain),
        "textrank": tr.textrank_dictionary(tr.rank_phrases(plain))})


@register("keyword_matches", o._chain("""
    select doc_id, field, sent_no, source, start, cast(n_words as bigint) n_words, clean
    from matches""", "matches"))
def keyword_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    plain = _settled(spark, sf_dir)
    return ma.keyword_matches(plain, pl.keyword_dictionary(plain))


@register("merge_keywords", o._chain(
    "select doc_id, field, sent_no, array_to_string(kws, ' ') keywords from merged", "merged"))
def merge_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    plain = _settled(spark, sf_dir)
    merged = ma.merge_keywords(pl.match_both(plain, pl.keyword_dictionary(plain)))
    return nz.explode_sentences(merged).withColumnRenamed("sentence", "keywords")


@register("merge_keyword_sentences", o._chain(f"""
    select doc_id, field, cast(generate_subscripts(l, 1) - 1 as bigint) pos, unnest(l) sentence from (
      select doc_id, field, list_concat(a, {o._NEW_IN.format(a='a', b='b')}) l from (
        select doc_id, field, list(array_to_string(t, ' ') order by sent_no) a,
               list(array_to_string(f, ' ') order by sent_no) b
        from matched group by all))""", "matched"))
def merge_keyword_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    plain = _settled(spark, sf_dir)
    merged = ma.merge_keyword_sentences(pl.match_both(plain, pl.keyword_dictionary(plain)))
    return nz.explode_sentences(merged).withColumnRenamed("sent_no", "pos")


@register("tfidf", o._chain("select doc_id, field, term, tf, round(tfidf, 6) tfidf from tfidf", "tfidf"))
def tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(ti.tfidf(_settled(spark, sf_dir)), "tfidf")


@register("tfidf_terms", o._chain("select doc_id, field, term from terms", "terms"))
def tfidf_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ti.best_terms(ti.tfidf(_settled(spark, sf_dir))).select("doc_id", "field", "term")


_REDUCED_SQL = """
    select doc_id, field, sent_no, s sentence from (
      select doc_id, field, cast(row_number() over (partition by doc_id, field order by sent_no) - 1
             as bigint) sent_no, s from reduced {where})"""


@register("tfidf_sentences", o._chain(_REDUCED_SQL.format(where="where s <> ''"), "reduced"))
def tfidf_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    plain = _settled(spark, sf_dir)
    return nz.explode_sentences(ti.reduce_to_terms(plain, ti.best_terms(ti.tfidf(plain))))


@register("tfidf_sentences_keep_empty", o._chain(_REDUCED_SQL.format(where=""), "reduced"))
def tfidf_sentences_keep_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    plain = _settled(spark, sf_dir)
    return nz.explode_sentences(
        ti.reduce_to_terms(plain, ti.best_terms(ti.tfidf(plain)), drop_empty=False))


def _lemma_table(normal: DataFrame) -> DataFrame:
    terms = ix.vocabulary(nz.words_of_sentences(normal))
    return lm.lemmas(terms.select(F.col("term").alias("word")), lm.corpus_lexicon(terms))


@register("lemmas", o._chain("select word, lemma from lemma", "lemma"))
def lemmas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lemma_table(nz.normalize_fields(load_corpus(spark, sf_dir)))


@register("lemmatized_sentences", o._chain("""
    select doc_id, field, sent_no, coalesce(s, '') sentence from sent left join (
      select doc_id, field, sent_no, string_agg(lemma, ' ' order by pos) s
      from tok join lemma using (word) group by all) using (doc_id, field, sent_no)""",
    "sent", "tok", "lemma"))
def lemmatized_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    normal = settle(nz.normalize_fields(load_corpus(spark, sf_dir)), "normal")
    return nz.explode_sentences(lm.lemmatize_sentences(normal, settle(_lemma_table(normal), "lemmas")))


# ---------------------------------------------------------------- ranked search

def _live(spark: SparkSession, sf_dir: str) -> ix.LiveIndex:
    return pl.live(_words(spark, sf_dir))


def _scored(name: str, *queries: se.MatchQuery) -> None:
    """Register all matches of a batch with their scores."""
    @register(name, o.search_sql(queries, "select query_id, doc_id, round(score, 6) score from scored", "scored"))
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _rounded(se.multi_match(_live(spark, sf_dir), queries, spark), "score")


def _hits(name: str, *queries: se.MatchQuery) -> None:
    """Register the top hits of a batch."""
    @register(name, o.search_sql(queries, "select query_id, rank, doc_id, round(score, 6) score from hits", "hits"))
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _rounded(se.search(_live(spark, sf_dir), queries, spark), "score")


@register("match_all", o._chain("select doc_id, 1e0 score from corpus order by doc_id limit 10", "corpus"))
def match_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return se.match_all(load_corpus(spark, sf_dir))


PHRASES = {"phrase1": ("pr_abstract", "of the"), "phrase2": ("pr_abstract", "the and of")}


def _phrase_sql() -> str:
    parts = []
    for query_id, (name, text) in PHRASES.items():
        terms = text.split()
        joins = " ".join(
            f"join word w{i} on w{i}.doc_id = w0.doc_id and w{i}.field = w0.field and w{i}.pos = w0.pos + {i} "
            f"and w{i}.term = '{t}'" for i, t in enumerate(terms) if i)
        idfs = " + ".join(
            f"(select ln(1 + (n_docs - df + 0.5e0) / (df + 0.5e0)) from df join fs using (field) "
            f"where field = '{name}' and term = '{t}')" for t in terms)
        parts.append(f"""
          select '{query_id}' query_id, doc_id, freq,
                 round(({idfs}) * freq / (freq + 1.2e0 * (0.25e0 + 0.75e0 * dl / avgdl)), 6) score
          from (select w0.doc_id, w0.field, count(*) freq from word w0 {joins}
                where w0.field = '{name}' and w0.term = '{terms[0]}' group by all)
               join dl using (doc_id, field) join fs using (field)""")
    return o._chain(" union all ".join(parts), "word", "df", "fs", "dl")


@register("match_phrase", _phrase_sql())
def match_phrase(spark: SparkSession, sf_dir: str) -> DataFrame:
    return se.match_phrase(_live(spark, sf_dir), PHRASES, spark)


@register("match_date", o._chain("""
    select doc_id, publish_raw from corpus where publish_time = date '2020-03-15'""", "corpus"))
def match_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return se.match_date(load_corpus(spark, sf_dir), "publish_time", "2020-03-15").select(
        "doc_id", "publish_raw")


@register("match_date_text", o._chain("""
    select doc_id, publish_raw from corpus where publish_raw = '2020-03-15'""", "corpus"))
def match_date_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return se.match_date_text(load_corpus(spark, sf_dir), "publish_raw", "2020-03-15").select(
        "doc_id", "publish_raw")


_TITLE_ONLY = se.MatchQuery("bm25", "that erblest whou the", {"pr_abstract": 1.0})
_scored("bm25", _TITLE_ONLY)
_scored("multi_match", se.MatchQuery("multi", "that erblest whou the", FIELDS))
_scored("min_should_match",
        se.MatchQuery("half", "erblest whou the eranenes thtion", FIELDS, minimum_should_match="50%"),
        se.MatchQuery("three", "erblest whou the eranenes thtion", FIELDS, minimum_should_match=3))
_scored("fuzzy_match", SYMPTOMS)
_scored("english_match", INFLUENCE)
_scored("bool_filter_match", MASKS)
_hits("top_k_hits", FLAGSHIP, se.MatchQuery("longer", "thtion eranenes of", FIELDS_3, size=50))

# The same searches on an index that was written before; results are those of the live one.

def _stored(spark: SparkSession, sf_dir: str) -> st.StoredIndex:
    """The index of the whole corpus, opened from its folder as a reader would."""
    path = stage_path(spark, "index")
    st.write_index(_words(spark, sf_dir), path, pl.INDEX_ATTRIBUTES)
    return st.open_index(spark, path)


def _upserted(spark: SparkSession, sf_dir: str) -> st.StoredIndex:
    """An index that becomes that of the whole corpus: a tenth of the documents was never there, for a tenth the index holds
    titles in place of both texts, and both come in one upsert."""
    path = stage_path(spark, "index")
    words, digit = _words(spark, sf_dir), F.col("doc_id") % 10
    corpus = load_corpus(spark, sf_dir).withColumn("abstract", F.when(digit == 3, F.col("title")).otherwise(F.col("abstract")))
    st.write_index(pl.system2_words(corpus.where(digit != 7)), path, pl.INDEX_ATTRIBUTES)
    st.upsert(st.open_index(spark, path), words.where(digit.isin(3, 7)))
    return st.open_index(spark, path)


_DEEP = se.MatchQuery("deep", "that erblest whou the", FIELDS_3, size=5000)
_STORED_BATCH = (*QUESTIONS, FLAGSHIP, _DEEP)
_STORED_SQL = o.search_sql(_STORED_BATCH, "select query_id, rank, doc_id, round(score, 6) score from hits", "hits")


@register("stored_search", _STORED_SQL)
def stored_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(se.search(_stored(spark, sf_dir), _STORED_BATCH, spark), "score")


@register("upserted_search", _STORED_SQL)
def upserted_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(se.search(_upserted(spark, sf_dir), _STORED_BATCH, spark), "score")


@register("compacted_term_stats", ORACLES["term_stats"])
def compacted_term_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return st.compact(_upserted(spark, sf_dir)).vocabulary()


@register("stored_phrase", _phrase_sql())
def stored_phrase(spark: SparkSession, sf_dir: str) -> DataFrame:
    return se.match_phrase(_stored(spark, sf_dir), PHRASES, spark)


_hits("top_5000_hits", _DEEP)


_FUZZY_TERMS = [("therinn", 2), ("whoo", 1), ("eranenes", 2), ("teh", 1), ("htoin", 2)]


@register("fuzzy_expand", o._chain(f"""
    select field, qterm query_term, term, cast(dist as bigint) dist,
           round(1 - dist / least(length(qterm), length(term)), 6) weight from (
      select *, row_number() over (partition by field, qterm order by dist, term) n from (
        select field, qterm, term, edits, {o.distance_sql("qterm", "term")} dist
        from df, (values {", ".join(f"('{t}', {d})" for t, d in _FUZZY_TERMS)}) q(qterm, edits)
        where abs(length(term) - length(qterm)) <= edits and damerau_levenshtein(qterm, term) <= edits)
      where dist <= edits)
    where n <= 50""", "df"))
def fuzzy_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [{"field": f, "query_term": t, "max_edits": d} for f in FIELDS for t, d in _FUZZY_TERMS]
    expanded = fz.fuzzy_expand(_live(spark, sf_dir).vocabulary(), fz.fuzzy_terms(spark, rows))
    return _rounded(expanded, "weight").select("field", "query_term", "term", "dist", "weight")


@register("analyze_standard", f"""
    select item_id, cast(generate_subscripts(l, 1) - 1 as bigint) clause_no, unnest(l) term
    from (select item_id, {o._standard_sql('text')} l from benchmark)""")
def analyze_standard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return se.analyze(spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"), "item_id")


_RANGE = ("publish_time", "2020-06-01", "2021-03-01")


@register("date_range", o._chain("""
    select doc_id, publish_raw from corpus
    where publish_time between date '2020-06-01' and date '2021-03-01'""", "corpus"))
def date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return se.date_range(load_corpus(spark, sf_dir), *_RANGE).select("doc_id", "publish_raw")


@register("exists_filter", o._chain("select doc_id from corpus where publish_time is not null", "corpus"))
def exists_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return se.field_exists(load_corpus(spark, sf_dir), "publish_time").select("doc_id")


@register("must_not_term", o._chain(
    "select doc_id, publish_raw from corpus where publish_raw is distinct from '2020'", "corpus"))
def must_not_term(spark: SparkSession, sf_dir: str) -> DataFrame:
    return se.must_not_equal(load_corpus(spark, sf_dir), "publish_raw", "2020").select("doc_id", "publish_raw")


@register("exists_must_not_hits", o._chain("""
    select doc_id, title from corpus where publish_raw is not null and publish_raw <> '2020'
    order by doc_id limit 50""", "corpus"))
def exists_must_not_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = se.must_not_equal(se.field_exists(load_corpus(spark, sf_dir), "publish_raw"), "publish_raw", "2020")
    return rows.select("doc_id", "title").orderBy("doc_id").limit(50)


@register("hit_counts", o.search_sql(
    QUESTIONS, "select query_id, count(*) n_hits from scored group by 1", "scored"))
def hit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return se.hit_counts(se.multi_match(_live(spark, sf_dir), QUESTIONS, spark))


# ---------------------------------------------------------------- pipelines

_SHOW = "title, abstract, strftime(publish_time, '%Y-%m-%d') publish_time"


def _shown(hits: DataFrame, corpus: DataFrame) -> DataFrame:
    found = se.with_source(hits, corpus, ["title", "abstract", "publish_time"])
    return found.select("query_id", "rank", "doc_id", "score", "title", "abstract", _day("publish_time"))


def _hit_rows_sql(queries: tuple, suffix: str = "") -> str:
    return o.search_sql(queries, f"select query_id, rank, doc_id, round(score, 6) score, {_SHOW} from hits join corpus using (doc_id)",
                        "hits", "corpus", suffix=suffix)


@register("system2_search", _hit_rows_sql((FLAGSHIP,)))
def system2_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus = load_corpus(spark, sf_dir)
    return _shown(se.search(pl.live(pl.system2_words(corpus)), [FLAGSHIP], spark), corpus)


@register("system1_search", _hit_rows_sql(QUESTIONS, "_s1"))
def system1_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus = load_corpus(spark, sf_dir)
    # Fuzzy terms and hits each read the words; what they are made of goes.
    words = settle_parts([lambda: pl.system1_words(corpus)], "words")
    return _shown(se.search(pl.live(words), QUESTIONS, spark), corpus)


_RAW_QUERY = se.MatchQuery("raw", "that erblest whou the", {"title": 1.0, "abstract": 5.0},
                           minimum_should_match="50%")


@register("raw_search", _hit_rows_sql((_RAW_QUERY,), "_raw"))
def raw_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus = load_corpus(spark, sf_dir)
    return _shown(se.search(pl.live(pl.raw_field_words(corpus)), [_RAW_QUERY], spark), corpus)


_BATCH = tuple(pl.for_system(q, s) for q in QUESTIONS for s in pl.SYSTEMS)
_RUN_SQL = "split_part(query_id, '@', 1) query_id, split_part(query_id, '@', 2) system"


@register("batch_search", o.search_sql(
    _BATCH, f"select {_RUN_SQL}, rank, doc_id, round(score, 6) score from hits", "hits", suffix="_both"))
def batch_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(pl.batch_search(load_corpus(spark, sf_dir), QUESTIONS, spark), "score")


# ---------------------------------------------------------------- evaluation

_JUDGED_SQL = f"""
    (select {_RUN_SQL}, rank, coalesce(quality, 0) rel from hits left join labels using (doc_id))"""


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = settle(batch_search(spark, sf_dir), "hits")
    return pl.judge(hits, spark.read.parquet(f"{sf_dir}/labels.parquet"))


_CURVES_SQL = f"""
    select query_id, system, rank, sum(rel) over w / rank p, sum(rel) over w / nullif(sum(rel) over r, 0) r
    from {_JUDGED_SQL}
    window r as (partition by query_id, system),
           w as (partition by query_id, system order by rank rows unbounded preceding)"""


@register("precision_at_k", o.search_sql(_BATCH, f"""
    select query_id, system, rank, round(p, 6) "precision" from ({_CURVES_SQL}) where rank <= {K}""",
    "hits", suffix="_both"))
def precision_at_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(ev.precision_at_k(_judged(spark, sf_dir), K), "precision")


@register("recall_at_k", o.search_sql(_BATCH, f"""
    select query_id, system, rank, round(r, 6) recall from ({_CURVES_SQL}) where rank <= {K}""",
    "hits", suffix="_both"))
def recall_at_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(ev.recall_at_k(_judged(spark, sf_dir), K), "recall")


_SHOWN_COLUMNS = ("doc_id", "title", "publish_time")
_SIDES_SQL = ", ".join(f"{s}.{c} {c}_{s}" for c in _SHOWN_COLUMNS for s in pl.SYSTEMS)


@register("compare_systems", o.search_sql(_BATCH, f"""
    with h as (select {_RUN_SQL}, rank, doc_id, title, strftime(publish_time, '%Y-%m-%d') publish_time
               from hits join corpus using (doc_id))
    select query_id, rank, {_SIDES_SQL}
    from (select * from h where system = 'System_1') System_1
         full join (select * from h where system = 'System_2') System_2 using (query_id, rank)""",
    "hits", "corpus", suffix="_both").replace("\n\n    with h as", ",\n h as"))
def compare_systems(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = settle(batch_search(spark, sf_dir), "hits")
    shown = se.with_source(hits, load_corpus(spark, sf_dir), ["title", "publish_time"])
    return ev.compare_systems(shown.withColumn("publish_time", _day("publish_time")),
                              _SHOWN_COLUMNS, pl.SYSTEMS)


@register("quality_table", o.search_sql(_BATCH, f"""
    select query_id, {", ".join(
        f"round(coalesce(sum(rel) filter (system = '{s}' and rank <= {K}), 0) / {K}, 6) p_{s}, "
        f"round(coalesce(sum(rel) filter (system = '{s}' and rank <= {K}), 0) "
        f"/ nullif(sum(rel) filter (system = '{s}'), 0), 6) r_{s}" for s in pl.SYSTEMS)}
    from {_JUDGED_SQL} group by query_id""", "hits", suffix="_both"))
def quality_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = ev.quality_table(_judged(spark, sf_dir), K, pl.SYSTEMS)
    return _rounded(table, *[f"{m}_{s}" for s in pl.SYSTEMS for m in "pr"])
