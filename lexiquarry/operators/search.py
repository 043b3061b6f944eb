"""Ranked search: query analysis, BM25 multi-field matching, phrases, fuzzy terms, filters, top-k.

A search takes a batch of queries and scores them together in one job. Query arguments become small
local tables whose exact size the planner knows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lexiquarry.functions.fixed import ANALYZER_STOP_WORDS
from lexiquarry.functions.porter import stem_terms, stem_word
from lexiquarry.functions.text import analyze_standard
from lexiquarry.operators.fuzzy import allowed_edits, fuzzy_terms
from lexiquarry.operators.index import LiveIndex, Lookup
from lexiquarry.operators.stored import StoredIndex
from lexiquarry.session import broadcast_at_most, local_table, settle

# BM25 parameters, default hit count.
K1 = 1.2
B = 0.75
DEFAULT_SIZE = 10
# Digits of a score that count for its rank.
SCORE_DIGITS = 12
# Up to so many rows a group, Spark's window limit drops the others before the shuffle.
WINDOW_LIMIT = 1000
# Ranges of scores that are counted at once where more hits are asked for, and how often.
CUT_RANGES, CUT_ROUNDS = 1024, 3

Index = LiveIndex | StoredIndex


@dataclass(frozen=True)
class MatchQuery:
    """One multi-field query. `fields` maps a field to its boost.

    `fuzziness` is None, "AUTO" or a number of edits. `minimum_should_match` is None, a number of
    terms or a text such as "50%". `between` keeps documents whose index attribute lies in a closed
    range: (attribute, lowest, highest), either bound may be None.
    """

    query_id: str
    text: str
    fields: dict[str, float]
    analyzer: str = "standard"
    fuzziness: str | int | None = None
    minimum_should_match: str | int | None = None
    between: tuple[str, str | None, str | None] | None = None
    size: int = field(default=DEFAULT_SIZE)


# ---------------------------------------------------------------- analysis

def query_table(spark: SparkSession, queries: Sequence[MatchQuery]) -> DataFrame:
    rows = [{"query_id": q.query_id, "text": q.text, "analyzer": q.analyzer} for q in queries]
    return local_table(spark, rows, pa.schema(
        [("query_id", pa.string()), ("text", pa.string()), ("analyzer", pa.string())]))


def analyze(texts: DataFrame, key: str = "query_id") -> DataFrame:
    """(key, clause_no, term) of (key, text[, analyzer]); clause_no counts the terms kept, from 0.

    "standard" keeps every word. "english" drops possessive endings and stop words and stems.
    """
    words = analyze_standard(F.col("text"))
    if "analyzer" in texts.columns:
        bare = F.transform(words, lambda w: F.regexp_replace(w, "['’]s$", ""))
        english = F.filter(bare, lambda w: ~w.isin(*ANALYZER_STOP_WORDS) & (w != ""))
        is_english = F.col("analyzer") == "english"
        terms = texts.select(key, is_english.alias("stemmed"), F.posexplode(
            F.when(is_english, english).otherwise(words)).alias("clause_no", "word"))
        plain = terms.where(~F.col("stemmed")).select(key, "clause_no", F.col("word").alias("term"))
        stemmed = terms.where("stemmed").select(key, "clause_no", stem_terms("word").alias("term"))
        terms = plain.unionByName(stemmed)
    else:
        terms = texts.select(key, F.posexplode(words).alias("clause_no", "term"))
    return terms.withColumn("clause_no", F.col("clause_no").cast("long"))


def analyze_queries(spark: SparkSession, queries: Sequence[MatchQuery]) -> list[tuple[str, int, str]]:
    """Analysed clauses of the batch as (query_id, clause_no, term), on the driver: they are arguments.

    Words are split in Spark; the few of "english" queries are stemmed where they have arrived.
    """
    words = analyze(query_table(spark, queries).drop("analyzer")).orderBy("query_id", "clause_no").collect()
    english = {q.query_id for q in queries if q.analyzer == "english"}
    clauses, last, number = [], None, 0
    for r in words:
        number, last = (number if r.query_id == last else 0), r.query_id
        term = r.term
        if r.query_id in english:
            bare = re.sub("['’]s$", "", term)
            if not bare or bare in ANALYZER_STOP_WORDS:
                continue
            term = stem_word(bare)
        clauses.append((r.query_id, number, term))
        number += 1
    return clauses


def required_matches(minimum: str | int | None, n_clauses: int) -> int:
    """Number of clauses that must match, at least one."""
    if minimum is None:
        return 1
    if isinstance(minimum, str) and minimum.endswith("%"):
        return max(1, math.floor(n_clauses * float(minimum[:-1]) / 100))
    return max(1, int(minimum))


# ---------------------------------------------------------------- scoring

def idf(n_docs: Column, df: Column) -> Column:
    return F.log(1 + (n_docs - df + 0.5) / (df + 0.5))


def tf_norm(tf: Column, dl: Column, avgdl: Column, k1: float = K1, b: float = B) -> Column:
    return tf / (tf + k1 * (1 - b + b * dl / avgdl))


def _clause_rows(index: Index, queries: Sequence[MatchQuery], clauses: list[tuple[str, int, str]],
                 spark: SparkSession) -> list[dict]:
    """One row per query, clause, field and index term, with the weight of the term."""
    by_id = {q.query_id: q for q in queries}
    rows, wanted = [], []
    for query_id, clause_no, term in clauses:
        query = by_id[query_id]
        for name in query.fields:
            row = {"query_id": query_id, "clause_no": clause_no, "field": name}
            edits = 0 if query.fuzziness is None else allowed_edits(query.fuzziness, term)
            if edits:
                wanted.append({**row, "query_term": term, "max_edits": edits})
            else:
                rows.append({**row, "term": term, "weight": 1.0})
    if wanted:
        table = fuzzy_terms(spark, wanted, [("query_id", pa.string()), ("clause_no", pa.int64())])
        # At most MAX_EXPANSIONS rows per query term and field come back.
        for r in index.fuzzy(table).collect():
            rows.append({"query_id": r.query_id, "clause_no": r.clause_no, "field": r.field,
                         "term": r.term, "weight": r.weight})
    return rows


def _clause_table(spark: SparkSession, rows: list[dict]) -> DataFrame:
    return local_table(spark, rows, pa.schema([
        ("query_id", pa.string()), ("clause_no", pa.int64()), ("field", pa.string()),
        ("term", pa.string()), ("weight", pa.float64())]))


def _with_values(rows: DataFrame, **values: tuple[dict[str, object], pa.DataType]) -> DataFrame:
    """Join one value per query and name; queries without a value get null.

    The values are a table of their own, so the plan does not grow with the batch.
    """
    ids = sorted({i for of, _ in values.values() for i in of})
    table = local_table(
        rows.sparkSession, [{"query_id": i, **{n: of.get(i) for n, (of, _) in values.items()}} for i in ids],
        pa.schema([("query_id", pa.string()), *[(n, kind) for n, (_, kind) in values.items()]]))
    return rows.join(table, "query_id", "left")


def _filtered(matched: DataFrame, queries: Sequence[MatchQuery]) -> DataFrame:
    """Drop matches whose attribute lies outside the closed range of their query."""
    for attribute in sorted({q.between[0] for q in queries if q.between}):
        own = {q.query_id: q.between for q in queries if q.between and q.between[0] == attribute}
        bounds = _with_values(matched, __asked=({i: True for i in own}, pa.bool_()),
                              __low=({i: b[1] for i, b in own.items()}, pa.string()),
                              __high=({i: b[2] for i, b in own.items()}, pa.string()))
        low, high, value = F.col("__low").cast("date"), F.col("__high").cast("date"), F.col(attribute)
        inside = value.isNotNull() & (low.isNull() | (value >= low)) & (high.isNull() | (value <= high))
        matched = bounds.where(F.col("__asked").isNull() | inside).drop("__asked", "__low", "__high")
    return matched


def clause_weights(clauses: DataFrame, term_stats: DataFrame, field_stats: DataFrame) -> DataFrame:
    """(query_id, clause_no, field, term, avgdl, idf): weights from the statistics alone, a row of `clauses` each at most."""
    known = clauses.join(term_stats, ["field", "term"]).join(F.broadcast(field_stats), "field")  # one row a field
    # All expansions of a fuzzy clause share the largest document frequency among them.
    shared = F.max("df").over(W.partitionBy("query_id", "clause_no", "field"))
    return known.select("query_id", "clause_no", "field", "term", "avgdl",
                        (F.col("weight") * idf(F.col("n_docs"), shared)).alias("idf"))


def score_terms(matched: DataFrame, queries: Sequence[MatchQuery] = ()) -> DataFrame:
    """(query_id, field, doc_id, clause_no, score) of postings joined with their weights."""
    return _filtered(matched, queries).select(
        "query_id", "field", "doc_id", "clause_no",
        (F.col("idf") * tf_norm(F.col("tf"), F.col("dl"), F.col("avgdl"))).alias("score"))


def combine_fields(scored: DataFrame, queries: Sequence[MatchQuery], n_clauses: dict[str, int],
                   one_term_per_clause: bool) -> DataFrame:
    """(query_id, doc_id, score): sum over clauses, boost, minimum match per field, best field wins."""
    fields = sorted({name for q in queries for name in q.fields})
    need = {q.query_id: required_matches(q.minimum_should_match, n_clauses.get(q.query_id, 0)) for q in queries}
    boosts = {f"boost_{i}": ({q.query_id: float(q.fields[name]) for q in queries if name in q.fields}, pa.float64())
              for i, name in enumerate(fields)}
    if not one_term_per_clause:
        scored = (scored.groupBy("query_id", "doc_id", "field", "clause_no")
                  .agg(F.max("score").alias("score")))
    measures = []
    for i, name in enumerate(fields):
        here = F.col("field") == name
        measures += [F.sum(F.when(here, F.col("score"))).alias(f"sum_{i}"),
                     F.count_if(here).alias(f"count_{i}")]
    totals = _with_values(scored.groupBy("query_id", "doc_id").agg(*measures), need=(need, pa.int32()), **boosts)
    bests = [F.when(F.col(f"count_{i}") >= F.col("need"), F.col(f"sum_{i}") * F.col(f"boost_{i}"))
             for i in range(len(fields))]
    best = F.greatest(*bests) if len(bests) > 1 else bests[0]
    return (totals.select("query_id", "doc_id", best.alias("score"))
            .where(F.col("score").isNotNull()))


@dataclass(frozen=True)
class _Batch:
    """Analysed queries: their clauses as rows and as a table, and how to put clause scores together."""

    queries: Sequence[MatchQuery]
    rows: list[dict]
    table: DataFrame
    n_clauses: dict[str, int]
    one_term_per_clause: bool

    @classmethod
    def of(cls, index: Index, queries: Sequence[MatchQuery], spark: SparkSession) -> _Batch:
        if len({q.query_id for q in queries}) < len(queries):
            raise ValueError("two queries of a batch have the same query_id")
        clauses = analyze_queries(spark, queries)
        rows = _clause_rows(index, queries, clauses, spark)
        n_terms = Counter((row["query_id"], row["clause_no"], row["field"]) for row in rows)
        return cls(queries, rows, _clause_table(spark, rows), Counter(query_id for query_id, _, _ in clauses),
                   max(n_terms.values(), default=1) == 1)

    def combined(self, scored: DataFrame, one_term_per_clause: bool | None = None) -> DataFrame:
        single = self.one_term_per_clause if one_term_per_clause is None else one_term_per_clause
        combined = combine_fields(scored, self.queries, self.n_clauses, single)
        # Sums differ in their last digits with the order they are made in; ties shall not depend on that.
        return combined.withColumn("score", F.round("score", SCORE_DIGITS))


def multi_match(index: Index, queries: Sequence[MatchQuery], spark: SparkSession) -> DataFrame:
    """(query_id, doc_id, score) of all documents that match, unranked."""
    batch = _Batch.of(index, queries, spark)
    found: Lookup = index.lookup(batch.table, [row["term"] for row in batch.rows])
    weights = clause_weights(batch.table, found.term_stats, found.field_stats)
    matched = found.postings.join(broadcast_at_most(weights, len(batch.rows)), ["field", "term"])
    return batch.combined(score_terms(matched, queries))


def _with_size(rows: DataFrame, queries: Sequence[MatchQuery] | int) -> DataFrame:
    if isinstance(queries, int):
        return rows.withColumn("size", F.lit(queries).cast("long"))
    return _with_values(rows, size=({q.query_id: q.size for q in queries}, pa.int64()))


def _ranks(rows: DataFrame) -> DataFrame:
    """`rank` of each row among those of its query, with the rows of a query in as many tasks as they need."""
    order = [F.col("query_id"), F.col("score").desc(), F.col("doc_id")]
    placed = settle(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({
        "__part": F.spark_partition_id(), "__place": F.monotonically_increasing_id()}), "ranked")
    # One row for each query and range of rows.
    parts = placed.groupBy("query_id", "__part").agg(F.count("*").alias("n"), F.min("__place").alias("__first"))
    before = W.partitionBy("query_id").orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    offsets = parts.select("query_id", "__part", "__first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__offset"))
    return placed.join(offsets, ["query_id", "__part"]).withColumn(
        "rank", F.col("__offset") + F.col("__place") - F.col("__first") + 1).drop("__part", "__place", "__first", "__offset")


def _cut(scored: DataFrame, queries: Sequence[MatchQuery] | int) -> DataFrame:
    """The rows that can be among the first of their query, and few more.

    Counts by ranges of the score find the range that holds the last hit, then its own ranges, and so on. Only
    counts are shuffled, and rows below the last such range never are.
    """
    state = _with_size(scored.groupBy("query_id").agg(F.min("score").alias("low"), F.max("score").alias("high")), queries)
    state = state.withColumn("above", F.lit(0).cast("long"))
    for _ in range(CUT_ROUNDS):
        state = settle(state, "ranges")
        inside = scored.join(state, "query_id").where((F.col("score") >= F.col("low")) & (F.col("score") <= F.col("high")))
        share = F.try_divide(F.col("score") - F.col("low"), F.col("high") - F.col("low"))
        place = F.coalesce(F.floor(share * CUT_RANGES), F.lit(0))
        counts = inside.groupBy("query_id", "size", "above", place.alias("place")).agg(
            F.count("*").alias("n"), F.min("score").alias("low"), F.max("score").alias("high"))
        # At most CUT_RANGES + 1 rows a query. Queries with fewer matches than their size reach it nowhere.
        down = W.partitionBy("query_id").orderBy(F.desc("place")).rowsBetween(W.unboundedPreceding, 0)
        state = (counts.withColumn("reached", F.col("above") + F.sum("n").over(down))
                 .where((F.col("reached") >= F.col("size")) & (F.col("reached") - F.col("n") < F.col("size")))
                 .select("query_id", "low", "high", "size", (F.col("reached") - F.col("n")).alias("above")))
    lows = settle(state, "ranges").select("query_id", "low")
    return scored.join(lows, "query_id", "left").where(F.col("low").isNull() | (F.col("score") >= F.col("low"))).drop("low")


def top_hits(scored: DataFrame, queries: Sequence[MatchQuery] | int = DEFAULT_SIZE) -> DataFrame:
    """(query_id, rank, doc_id, score): the best hits of each query, ties by doc_id.

    Rows that cannot be among them are dropped before the shuffle: by the planner for up to `WINDOW_LIMIT` hits, else by
    counts of the scores; then a query's hits are ranked in as many tasks as they need.
    """
    largest = queries if isinstance(queries, int) else max((q.size for q in queries), default=0)
    if largest > WINDOW_LIMIT:
        ranked = _ranks(_cut(settle(scored, "scored"), queries))
    else:
        best = W.partitionBy("query_id").orderBy(F.col("score").desc(), "doc_id")
        ranked = scored.withColumn("rank", F.row_number().over(best))
    ranked = ranked.where(F.col("rank") <= largest)
    if not isinstance(queries, int) and any(q.size != largest for q in queries):
        ranked = _with_size(ranked, queries).where(F.col("rank") <= F.col("size"))
    return ranked.select("query_id", F.col("rank").cast("long").alias("rank"), "doc_id", "score")


def search(index: Index, queries: Sequence[MatchQuery], spark: SparkSession) -> DataFrame:
    """Top hits of every query in the batch."""
    if isinstance(index, StoredIndex):
        return search_blocks(index, queries, spark)[0]
    return top_hits(multi_match(index, queries, spark), queries)


def search_blocks(index: StoredIndex, queries: Sequence[MatchQuery], spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """(hits, report): the top hits of every query, scored only where they can be.

    For each query and block of documents, the best pairs (tf, dl) of its terms bound the scores inside. A first pass scores
    as many of the best blocks as the query wants hits; their last hit is a score to beat. The second
    pass scores the other blocks whose bound reaches it. Filters only take hits away, so bounds hold with them too.
    The report has (query_id, blocks, blocks_read).
    """
    batch = _Batch.of(index, queries, spark)
    wanted = index.wanted(batch.table)
    stats = index.term_counts(wanted)
    weights = settle(clause_weights(batch.table, stats, index.field_stats()), "weights")
    best = F.array_max(F.transform("best", lambda p: tf_norm(p["tf"], p["dl"], F.col("avgdl"))))
    met = settle(index.blocks(wanted).join(weights, ["field", "term"]).select(
        "query_id", "clause_no", "field", "term", "block", (F.col("idf") * best).alias("score")), "blocks")
    bounds = settle(batch.combined(met.withColumnRenamed("block", "doc_id"), False).select(
        "query_id", F.col("doc_id").alias("block"), "score"), "bounds")

    def scored(blocks: DataFrame) -> DataFrame:
        places = met.select("query_id", "field", "term", "block").distinct().join(blocks, ["query_id", "block"], "left_semi")
        matched = index.in_blocks(places).join(
            broadcast_at_most(weights, len(batch.rows)), ["query_id", "field", "term"])
        return top_hits(batch.combined(score_terms(matched, queries)), queries)

    first = settle(top_hits(bounds.withColumnRenamed("block", "doc_id"), queries)
                   .select("query_id", F.col("doc_id").alias("block")), "first")
    hits = settle(scored(first), "hits")
    beat = _with_size(hits.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("least")), queries)
    beat = beat.where(F.col("n") >= F.col("size")).select("query_id", (F.col("least") * (1 - 1e-9)).alias("least"))
    rest = settle(bounds.join(first, ["query_id", "block"], "left_anti").join(beat, "query_id", "left")
                  .where(F.col("least").isNull() | (F.col("score") >= F.col("least"))).select("query_id", "block"), "rest")
    found = top_hits(hits.drop("rank").unionByName(scored(rest).drop("rank")), queries)
    read = first.unionByName(rest).groupBy("query_id").agg(F.count("*").alias("blocks_read"))
    report = bounds.groupBy("query_id").agg(F.count("*").alias("blocks")).join(read, "query_id")
    return found, report


# ---------------------------------------------------------------- phrases

def _phrase_rows(phrases: dict[str, tuple[str, str]], spark: SparkSession) -> list[dict]:
    """(query_id, clause_no, field, term, weight) of the words of phrases."""
    queries = [MatchQuery(query_id, text, {name: 1.0}) for query_id, (name, text) in phrases.items()]
    return [{"query_id": i, "clause_no": n, "field": phrases[i][0], "term": t, "weight": 1.0}
            for i, n, t in analyze_queries(spark, queries)]


def phrase_elements(words: list[str], frequent: set[str]) -> list[tuple[int, str]]:
    """(offset, words) that cover a phrase: a pair wherever a word is frequent, else the word by itself."""
    def pair(i: int) -> bool:
        return 0 <= i < len(words) - 1 and (words[i] in frequent or words[i + 1] in frequent)

    elements, covered = [], 0
    while covered < len(words):
        at = covered if pair(covered) else covered - 1 if pair(covered - 1) else None
        if at is None:
            elements.append((covered, words[covered]))
            covered += 1
        else:
            elements.append((at, f"{words[at]} {words[at + 1]}"))
            covered = at + 2
    return elements


def _stored_starts(index: StoredIndex, rows: list[dict], spark: SparkSession) -> DataFrame:
    """(query_id, doc_id, dl, start) of phrases, from pairs and words: rarest element first, the others only where it is."""
    words = local_table(spark, rows, pa.schema([("query_id", pa.string()), ("field", pa.string()), ("term", pa.string())]))
    # Only the frequent words that the phrases have.
    known = words.select("field", "term").distinct().join(index.frequent(), ["field", "term"]).collect()
    table = []
    for query_id in {r["query_id"]: None for r in rows}:
        own = [r for r in rows if r["query_id"] == query_id]
        name = own[0]["field"]
        elements = phrase_elements([r["term"] for r in own], {r.term for r in known if r.field == name})
        table += [{"query_id": query_id, "field": name, "term": t, "offset": at, "n_elements": len(elements)} for at, t in elements]
    elements = local_table(spark, table, pa.schema([
        ("query_id", pa.string()), ("field", pa.string()), ("term", pa.string()), ("offset", pa.int64()), ("n_elements", pa.int64())]))
    rarest = W.partitionBy("query_id").orderBy("df", "offset")
    ordered = settle(elements.join(index.element_stats(elements), ["field", "term"])
                     .withColumn("place", F.row_number().over(rarest)).drop("df"), "elements")

    def starts(found: DataFrame) -> DataFrame:
        return found.select("query_id", "n_elements", "doc_id", "dl", F.explode("positions").alias("pos"), "offset").select(
            "query_id", "n_elements", "doc_id", "dl", (F.col("pos") - F.col("offset")).alias("start"))

    first = settle(starts(index.elements(ordered.where("place = 1"))), "starts")
    others = index.elements(ordered.where("place > 1")).join(
        first.select("query_id", "doc_id").distinct(), ["query_id", "doc_id"], "left_semi")
    return (first.unionByName(starts(others)).groupBy("query_id", "n_elements", "doc_id", "dl", "start")
            .agg(F.count("*").alias("n")).where(F.col("n") == F.col("n_elements")).select("query_id", "doc_id", "dl", "start"))


def _live_starts(found: Lookup, rows: list[dict], spark: SparkSession) -> DataFrame:
    """Every occurrence votes for the position where its phrase would start; a start with a vote from each clause is one."""
    n_clauses = Counter(row["query_id"] for row in rows)
    votes = (found.occurrences.join(_clause_table(spark, rows), ["field", "term"])
             .groupBy("query_id", "doc_id", "dl", (F.col("pos") - F.col("clause_no")).alias("start"))
             .agg(F.count("*").alias("n")))
    return _with_values(votes, wanted=(dict(n_clauses), pa.int64())).where(F.col("n") == F.col("wanted"))


def match_phrase(index: Index, phrases: dict[str, tuple[str, str]], spark: SparkSession) -> DataFrame:
    """(query_id, doc_id, freq, score): the words of a phrase adjacent and in order in one field.

    `phrases` maps a query_id to (field, text).
    """
    rows = _phrase_rows(phrases, spark)
    clauses = _clause_table(spark, rows)
    if isinstance(index, StoredIndex):
        term_stats, field_stats = index.term_counts(index.wanted(clauses)), index.field_stats()
        starts = _stored_starts(index, rows, spark)
    else:
        found = index.lookup(clauses, [row["term"] for row in rows], positions=True)
        term_stats, field_stats = found.term_stats, found.field_stats
        starts = _live_starts(found, rows, spark)
    # Sum of the weights of all clauses; a phrase with an unknown term has no occurrence anyway.
    known = clauses.join(term_stats, ["field", "term"]).join(F.broadcast(field_stats), "field")  # one row a field
    weights = known.groupBy("query_id", "avgdl").agg(
        F.sum(idf(F.col("n_docs"), F.col("df"))).alias("idf"))
    freq = starts.groupBy("query_id", "doc_id", "dl").agg(F.count("*").alias("freq"))
    return freq.join(broadcast_at_most(weights, len(phrases)), "query_id").select(
        "query_id", "doc_id", "freq",
        F.round(F.col("idf") * tf_norm(F.col("freq"), F.col("dl"), F.col("avgdl")), 6).alias("score"))


# ---------------------------------------------------------------- filters and hit tables

def match_all(articles: DataFrame, size: int = DEFAULT_SIZE, key: str = "doc_id") -> DataFrame:
    """The first documents by key, all with score 1."""
    return articles.select(F.col(key), F.lit(1.0).alias("score")).orderBy(key).limit(size)


def match_date(articles: DataFrame, column: str, day: str) -> DataFrame:
    return articles.where(F.col(column) == F.lit(day).cast("date"))


def match_date_text(articles: DataFrame, column: str, day: str) -> DataFrame:
    """Older behaviour: the date column is text and its parts must be adjacent in it."""
    wanted = analyze_standard(F.lit(day.replace("-", " ")))
    found = analyze_standard(F.regexp_replace(F.col(column), "-", " "))
    text = F.concat(F.lit(" "), F.array_join(found, " "), F.lit(" "))
    return articles.where(F.contains(text, F.concat(F.lit(" "), F.array_join(wanted, " "), F.lit(" "))))


def date_range(articles: DataFrame, column: str, gte: str | None = None, lte: str | None = None) -> DataFrame:
    """Closed range; null dates never match."""
    rows = articles.where(F.col(column).isNotNull())
    if gte is not None:
        rows = rows.where(F.col(column) >= F.lit(gte).cast("date"))
    if lte is not None:
        rows = rows.where(F.col(column) <= F.lit(lte).cast("date"))
    return rows


def field_exists(articles: DataFrame, column: str) -> DataFrame:
    return articles.where(F.col(column).isNotNull())


def must_not_equal(articles: DataFrame, column: str, value: str) -> DataFrame:
    """Drop rows whose whole value equals `value`; rows with null stay."""
    return articles.where(~F.col(column).eqNullSafe(value))


def with_source(hits: DataFrame, articles: DataFrame, columns: Sequence[str], key: str = "doc_id",
                at_most: int | None = None) -> DataFrame:
    """Add document columns to hits. Say how many hits there are at most, to let them be the broadcast side."""
    return articles.select(key, *columns).join(hits if at_most is None else broadcast_at_most(hits, at_most), key)


def hit_counts(scored: DataFrame) -> DataFrame:
    """Number of documents per query."""
    return scored.groupBy("query_id").agg(F.count("*").alias("n_hits"))
