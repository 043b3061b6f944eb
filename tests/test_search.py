import datetime
import math
import random
from collections import Counter

import pytest

from lexiquarry.operators import fuzzy as fz
from lexiquarry.operators import index as ix
from lexiquarry.operators import normalize as nz
from lexiquarry.operators import search as se
from lexiquarry.operators import stored as st
from lexiquarry.plans import pipelines as pl
from lexiquarry.session import settle

SCHEMA = "doc_id long, field string, words array<string>, publish_time date"


def make_words(spark, seed=1, n_docs=60):
    rng = random.Random(seed)
    vocabulary = [a + b for a in ("fever", "cough", "mask", "spread", "dog") for b in ("", "s", "y", "x")]
    rows = []
    for d in range(n_docs):
        day = datetime.date(2020, 1, 1) + datetime.timedelta(days=10 * d) if d % 7 else None
        for name, longest in (("pr_title", 5), ("pr_abstract", 30)):
            rows.append((d, name, [rng.choice(vocabulary) for _ in range(rng.randint(0, longest))], day))
    return rows, spark.createDataFrame(rows, SCHEMA)


def distance(a, b):
    """Edits with swaps of neighbours, no place edited twice, by the whole table."""
    d = {}
    for i in range(len(a) + 1):
        for j in range(len(b) + 1):
            if not i or not j:
                d[i, j] = i + j
                continue
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


def brute_force(rows, query):
    """Score of every matching document by the definition."""
    terms = query.text.lower().split()
    best = {}
    for name, boost in query.fields.items():
        docs = {d: w for d, f, w, _ in rows if f == name and w}
        avgdl = sum(map(len, docs.values())) / len(docs)
        df = Counter(t for w in docs.values() for t in set(w))
        clauses = []
        for term in terms:
            edits = fz.allowed_edits(query.fuzziness, term) if query.fuzziness else 0
            near = sorted((distance(term, t), t) for t in df if distance(term, t) <= edits)[:50]
            clauses.append({t: 1 - k / min(len(t), len(term)) for k, t in near})
        need = se.required_matches(query.minimum_should_match, len(terms))
        for d, words in docs.items():
            tf, scores = Counter(words), []
            for clause in clauses:
                top = max((df[t] for t in clause), default=0)
                idf = math.log(1 + (len(docs) - top + 0.5) / (top + 0.5))
                hits = [w * idf * tf[t] / (tf[t] + 1.2 * (0.25 + 0.75 * len(words) / avgdl))
                        for t, w in clause.items() if tf[t]]
                if hits:
                    scores.append(max(hits))
            if len(scores) >= need and scores:
                best[d] = max(best.get(d, 0), boost * sum(scores))
    if query.between:
        days = {d: day for d, _, _, day in rows}
        low, high = (datetime.date.fromisoformat(x) for x in query.between[1:])
        best = {d: s for d, s in best.items() if days[d] and low <= days[d] <= high}
    return best


FIELDS = {"pr_title": 1.0, "pr_abstract": 5.0}
QUERIES = [
    se.MatchQuery("plain", "fever mask dog", FIELDS),
    se.MatchQuery("twice", "fever fever cough", FIELDS),
    se.MatchQuery("half", "fever maskx dogs coughy nothing", FIELDS, minimum_should_match="50%"),
    se.MatchQuery("dated", "spread masks", FIELDS, between=("publish_time", "2020-06-01", "2021-03-01")),
]
FUZZY = [se.MatchQuery("fuzzy", "feverz dag mask of", FIELDS, fuzziness="AUTO", minimum_should_match=2)]


def scores(frame):
    found = {}
    for r in frame.collect():
        found.setdefault(r.query_id, {})[r.doc_id] = r.score
    return found


@pytest.mark.parametrize("queries", [QUERIES, FUZZY])
def test_scores_against_brute_force(spark, queries):
    rows, words = make_words(spark)
    got = scores(se.multi_match(ix.LiveIndex(words, ("publish_time",)), queries, spark))
    for query in queries:
        want = brute_force(rows, query)
        assert want and got[query.query_id] == pytest.approx(want, abs=2e-6)


def test_phrase_counts(spark):
    texts = {1: "a b a b c", 2: "b a", 3: "a a a", 4: "x"}
    words = spark.createDataFrame([(d, "t", w.split(), None) for d, w in texts.items()], SCHEMA)
    phrases = {"ab": ("t", "a b"), "aa": ("t", "a a"), "none": ("t", "a zzz")}
    got = {(r.query_id, r.doc_id): r.freq for r in
           se.match_phrase(ix.LiveIndex(words, ("publish_time",)), phrases, spark).collect()}
    assert got == {("ab", 1): 2, ("aa", 3): 2}


def test_top_hits_sizes_and_ties(spark):
    frame = spark.createDataFrame([(q, d, float(d // 2)) for q in "ab" for d in range(20)],
                                  "query_id string, doc_id long, score double")
    queries = [se.MatchQuery("a", "", {}, size=3), se.MatchQuery("b", "", {}, size=5)]
    got = sorted((r.query_id, r["rank"], r.doc_id) for r in se.top_hits(frame, queries).collect())
    assert got == [("a", 1, 18), ("a", 2, 19), ("a", 3, 16), ("b", 1, 18), ("b", 2, 19), ("b", 3, 16),
                   ("b", 4, 17), ("b", 5, 14)]


@pytest.mark.parametrize("ties", [1, 40, 3000])
def test_large_sizes_are_cut_before_they_are_ranked(spark, ties):
    rng = random.Random(ties)
    rows = [("a", d, float(rng.randrange(3000 // ties + 1))) for d in range(3000)] + [("a", 9000, 1e9)]
    rows += [("b", d, 0.5) for d in range(1500)] + [("c", d, rng.random() ** 9) for d in range(700)]
    frame = spark.createDataFrame(rows, "query_id string, doc_id long, score double").repartition(3)
    sizes = {"a": 1700, "b": 1200, "c": 2500}
    want = {q: sorted(((-s, d) for i, d, s in rows if i == q))[:n] for q, n in sizes.items()}
    got = se.top_hits(frame, [se.MatchQuery(q, "", {}, size=n) for q, n in sizes.items()]).collect()
    for q in sizes:
        assert sorted((r["rank"], r.doc_id) for r in got if r.query_id == q) == [(k, d) for k, (_, d) in enumerate(want[q], 1)]
    assert se.top_hits(frame, 1300).count() == 1300 + 1300 + 700
    kept = se._cut(frame, 1300).where("query_id = 'a'").count()
    assert kept < 3001 or ties == 3000


def test_required_matches_and_edits():
    assert [se.required_matches("50%", n) for n in (1, 2, 3, 5)] == [1, 1, 1, 2]
    assert se.required_matches(None, 4) == 1 and se.required_matches(3, 4) == 3
    assert [fz.allowed_edits("AUTO", "x" * n) for n in (1, 2, 3, 5, 6)] == [0, 0, 1, 1, 2]
    with pytest.raises(ValueError):
        fz.allowed_edits(3, "word")


def test_one_filter_for_batches_of_any_size(spark):
    """The plan of a live lookup does not grow with the batch; words that only share a bit are not scored."""
    rows, words = make_words(spark)
    many = [se.MatchQuery("many", "fever mask " + " ".join(f"w{i}" for i in range(6000)), FIELDS)]
    got = scores(se.multi_match(ix.LiveIndex(words, ("publish_time",)), many, spark))["many"]
    assert got == pytest.approx(brute_force(rows, se.MatchQuery("many", "fever mask", FIELDS)), abs=2e-6)


def test_english_analysis(spark):
    query = se.MatchQuery("q", "The Effectiveness of wearing doctor's masks", {}, analyzer="english")
    assert [t for _, _, t in se.analyze_queries(spark, [query])] == ["effect", "wear", "doctor", "mask"]
    plain = se.MatchQuery("q", "Main symptoms of a Covid-19 disease", {})
    assert [t for _, _, t in se.analyze_queries(spark, [plain])] == [
        "main", "symptoms", "of", "a", "covid", "19", "disease"]


def test_filters(spark):
    rows = spark.createDataFrame(
        [(1, "2020-08-15", "None"), (2, "2020", None), (3, None, "x")], "doc_id long, day string, note string")
    dated = rows.selectExpr("doc_id", "note", "day", "try_to_date(day, 'yyyy-M-d') publish_time")
    assert [r.doc_id for r in se.match_date(dated, "publish_time", "2020-08-15").collect()] == [1]
    assert [r.doc_id for r in se.match_date_text(dated, "day", "2020-08-15").collect()] == [1]
    assert [r.doc_id for r in se.date_range(dated, "publish_time", gte="2020-08-15").collect()] == [1]
    assert [r.doc_id for r in se.field_exists(dated, "note").orderBy("doc_id").collect()] == [1, 3]
    assert [r.doc_id for r in se.must_not_equal(dated, "note", "None").orderBy("doc_id").collect()] == [2, 3]
    assert [(r.doc_id, r.score) for r in se.match_all(dated, 2).collect()] == [(1, 1.0), (2, 1.0)]


def test_stemmed_index(spark):
    texts = {1: "masks mask wearing", 2: "effectiveness", 3: ""}
    words = spark.createDataFrame([(d, "t", w.split(), None) for d, w in texts.items()], SCHEMA)
    stemmed = ix.stem_index_words(words)
    assert {r.doc_id: r.words for r in stemmed.collect()} == {1: ["mask", "mask", "wear"], 2: ["effect"], 3: []}
    query = se.MatchQuery("q", "The effectiveness of a mask", {"t": 1.0}, analyzer="english")
    plain = se.multi_match(ix.LiveIndex(words, ("publish_time",)), [query], spark)
    assert [r.doc_id for r in plain.collect()] == [1]
    both = se.multi_match(ix.LiveIndex(stemmed, ("publish_time",)), [query], spark)
    assert sorted(r.doc_id for r in both.collect()) == [1, 2]


def test_large_batches_and_odd_ids(spark):
    rows, words = make_words(spark)
    live = ix.LiveIndex(words, ("publish_time",))
    batch = [se.MatchQuery(f"q@{i}", QUERIES[i % 4].text, FIELDS, minimum_should_match=QUERIES[i % 4].minimum_should_match,
                           between=QUERIES[i % 4].between, size=3 + i % 2) for i in range(2000)]
    hits = {}
    for r in se.search(live, batch, spark).collect():
        hits.setdefault(r.query_id, []).append((r.doc_id, round(r.score, 5)))
    for i in (0, 1, 2, 3, 1999):
        best = sorted(brute_force(rows, QUERIES[i % 4]).items(), key=lambda p: (-round(p[1], 9), p[0]))[:3 + i % 2]
        assert [s for _, s in hits[f"q@{i}"]] == pytest.approx([s for _, s in best], abs=2e-5)
    with pytest.raises(ValueError):
        se.multi_match(live, [QUERIES[0], QUERIES[0]], spark)


def test_english_queries_need_no_python_worker(spark):
    _, words = make_words(spark)
    query = se.MatchQuery("e", "The fevers and coughs of dogs", FIELDS, analyzer="english")
    assert se.analyze_queries(spark, [query]) == [("e", 0, "fever"), ("e", 1, "cough"), ("e", 2, "dog")]
    plan = se.multi_match(ix.LiveIndex(words, ()), [query], spark)._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "Arrow" not in plan


def test_a_lookup_normalises_a_text_once(spark, monkeypatch):
    texts = spark.createDataFrame([(1, "Aa bb cc. Aa bb"), (2, None), (3, "")], "doc_id long, text string")
    words = nz.index_words(nz.to_fields(texts, {"pr_abstract": "text"}))
    plans = []

    def spy(df, name):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return settle(df, name)

    monkeypatch.setattr(ix, "settle", spy)
    found = ix.LiveIndex(words).lookup(spark.createDataFrame([("pr_abstract", "aa")], "field string, term string"), ["aa"])
    assert [tuple(r) for r in found.field_stats.collect()] == [("pr_abstract", 1, 5.0)]
    assert len(plans) == 1 and plans[0].count("array_remove(split(") == 1


def test_a_batch_makes_the_words_of_both_systems_once(spark, monkeypatch):
    words = spark.createDataFrame([(1, f"{s}.pr_title", ["some", "words"], None) for s in pl.SYSTEMS],
                                  "doc_id long, field string, words array<string>, publish_time date")
    seen = []
    monkeypatch.setattr(pl, "shared_words", lambda articles: words)
    monkeypatch.setattr(pl, "live", lambda rows: seen.append(rows) or ix.LiveIndex(rows, pl.INDEX_ATTRIBUTES))
    hits = pl.batch_search(words, [se.MatchQuery("q", "words", {"pr_title": 1.0})], spark)
    assert [(r.system, r.doc_id) for r in hits.orderBy("system").collect()] == [(s, 1) for s in pl.SYSTEMS]
    assert seen[0].inputFiles() and all("/lexiquarry/words-" in f for f in seen[0].inputFiles())
