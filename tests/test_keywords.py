import math
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexiquarry.operators import keywords as kw
from lexiquarry.operators import lemmatize as lm
from lexiquarry.operators import matching as ma
from lexiquarry.operators import normalize as nz
from lexiquarry.operators import textrank as tr
from lexiquarry.operators import tfidf as ti
from lexiquarry.plans import pipelines as pl
from lexiquarry.session import stage_dir


def random_documents(seed, n_docs=6, letters="abcde", size=40):
    rng = random.Random(seed)
    words = [a + b + c for a in letters[:3] for b in letters[:3] for c in letters[:2]]
    return {d: [" ".join(rng.choice(words) for _ in range(rng.randint(0, size)))
                for _ in range(rng.randint(1, 4))] for d in range(n_docs)}


def test_ngrams_stay_in_their_document(sentence_table):
    table = sentence_table({1: ["a b", "c"], 2: ["a b", ""], 3: ["x"]})
    bigrams = {(r.w1, r.w2): r.n for r in kw.ngram_counts(table, 2).collect()}
    assert bigrams == {("a", "b"): 2, ("b", "c"): 1}
    assert [tuple(r) for r in kw.ngram_counts(table, 3).collect()] == [("a", "b", "c", 1)]
    assert kw.ngram_counts(table, 2, 2).count() == 1


def test_pmi_by_hand(sentence_table):
    table = sentence_table({1: ["a b a b a b c"]})
    scores = {r.gram: r.pmi for r in kw.bigram_pmi(table, 2).collect()}
    assert scores["a b"] == pytest.approx(math.log2(3 * 7) - math.log2(9))
    assert scores["b a"] == pytest.approx(math.log2(2 * 7) - math.log2(9))
    assert set(scores) == {"a b", "b a"}


def test_frequent_dictionary_and_trigram_option(sentence_table):
    table = sentence_table({1: ["aa bb cc " * 8]})
    plain = {r.phrase: r.clean for r in kw.frequent_dictionary(table).collect()}
    assert plain["aa bb"] == "aa_bb" and "aa bb cc" not in plain
    more = {r.phrase for r in kw.frequent_dictionary(table, include_trigrams=True).collect()}
    assert "aa bb cc" in more


def leftmost_longest(words, phrases, longest):
    found, i = [], 0
    while i < len(words):
        for k in range(min(longest, len(words) - i), 0, -1):
            if " ".join(words[i:i + k]) in phrases:
                found.append((i, k))
                i += k
                break
        else:
            i += 1
    return found


@pytest.mark.parametrize("size", [12, 300])
def test_matches_against_brute_force(spark, sentence_table, size):
    documents = random_documents(7, size=size)
    rng = random.Random(3)
    words = [w for ss in documents.values() for s in ss for w in s.split()]
    phrases = {" ".join(words[i:i + k]) for k in (1, 2, 3, 5) for i in rng.sample(range(len(words) - 5), 25)}
    rows = [(s, p, p.replace(" ", "_")) for s in ma.SOURCES for p in phrases if s == "textrank" or len(p) < 8]
    dictionary = spark.createDataFrame(rows, "source string, phrase string, clean string")
    got = sorted((r.doc_id, r.sent_no, r.source, r.start, r.n_words) for r in
                 ma.keyword_matches(sentence_table(documents), dictionary).collect())
    want = sorted(
        (d, n, s, i, k) for d, ss in documents.items() for n, sentence in enumerate(ss) for s in ma.SOURCES
        for i, k in leftmost_longest(sentence.split(), {r[1] for r in rows if r[0] == s}, 5))
    assert got == want and got


def test_overlap_fixture(spark, sentence_table):
    """Spans (0,2) (1,3) (2,1) (3,1) (5,1) keep (0,2) (2,1) (3,1) (5,1); longest wins at one start."""
    phrases = ["a b", "b c d", "c", "d", "f"]
    dictionary = spark.createDataFrame(
        [("frequent", p, p) for p in phrases], "source string, phrase string, clean string")
    table = sentence_table({1: ["a b c d e f"], 2: ["c f g"]})
    got = sorted((r.doc_id, r.start, r.n_words) for r in ma.keyword_matches(table, dictionary, 3).collect())
    assert got == [(1, 0, 2), (1, 2, 1), (1, 3, 1), (1, 5, 1), (2, 0, 1), (2, 1, 1)]


def test_merge_keeps_order_and_repeats(spark, sentence_table):
    rows = [("textrank", "aa", "aa"), ("frequent", "aa", "aa"), ("frequent", "bb cc", "bb_cc"), ("frequent", "dd", "dd")]
    dictionary = spark.createDataFrame(rows, "source string, phrase string, clean string")
    table = sentence_table({1: ["dd aa bb cc aa dd", "zz", "dd aa"], 2: []})
    matched = ma.matched_sentences(table, dictionary, 2)
    merged = {r.doc_id: r.sentences for r in ma.merge_keywords(matched).collect()}
    assert merged == {1: ["aa aa dd bb_cc", "", "aa dd"], 2: []}
    whole = {r.doc_id: r.sentences for r in ma.merge_keyword_sentences(matched).collect()}
    assert whole[1] == ["aa aa", "", "aa", "dd aa bb_cc aa dd", "dd aa"]


def page_rank(words, reach=3, damping=0.85, iterations=20):
    weight = Counter()
    for i, a in enumerate(words):
        for b in words[i + 1:i + 1 + reach]:
            if a != b:
                weight[a, b] += 1
                weight[b, a] += 1
    nodes = sorted(set(words))
    if len(nodes) == 1:
        return {nodes[0]: 1.0}
    out = {a: sum(w for (x, _), w in weight.items() if x == a) for a in nodes}
    rank = dict.fromkeys(nodes, 1 / len(nodes))
    for _ in range(iterations):
        rank = {a: (1 - damping) / len(nodes) + damping * sum(
            rank[b] * w / out[b] for (b, x), w in weight.items() if x == a) for a in nodes}
    return rank


def test_textrank_against_brute_force(sentence_table):
    documents = {**random_documents(11), 90: ["solo solo", "solo"], 91: [""], 92: []}
    got = {}
    for r in tr.rank_words(sentence_table(documents)).collect():
        got.setdefault(r.doc_id, {})[r.word] = r["rank"]
    for doc_id, sentences in documents.items():
        words = " ".join(sentences).split()
        if words:
            assert got[doc_id] == pytest.approx(page_rank(words))
            assert sum(got[doc_id].values()) == pytest.approx(1)
    assert got[90] == {"solo": 1.0} and 91 not in got and 92 not in got


def test_textrank_phrases_against_brute_force(sentence_table):
    documents = random_documents(5)
    got = {(r.doc_id, r.phrase): r.score for r in tr.rank_phrases(sentence_table(documents), 0.0).collect()}
    want = {}
    for doc_id, sentences in documents.items():
        rank = page_rank(" ".join(sentences).split())
        for sentence in sentences:
            run = []
            for word in [*sentence.split(), None]:
                if word is not None and round(rank[word] * len(rank), 6) >= 1:
                    run.append(word)
                    continue
                if run:
                    want[doc_id, " ".join(run)] = math.sqrt(sum(rank[w] for w in run) / len(run))
                run = []
    assert got == pytest.approx(want) and got


def test_tfidf_rows_have_length_one(sentence_table):
    table = sentence_table({1: ["aa bb aa", "x"], 2: ["bb cc"], 3: [""], 4: None})
    rows = ti.tfidf(table).collect()
    lengths = Counter()
    for r in rows:
        lengths[r.doc_id] += r.tfidf ** 2
    assert all(v == pytest.approx(1) for v in lengths.values()) and set(lengths) == {1, 2}
    # Three documents with text: idf(aa) = ln(4 / 2) + 1, idf(bb) = ln(4 / 3) + 1.
    a, b = 2 * (math.log(2) + 1), math.log(4 / 3) + 1
    weight = {(r.doc_id, r.term): r.tfidf for r in rows}
    assert weight[1, "aa"] == pytest.approx(a / math.hypot(a, b))
    assert ("x" not in {r.term for r in rows})


def test_reduce_to_terms(spark, sentence_table):
    table = sentence_table({1: ["aa_bb cc dd", "dd", "cc cc"], 2: ["zz"]})
    terms = spark.createDataFrame([(1, "pr_abstract", "aa_bb"), (1, "pr_abstract", "cc")],
                                  "doc_id long, field string, term string")
    cut = {r.doc_id: r.sentences for r in ti.reduce_to_terms(table, terms).collect()}
    assert cut == {1: ["aa bb cc", "cc cc"], 2: []}
    kept = {r.doc_id: r.sentences for r in ti.reduce_to_terms(table, terms, drop_empty=False).collect()}
    assert kept == {1: ["aa bb cc", "", "cc cc"], 2: [""]}


def test_lemmas(spark, sentence_table):
    known = ["cat", "boxe", "box", "church", "man", "fly", "wolf", "child", "glass", "ho", "hose", "s"]
    lexicon = spark.createDataFrame([(w,) for w in known], "word string")
    words = "cats boxes churches men flies wolves children glasses hoses zebras s cat".split()
    table = spark.createDataFrame([(w,) for w in words], "word string")
    got = {r.word: r.lemma for r in lm.lemmas(table, lexicon).collect()}
    assert got == {"cats": "cat", "boxes": "box", "churches": "church", "men": "man", "flies": "fly",
                   "wolves": "wolf", "children": "child", "glasses": "glass", "hoses": "hose",
                   "zebras": "zebras", "s": "s", "cat": "cat"}
    sentences = sentence_table({1: ["cats flies cats", "", "zebras"]})
    table = lm.lemmas(sentences.select(F.explode(F.split(F.array_join("sentences", " "), " ")).alias("word")), lexicon)
    assert lm.lemmatize_sentences(sentences, table).first().sentences == ["cat fly cat", "", "zebras"]


def test_dictionary_sizes(spark, sentence_table):
    a = spark.createDataFrame([("x",), ("y",), ("x",)], "phrase string")
    got = {r.source: r.n_phrases for r in tr.dictionary_sizes({"a": a, "b": a.limit(1)}).collect()}
    assert got == {"a": 2, "b": 1}


def test_null_documents_stay_null(spark, sentence_table):
    dictionary = spark.createDataFrame([("textrank", "acute respiratory distress syndrome", "ards")],
                                       "source string, phrase string, clean string")
    table = sentence_table({1: ["acute respiratory distress syndrome now"], 2: [], 3: None, 4: ["nothing here"]})
    merged = ma.merge_keywords(ma.matched_sentences(table, dictionary))
    assert {r.doc_id: r.sentences for r in merged.collect()} == {1: ["ards"], 2: [], 3: None, 4: [""]}
    weights = {(r.doc_id, r.term) for r in ti.tfidf(merged).collect()}
    assert weights == {(1, "ards")}
    lemmas = spark.createDataFrame([("nothing", "thing")], "word string, lemma string")
    done = lm.lemmatize_sentences(table, lemmas)
    assert {r.doc_id: r.sentences for r in done.collect()} == {
        1: ["acute respiratory distress syndrome now"], 2: [], 3: None, 4: ["thing here"]}


def test_few_false_spans_leave_a_row_with_a_large_dictionary(spark):
    # 1.5 million phrases set 4.5 million bits, more than half of a table of 2^23.
    phrases = spark.range(1_500_000).selectExpr("concat('x', id, ' y', id) phrase")
    texts = spark.range(200).selectExpr(
        "id doc_id", "'pr_abstract' field", "array(array_join(transform(sequence(1, 100), i -> concat('z', id * 100 + i)), ' ')) sentences")
    assert ma.candidate_spans(texts, ma.phrase_filter(phrases)).count() < 20_000 * 0.02


def test_matched_documents_without_matches_and_null_ones(spark, sentence_table):
    dictionary = spark.createDataFrame([("frequent", "aa", "aa"), ("textrank", "aa", "aa")], "source string, phrase string, clean string")
    table = sentence_table({1: ["zz", "aa aa"], 2: None, 3: [], 4: [""]})
    got = {r.doc_id: r.matched and [tuple(m) for m in r.matched] for r in ma.matched_sentences(table, dictionary).collect()}
    assert got == {1: [(0, [], []), (1, ["aa", "aa"], ["aa", "aa"])], 2: None, 3: [], 4: [(0, [], [])]}


def test_a_block_asks_for_a_phrase_once(spark, sentence_table):
    texts = sentence_table({i: ["aa bb cc", "bb aa bb"] * 50 for i in range(20)})
    phrases = spark.createDataFrame([("aa",), ("aa bb",)], "phrase string")
    rows = ma.candidate_spans(texts.coalesce(1), ma.phrase_filter(phrases)).toPandas()
    asked = rows[rows["phrase"].notna()]
    assert not asked.duplicated(["block", "phrase"]).any() and set(asked["phrase"]) == {"aa", "aa bb"} and len(rows) < 40


def test_matches_do_not_depend_on_the_size_of_blocks(spark, monkeypatch):
    rows = [(i // 2, "pr_abstract", [f"aa w{i % 7} bb aa bb", "", f"w{i % 5} aa bb"][:i % 4] if i % 9 else None) for i in range(60)]
    table = spark.createDataFrame([(None, "pr_abstract", ["aa bb"]), *rows], "doc_id long, field string, sentences array<string>")
    dictionary = spark.createDataFrame([(s, p, p.upper()) for s in ma.SOURCES for p in ("aa bb", "bb aa", "w3", "w4 bb aa bb", "aa")],
                                       "source string, phrase string, clean string")

    def found():
        return (sorted(map(str, ma.keyword_matches(table, dictionary).collect())),
                sorted(map(str, ma.matched_sentences(table, dictionary).collect())))

    whole = found()
    monkeypatch.setattr(ma, "WALK_WORDS", 4)
    monkeypatch.setattr(ma, "SPAN_WORDS", 3)
    assert len(whole[0]) > 60 and len(whole[1]) == 61 and found() == whole


def test_ngrams_normalise_a_text_once(spark):
    texts = spark.createDataFrame([(1, "Aa bb cc. Aa bb"), (2, None), (3, ""), (4, "dd")], "doc_id long, text string")
    counts = kw.ngram_counts(nz.normalize_fields(texts, {"pr_abstract": "text"}), 2)
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE") == 1
    assert {tuple(r) for r in counts.collect()} == {("aa", "bb", 2), ("bb", "cc", 1), ("cc", "aa", 1)}


def test_grams_are_counted_by_blocks_and_dealt_before_they_are_added(spark, sentence_table, monkeypatch):
    rows = {i: None if i % 7 == 0 else [f"aa w{i % 5} bb", "", "aa bb aa"][:i % 4] for i in range(60)}
    table = sentence_table(rows)
    for size in (1, 2, 3):
        words = [" ".join(s).split() for s in rows.values() if s]
        wanted = Counter(tuple(w[i:i + size]) for w in words for i in range(len(w) - size + 1))
        for block in (3, 1 << 20):
            monkeypatch.setattr(kw, "GRAM_WORDS", block)
            assert {tuple(r)[:-1]: r.n for r in kw.ngram_counts(table, size).collect()} == wanted
    # No task holds a map of all grams of its documents: what is shuffled comes from blocks.
    plan = kw.ngram_counts(table, 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("HashAggregate") < plan.index("Exchange") and "HashAggregate" not in plan[plan.index("Exchange"):]


def test_a_large_dictionary_is_hashed_and_blocks_are_dealt_by_rows(spark, sentence_table, monkeypatch):
    table = sentence_table({i: [f"aa w{i % 7} bb", "aa bb"] for i in range(60)})
    dictionary = spark.createDataFrame([(s, p, p.upper()) for s in ma.SOURCES for p in ("aa bb", "w3", "aa")],
                                       "source string, phrase string, clean string")
    small = ma.keyword_matches(table, dictionary)
    monkeypatch.setattr(ma, "WALK_WORDS", 20)
    monkeypatch.setattr(ma, "ROWS_PER_TASK", 10)
    monkeypatch.setattr(ma, "broadcast_limit", lambda _: 0)
    large = ma.keyword_matches(table, dictionary)
    plan = large._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan and large.rdd.getNumPartitions() > 4
    assert sorted(map(str, large.collect())) == sorted(map(str, small.collect()))


def test_tfidf_shuffles_terms_of_blocks_and_keeps_documents_whole(spark, monkeypatch):
    rng = random.Random(4)
    words = ["aa", "bb", "cc", "d", "ee", "ff"]
    rows = [(i // 2, f, None if rng.random() < 0.1 else [" ".join(rng.choices(words[:k], k=rng.randint(0, 9))) for _ in range(rng.randint(0, 3))])
            for i in range(60) for f, k in (("pr_title", 3), ("pr_abstract", 6))]
    table = spark.createDataFrame([(None, "pr_title", ["aa bb"]), *rows], "doc_id long, field string, sentences array<string>")
    rows.append((None, "pr_title", ["aa bb"]))
    n, df, length, wanted = Counter(), Counter(), Counter(), []
    counted = [(d, f, Counter(w for s in texts for w in s.split() if len(w) > 1)) for d, f, texts in rows if texts is not None]
    for _, f, tf in counted:
        n[f] += 1
        df.update((f, t) for t in tf)
    weight = {(f, t): math.log((1 + n[f]) / (1 + k)) + 1 for (f, t), k in df.items()}
    for d, f, tf in counted:
        length[d, f] += sum((k * weight[f, t]) ** 2 for t, k in tf.items())
    for d, f, tf in counted:
        wanted += [(str(d), f, t, k, round(k * weight[f, t] / math.sqrt(length[d, f]), 9)) for t, k in tf.items()]
    for size in (4, 1 << 19):
        monkeypatch.setattr(ti, "TERM_WORDS", size)
        got = ti.tfidf(table)
        assert sorted((str(r.doc_id), r.field, r.term, r.tf, round(r.tfidf, 9)) for r in got.collect()) == sorted(wanted)
    # A term that each of 500 documents has is shuffled once a block, not once a document.
    same = spark.createDataFrame([(i, "pr_abstract", ["aa bb"]) for i in range(500)], table.schema)
    blocks = ti._counted_blocks(same.coalesce(1))
    assert blocks.where("term = 'aa'").count() <= 4 and blocks.where("counts is not null").count() == 500


def test_matches_in_rounds_are_the_same_and_only_one_round_has_its_spans_on_disk(spark, monkeypatch):
    rows = [(i // 2, "pr_abstract", [f"aa w{i % 7} bb aa bb", "", f"w{i % 5} aa bb"][:i % 4] if i % 9 else None) for i in range(60)]
    table = spark.createDataFrame([(None, "pr_abstract", ["aa bb"]), *rows], "doc_id long, field string, sentences array<string>")
    dictionary = spark.createDataFrame([(s, p, p.upper()) for s in ma.SOURCES for p in ("aa bb", "bb aa", "w3", "w4 bb aa bb", "aa")],
                                       "source string, phrase string, clean string")

    def found():
        return (sorted(map(str, ma.keyword_matches(table, dictionary).collect())),
                sorted(map(str, ma.matched_sentences(table, dictionary).collect())))

    whole, asked, real = found(), [], ma.candidate_spans
    folder = f"{stage_dir(spark)}/lexiquarry".removeprefix("file://")

    def on_disk():
        return {t for t in os.listdir(folder) if t.startswith("spans-")}

    def spans(texts, known):
        asked.append((texts.count(), on_disk()))
        return real(texts, known)

    before = on_disk()
    monkeypatch.setattr(ma, "candidate_spans", spans)
    monkeypatch.setattr(ma, "ROUND_BYTES", 10)
    assert found() == whole
    assert len(asked) == 2 * ma.MOST_ROUNDS and sum(n for n, _ in asked) == 2 * 61
    assert all(tables == before for _, tables in asked) and on_disk() == before


def test_grams_of_a_block_leave_as_one_row_a_part(spark, sentence_table):
    table = sentence_table({i: [f"aa w{i % 50} bb", "aa bb aa"] for i in range(200)})
    blocks = kw._block_grams(table.coalesce(1), 2, 4).collect()
    assert len(blocks) == 4 and {r.part for r in blocks} == {0, 1, 2, 3}
    for r in blocks:
        grams = r.grams.split("  ")
        assert grams == sorted(grams) and len(set(grams)) == len(grams) == len(r.counts)
    assert sum(sum(r.counts) for r in blocks) == 200 * 5


def test_system1_words_leaves_none_of_the_tables_of_its_steps(spark):
    folder = f"{stage_dir(spark)}/lexiquarry".removeprefix("file://")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    articles = spark.createDataFrame([(i, "Acute fever of dogs", f"Dogs bark at w{i % 3} cats. Cats run far.", None) for i in range(8)],
                                     "doc_id long, title string, abstract string, publish_time date")
    words = pl.system1_words(articles)
    left = {t.split("-")[0] for t in set(os.listdir(folder)) - before}
    assert left == {"lexicon", "selected", "lemmas", "changes"} and words.count() == 16
