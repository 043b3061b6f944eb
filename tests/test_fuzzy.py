import random

import pytest
from pyspark.sql import functions as F

from lexiquarry.operators import fuzzy as fz
from test_search import distance


def nearest(words, query, edits):
    found = sorted((distance(query, w), w) for w in words if abs(len(w) - len(query)) <= edits)
    return [(w, d, pytest.approx(1 - d / min(len(w), len(query)))) for d, w in found if d <= edits][:fz.MAX_EXPANSIONS]


def invented(rng, n, letters="abc"):
    return "".join(rng.choice(letters) for _ in range(n))


def edited(rng, word, n):
    for _ in range(n):
        i = rng.randrange(len(word))
        kind = rng.randrange(4)
        word = (word[:i] + rng.choice("xabc") + word[i + (kind == 0):] if kind < 2 else word[:i] + word[i + 1:] if kind == 2
                else word[:i] + word[i:i + 2][::-1] + word[i + 2:])
    return word or "a"


def expanded(spark, words, asked):
    vocabulary = spark.createDataFrame([("t", w) for w in words] + [("other", "unrelated")], "field string, term string")
    rows = [{"field": "t", "query_term": q, "max_edits": d} for q, d in asked]
    got = {}
    for r in fz.fuzzy_expand(vocabulary, fz.fuzzy_terms(spark, rows)).collect():
        got.setdefault((r.query_term, r.max_edits), []).append((r.dist, r.term, r.weight))
    return {k: [(w, d, x) for d, w, x in sorted(v)] for k, v in got.items()}


def test_expansions_equal_brute_force(spark):
    rng = random.Random(4)
    words = {invented(rng, rng.randint(1, 7)) for _ in range(700)} | {"teh", "the", "abc", "ca", "acb", "bac", "é", "ée"}
    asked = [(q, d) for q in [*rng.sample(sorted(words), 25), "ca", "abc", "hte", "eé", "zzzzzz"] for d in (1, 2)]
    asked = list(dict.fromkeys(asked))
    got = expanded(spark, words, asked)
    for key in asked:
        assert got.get(key, []) == nearest(words, *key), key


def test_long_words_meet_on_their_pieces(spark):
    rng = random.Random(5)
    base = [invented(rng, n, "abcdefghij") for n in (37, 38, 39, 40, 41, 42, 43, 60, 150) for _ in range(2)]
    words = set(base) | {edited(rng, w, rng.randint(1, 3)) for w in base for _ in range(9)}
    got = expanded(spark, words, [(w, 2) for w in base])
    for w in base:
        assert got[w, 2] == nearest(words, w, 2)


def test_distances_equal_brute_force(spark):
    rng = random.Random(6)
    pairs = [(invented(rng, rng.randint(1, 6)), invented(rng, rng.randint(1, 6))) for _ in range(400)]
    pairs += [(w, edited(rng, w, 2)) for w in (invented(rng, 9, "abcdef") for _ in range(200))]
    frame = spark.createDataFrame(pairs, "a string, b string").select(
        "a", "b", fz.alignment_distance(F.col("a"), F.col("b")).alias("whole"), fz.edit_distance(F.col("a"), F.col("b")).alias("near"))
    for r in frame.collect():
        d = distance(r.a, r.b)
        assert r.whole == d if d <= 2 else r.whole > 2, (r.a, r.b)
        assert r.near == d if d <= 2 else r.near is None or r.near > 2, (r.a, r.b)


def test_candidates_meet_by_equal_keys_only(spark):
    vocabulary = spark.createDataFrame([("t", "word")], "field string, term string")
    terms = fz.fuzzy_terms(spark, [{"field": "t", "query_term": "wrod", "max_edits": 1}])
    plan = fz.meet(fz.neighbour_keys(vocabulary), terms)._jdf.queryExecution().optimizedPlan().toString()
    join = next(line for line in plan.splitlines() if "Join" in line)
    assert "key" in join and "length" not in join


def test_keys_of_a_word_do_not_grow_with_its_length(spark):
    words = [("t", "abcdefghijklmnopqrstuvwxyz"[:n]) for n in (7, 9, 12, 26)] + [("t", "abcde" * 8)]
    made = fz.neighbour_keys(spark.createDataFrame(words, "field string, term string")).groupBy("term").count().collect()
    assert len(made) == 5 and all(r["count"] <= 22 for r in made)


def test_words_meet_whatever_the_place_of_the_edits(spark):
    rng = random.Random(8)
    base = [invented(rng, n, "abcd") for n in (5, 6, 7, 8, 9, 14) for _ in range(3)]
    words = set(base) | {edited(rng, w, rng.randint(1, 3)) for w in base for _ in range(40)}
    asked = [(w, d) for w in base for d in (1, 2)]
    got = expanded(spark, words, asked)
    for key in dict.fromkeys(asked):
        assert got[key] == nearest(words, *key), key
