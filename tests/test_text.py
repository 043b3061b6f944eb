import datetime

import pytest
from pyspark.sql import functions as F

from lexiquarry.functions import text as tx
from lexiquarry.functions.fixed import ascii_spellings
from lexiquarry.functions.porter import stem_word


def one(spark, value, expression):
    frame = spark.createDataFrame([(value,)], "t string")
    return frame.select(expression(F.col("t")).alias("r")).first().r


@pytest.mark.parametrize(("raw", "want"), [
    ("Covid-19 is HERE.  Stay home!", ["covid is here", "stay home"]),
    ("a\\b c[d]e *f", ["a\\b c d e f"]),
    ("I cannot, gonna gotta gimme lemme wanna go", ["i can not gon na got ta gim me lem me wan na go"]),
    ("scannotx canna", ["scannotx canna"]),
    ("Straße Œuvre naïve β-test ЩИ", ["strasse oeuvre naive b test shchi"]),
    ("One…two—three “four”", ["one two three four"]),
    ("Dots... next? Yes!! 12 34.", ["dots", "next", "yes", ""]),
    ("tab\tand\nbreak", ["tab and break"]),
    ("signi\ufb01cant di\ufb00erence \uff21\uff22\uff23", ["significant difference abc"]),
    ("\u0451\u043b\u043a\u0430 \u03ac\u03bb\u03c6\u03b1 \u4e2d\u6587", ["elka alpha \u4e2d\u6587"]),
    ("end. ", ["end"]),
    ("   ", []),
    (None, None),
])
def test_normalize_sentences(spark, raw, want):
    assert one(spark, raw, tx.normalize_sentences) == want


def test_flat_words_agree_with_sentences(spark):
    raw = "One. Two cannot! Straße 5 ### x_y. ..."
    flat = one(spark, raw, tx.normalized_words)
    nested = one(spark, raw, lambda c: tx.flat_words(tx.normalize_sentences(c)))
    assert flat == nested == ["one", "two", "can", "not", "strasse", "x", "y"]


def test_split_sentences_keeps_signs(spark):
    assert one(spark, "A  b, c! D?\nE.", tx.split_sentences) == ["a b, c!", "d?", "e."]


def test_sentence_records(spark):
    records = one(spark, "Ab cd. Ef", lambda c: tx.sentence_records(tx.normalize_sentences(c)))
    assert [(r.tokens, r.sentence) for r in records] == [(["ab", "cd"], "ab cd"), (["ef"], "ef")]


def test_drop_stop_words(spark):
    got = one(spark, "The virus is in it. We do.", lambda c: tx.drop_stop_words(tx.normalize_sentences(c)))
    assert got == ["virus", ""]


@pytest.mark.parametrize(("raw", "want"), [
    ("It's e.g. U.S.A. now", ["it's", "e.g", "u.s.a", "now"]),
    ("3.14 a.1 1,000 covid-19", ["3.14", "a", "1", "1,000", "covid", "19"]),
    ("don’t x_y, the END.", ["don’t", "x_y", "the", "end"]),
    ("", []),
])
def test_analyze_standard(spark, raw, want):
    assert one(spark, raw, tx.analyze_standard) == want


@pytest.mark.parametrize(("raw", "want"), [
    ("2020-01-05", datetime.date(2020, 1, 5)), ("2020-1-5", datetime.date(2020, 1, 5)),
    ("2020", None), ("2020-02-30", None), ("abc", None), (None, None)])
def test_valid_date(spark, raw, want):
    assert one(spark, raw, tx.valid_date) == want


def test_spellings_are_ascii():
    source, target, longer = ascii_spellings()
    assert len(source) == len(target)
    assert all(ord(c) < 128 for c in target) and all(s.isascii() for s in longer.values())
    assert not set(source) & set(longer)


@pytest.mark.parametrize(("word", "stem"), [
    ("effectiveness", "effect"), ("diabetes", "diabet"), ("influence", "influenc"), ("ponies", "poni"),
    ("hopping", "hop"), ("falling", "fall"), ("sky", "sky"), ("generalizations", "gener"), ("is", "is"),
    ("agreed", "agre"), ("feed", "feed"), ("controlling", "control"), ("adoption", "adopt")])
def test_stem_word(word, stem):
    assert stem_word(word) == stem
