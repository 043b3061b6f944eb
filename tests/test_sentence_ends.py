import math

import pytest

from lexiquarry.operators import sentence_ends as sn

TEXTS = ["As shown by Li et al. 2020 masks help. Dr. Wu agrees. It works.", "Wang et al. 2021 found more. Help came. They work by day.",
         "See Sun et al. 2019 and U.S. data. We work. So Dr. Ho says, e.g. in winter. It helps", None, "", "Only al."]


def table(spark, texts=TEXTS):
    return spark.createDataFrame([(i, "t", t) for i, t in enumerate(texts)], "doc_id long, field string, text string")


def test_scores_follow_the_definition(spark):
    fields = table(spark, TEXTS * 5)
    counts = {r.word: (r.n_stop, r.n_plain) for r in sn.stop_counts(fields).collect()}
    assert counts["al"] == (20, 0) and counts["work"] == (5, 5) and counts["u.s"] == (5, 0) and "2020" not in counts
    stops, words = sum(a for a, _ in counts.values()), sum(a + b for a, b in counts.values())
    p = stops / words
    for r in sn.score_abbreviations(sn.stop_counts(fields)).collect():
        a, b = counts[r.word]
        letters = len(r.word.replace(".", ""))
        ratio = -2 * (a * math.log(p) + b * math.log(1 - p) - a * math.log(0.99) - b * math.log(0.01))
        want = ratio * math.exp(-letters) * (r.word.count(".") + 1) * letters ** -b
        assert r.score == pytest.approx(want, abs=1e-8)


def test_stops_of_abbreviations_end_no_sentence(spark):
    fields = table(spark)
    known = sn.abbreviations(sn.score_abbreviations(sn.stop_counts(table(spark, TEXTS * 5))))
    assert {"al", "dr"} <= {r.word for r in known.collect()} and "work" not in {r.word for r in known.collect()}
    got = {r.doc_id: r.sentences for r in sn.split_sentences(fields, known).collect()}
    assert got[0][0] == "as shown by li et al. 2020 masks help." and got[0][1] == "dr. wu agrees."
    assert got[1][0] == "wang et al. 2021 found more."
    assert (got[3], got[4], got[5]) == (None, [], ["only al."])
    nothing = {r.doc_id: r.sentences for r in sn.split_sentences(fields, known.limit(0)).collect()}
    assert nothing[1][:2] == ["wang et al.", "2021 found more."]
