"""The pipeline's stages on the smallest tables, against what each stage's operator says about its own input."""

from collections import Counter

import corpus_pipeline
from lexiquarry.llm import decontaminate as dc
from lexiquarry.llm import ngram_join as nj
from lexiquarry.llm import substring_chain as sc
from lexiquarry.llm import stages
from lexiquarry.llm.storage import settle

from .conftest import invented

SMALL = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(settle(stage(spark, seen[-1], SMALL), name))
    raw, civil, single, cut, clean, tokens = seen
    assert [s.columns for s in seen[:5]] == [COLUMNS] * 5
    toxic = {r.doc_id for r in spark.read.parquet(f"{SMALL}/labels.parquet").where("toxic = 0").collect()}
    assert len(toxic & {r.doc_id for r in civil.collect()}) >= 0.97 * len(toxic)  # clean documents stay
    classes = {r.doc_id: r.component_id for r in nj.similarity_classes(civil).collect()}
    assert {r.doc_id for r in single.collect()} == set(classes.values())
    assert sc.repeated_passages(cut).count() == 0 and cut.count() == single.count()
    assert all(len(r.text) == r.n_chars for r in cut.collect())
    benchmark = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    assert dc.find_leaks(clean, benchmark).count() == 0 and clean.count() + dc.find_leaks(cut, benchmark).select("doc_id").distinct().count() == cut.count()
    assert tokens.count() == clean.count()


def test_odd_tables(spark, messy, no_documents):
    bare = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, bare, SMALL).count() == 0
    left = stages.keep_one_of_each_class(spark, messy, SMALL)
    assert sorted((r.doc_id or 0) for r in left.collect()) == [0, 1, 2, 3, 4, 5, 7, 8]
    assert stages.cut_repeated_passages(spark, messy, SMALL).count() == 10
    assert stages.keep_civil(spark, messy, SMALL).columns == messy.columns


def test_different_texts_under_one_id_all_stay(spark):
    docs = spark.createDataFrame([(1, "one text"), (1, "another text"), (1, "one text"), (2, "a third")], "doc_id long, text string")
    left = stages.keep_one_of_each_class(spark, docs, SMALL).collect()
    assert sorted((r.doc_id, r.text) for r in left) == [(1, "another text"), (1, "one text"), (2, "a third")]


def test_texts_under_one_id_are_cut_one_by_one(spark, rng):
    shared, own, other = invented(rng, 80), invented(rng, 20), invented(rng, 100)
    rows = [(1, " ".join(shared)), (2, " ".join(shared + own)), (2, " ".join(other)), (2, None), (None, " ".join(shared))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = stages.cut_repeated_passages(spark, docs, SMALL).collect()
    assert Counter((r.doc_id, r.text) for r in left) == Counter([rows[0], (2, " ".join(own)), *rows[2:]])


def test_cutting_words(spark):
    import pyarrow as pa
    spans = pa.array([[{"start_word": 1, "end_word": 3}, {"start_word": 2, "end_word": 4}]])[0]
    assert stages.without_spans("a b\nc d é f", spans) == "a é f"
    whole = pa.array([[{"start_word": 0, "end_word": 9}]])[0]
    assert stages.without_spans(" a b ", whole).strip() == ""
