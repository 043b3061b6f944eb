import itertools
import os
import random
from collections import Counter

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lexiquarry.operators import index as ix
from lexiquarry.operators import search as se
from lexiquarry.operators import stored as st
from test_search import FIELDS, FUZZY, QUERIES, SCHEMA, brute_force, make_words, scores

PHRASES = {"p": ("pr_abstract", "fever fever"), "q": ("pr_abstract", "mask dogs cough"), "r": ("pr_title", "spread"),
           "none": ("pr_title", "fever unheard"), "empty": ("pr_title", "?!")}
EVERY = [*QUERIES, *FUZZY, se.MatchQuery("all", "fever mask dog cough spread", FIELDS, size=1500)]


def phrase_rows(index, spark):
    return sorted(map(tuple, se.match_phrase(index, PHRASES, spark).collect()))


def hit_rows(index, spark, queries=EVERY):
    return sorted((r.query_id, r["rank"], r.doc_id, round(r.score, 9)) for r in se.search(index, queries, spark).collect())


def assert_same(stored, words, spark, whole=False):
    """The stored index answers as a live one over the same words does."""
    live = ix.LiveIndex(words.cache(), ("publish_time",))
    if whole:
        assert scores(se.multi_match(stored, EVERY, spark)) == scores(se.multi_match(live, EVERY, spark))
    assert hit_rows(stored, spark) == hit_rows(live, spark)
    if not whole:
        return
    assert phrase_rows(stored, spark) == phrase_rows(live, spark)
    counted = lambda i: sorted(map(tuple, i.vocabulary().collect()))
    assert counted(stored) == counted(live)
    stats = {r.field: (r.n_docs, round(r.avgdl, 9)) for r in stored.field_stats().collect()}
    assert stats == {r.field: (r.n_docs, round(r.avgdl, 9)) for r in ix.field_stats(ix.doc_stats(words)).collect()}
    assert stored.doc_stats().count() == ix.doc_stats(words).count()


def test_upserts_deletions_and_compaction_equal_an_index_built_anew(spark, tmp_path):
    path = str(tmp_path / "index")
    rows, _ = make_words(spark, n_docs=60)
    later, _ = make_words(spark, seed=2, n_docs=80)
    frame = lambda rs: spark.createDataFrame(rs, SCHEMA)
    stored = st.write_index(frame(rows), path, ("publish_time",), rows_per_bucket=300, docs_per_block=4)
    assert stored.manifest.buckets > 1 and stored.manifest.n_blocks > 1
    fresh = [r for r in later if r[0] % 10 == 3 or r[0] >= 60]  # 6 replaced, 20 new
    stored = st.upsert(stored, frame(fresh))
    now = [r for r in rows if r[0] % 10 != 3] + fresh
    assert_same(stored, frame(now), spark)

    again = [(d, f, ["fever", "newword"], day) for d, f, _, day in later if d in (3, 7)]  # 3 for the second time
    stored = st.upsert(stored, frame(again))
    stored = st.delete_documents(stored, spark.createDataFrame([(5,), (63,), (999,)], "doc_id int"))
    now = [r for r in now if r[0] not in (3, 5, 7, 63)] + again
    assert_same(stored, frame(now), spark, whole=True)
    assert stored.manifest.n_retired == (0, 6, 2, 2)

    merged = st.compact(stored, docs_per_block=16)
    assert len(merged.manifest.segments) == 1
    assert_same(merged, frame(now), spark, whole=True)
    old = scores(se.multi_match(st.open_index(spark, path, 1), QUERIES[:1], spark))["plain"]  # old versions stay
    assert old == pytest.approx(brute_force(rows, QUERIES[0]), abs=2e-6)
    assert st.versions(spark, path) == [1, 2, 3, 4, 5]


def test_readers_see_the_old_index_while_a_writer_dies(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "index")
    rows, words = make_words(spark)
    st.write_index(words, path, ("publish_time",))
    other, other_words = make_words(spark, seed=3)
    for step in ("_write_pairs", "_publish", "_best_pairs"):
        with monkeypatch.context() as broken:
            broken.setattr(st, step, lambda *a, **k: (_ for _ in ()).throw(OSError("the writer died")))
            with pytest.raises(OSError):
                st.write_index(other_words, path, ("publish_time",))
        stored = st.open_index(spark, path)
        assert stored.manifest.version == 1
        assert scores(se.multi_match(stored, QUERIES, spark))["plain"] == pytest.approx(brute_force(rows, QUERIES[0]), abs=2e-6)
    # Also while the manifest itself is being written.
    os.makedirs(tmp_path / "index" / "manifests" / "000000002-dead" / "_temporary" / "0")
    (tmp_path / "index" / "manifests" / "000000002-dead" / "_temporary" / "0" / "part-0.json").write_text('{"version"')
    assert st.open_index(spark, path).manifest.version == 1
    stored = st.write_index(other_words, path, ("publish_time",))
    assert stored.manifest.version == st.open_index(spark, path).manifest.version == 2
    assert scores(se.multi_match(stored, QUERIES, spark))["plain"] == pytest.approx(brute_force(other, QUERIES[0]), abs=2e-6)


def test_clashing_writers_are_found(spark, tmp_path):
    path = str(tmp_path / "index")
    stored = st.write_index(make_words(spark)[1], path, ("publish_time",))
    with pytest.raises(RuntimeError):
        st._publish(spark, path, stored.manifest)
    with pytest.raises(FileNotFoundError):
        st.open_index(spark, str(tmp_path / "nowhere"))


def test_odd_tables(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id string, field string, words array<string>, publish_time date")
    stored = st.write_index(empty, str(tmp_path / "empty"), ("publish_time",))
    assert hit_rows(stored, spark) == [] and phrase_rows(stored, spark) == [] and stored.vocabulary().count() == 0
    rows = [("a", "t", None, None), ("b", "t", [], None), ("c", "t", ["x"], None), ("d", "t", ["x", "y", "x" * 50_000], None)]
    stored = st.upsert(stored, spark.createDataFrame(rows, empty.schema))
    query = se.MatchQuery("q", "x y", {"t": 1.0})
    assert [r[2] for r in hit_rows(stored, spark, [query])] == ["d", "c"]
    assert hit_rows(st.delete_documents(stored, spark.createDataFrame([("d",)], "doc_id string")), spark, [query])[0][2] == "c"


def skewed(spark, n_docs=3000):
    """One word in nearly every document, and rare words in few."""
    rng = random.Random(9)
    rows = []
    for d in range(n_docs):
        words = ["of", "the"] * rng.randint(1, 6) + [rng.choice("abcdefgh") * 3 for _ in range(rng.randint(3, 40))]
        rng.shuffle(words)
        rows.append((d, "t", words + (["rare"] * rng.randint(1, 4) if d % 97 == 0 else []), None))
    return rows, spark.createDataFrame(rows, SCHEMA)


def test_second_pass_reads_only_blocks_that_can_win(spark, tmp_path):
    rows, words = skewed(spark)
    stored = st.write_index(words, str(tmp_path / "index"), ("publish_time",), docs_per_block=8)
    live = ix.LiveIndex(words, ("publish_time",))
    queries = [se.MatchQuery("common", "of the aaa", {"t": 1.0}), se.MatchQuery("mixed", "the rare", {"t": 2.0}, size=5),
               se.MatchQuery("deep", "of bbb", {"t": 1.0}, size=1100), se.MatchQuery("two", "of rare", {"t": 1.0}, minimum_should_match=2)]
    hits, report = se.search_blocks(stored, queries, spark)
    got = sorted((r.query_id, r["rank"], r.doc_id, round(r.score, 9)) for r in hits.collect())
    assert got == hit_rows(live, spark, queries)
    read = {r.query_id: (r.blocks_read, r.blocks) for r in report.collect()}
    assert read["mixed"][0] < 0.25 * read["mixed"][1] and read["two"][0] <= read["two"][1] <= 40
    assert read["common"][0] < read["common"][1]


def test_phrases_of_frequent_words_read_their_pairs(spark, tmp_path):
    rows, words = skewed(spark)
    stored = st.write_index(words, str(tmp_path / "index"), ("publish_time",))
    phrases = {"of the": ("t", "of the"), "three": ("t", "of the aaa"), "rare": ("t", "rare rare"), "mixed": ("t", "the rare")}
    got = {(r.query_id, r.doc_id): r.freq for r in se.match_phrase(stored, phrases, spark).collect()}
    want = Counter()
    for d, _, ws, _ in rows:
        for name, (_, text) in phrases.items():
            p = text.split()
            n = sum(ws[i:i + len(p)] == p for i in range(len(ws) - len(p) + 1))
            if n:
                want[name, d] = n
    assert got == want
    live = se.match_phrase(ix.LiveIndex(words, ("publish_time",)), phrases, spark)
    assert sorted(map(tuple, live.collect())) == sorted(map(tuple, se.match_phrase(stored, phrases, spark).collect()))
    elements = spark.createDataFrame([("t", "of the"), ("t", "of"), ("t", "the")], "field string, term string")
    read = {r.term: r.n for r in stored.elements(elements).groupBy("term").agg(F.sum(F.size("positions")).alias("n")).collect()}
    assert 3 * read["of the"] < read["of"] + read["the"]


def test_phrase_elements():
    assert se.phrase_elements(["of", "the"], {"of"}) == [(0, "of the")]
    assert se.phrase_elements(["the", "and", "of"], {"the", "and", "of"}) == [(0, "the and"), (1, "and of")]
    assert se.phrase_elements(["a", "b", "the", "c", "d"], {"the"}) == [(0, "a"), (1, "b the"), (2, "the c"), (4, "d")]
    assert se.phrase_elements(["the"], {"the"}) == [(0, "the")] and se.phrase_elements([], {"x"}) == []


def test_a_batch_of_many_queries(spark, tmp_path):
    """One plan, no hint above its bound, and the folders of other terms are pruned."""
    rows, words = make_words(spark)
    stored = st.write_index(words, str(tmp_path / "index"), ("publish_time",), rows_per_bucket=100)
    base = [se.MatchQuery(f"q{i}", QUERIES[i % 4].text, FIELDS, minimum_should_match=QUERIES[i % 4].minimum_should_match,
                          between=QUERIES[i % 4].between) for i in range(20_000)]
    found = se.multi_match(stored, base, spark).where("query_id in ('q0', 'q1', 'q2', 'q19999')")
    got = scores(found)
    for i in (0, 1, 2, 19999):
        assert got[f"q{i}"] == pytest.approx(brute_force(rows, QUERIES[i % 4]), abs=2e-6)
    one = se.multi_match(stored, QUERIES[:1], spark)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()


def test_bounds_are_checked_before_a_broadcast(spark):
    from lexiquarry.session import broadcast_at_most, size_in_bytes
    assert [size_in_bytes(t) for t in ("-1", "10485760b", "10MB", "2g", "100")] == [-1, 10485760, 10 << 20, 2 << 30, 100]
    hinted = lambda n: "broadcast" in broadcast_at_most(spark.range(3), n)._jdf.queryExecution().logical().toString().lower()
    assert hinted(10) and not hinted(10**9)


def test_missing_pieces_are_reported(spark, tmp_path):
    """A segment that someone removed is an error, not an empty answer."""
    path = str(tmp_path / "index")
    stored = st.write_index(make_words(spark)[1], path, ("publish_time",))
    os.rename(f"{path}/segments/{stored.manifest.segments[0]}", f"{path}/gone")
    with pytest.raises(PySparkException):
        hit_rows(st.open_index(spark, path), spark)


def test_postings_are_made_without_a_shuffle(spark):
    rows = [(1, "a", ["x", "y", None, "x"], 7), (2, "a", [], 8), (3, "b", None, 9), (4, "b", ["z"], None)]
    words = spark.createDataFrame(rows, "doc_id long, field string, words array<string>, day int")
    made = st._document_postings(words, ["day"])
    assert "Exchange" not in made._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, made.collect())) == sorted(map(str, ix.build_postings(words, ["day"], positions=True).collect()))


def test_best_pairs_of_blocks(spark, tmp_path):
    rng = random.Random(5)
    rows = [(0, "a", f"t{rng.randint(0, 40)}", rng.randint(0, 3), rng.randint(1, 6), rng.randint(1, 9)) for _ in range(3000)]
    st._best_pairs(spark.createDataFrame(rows, "bucket int, field string, term string, block int, tf long, dl long"), str(tmp_path / "best"))
    blocks = {}
    for _, _, term, block, tf, dl in rows:
        blocks.setdefault((term, block), set()).add((tf, dl))
    want = {k: sorted(x for x in v if not any(y != x and y[0] >= x[0] and y[1] <= x[1] for y in v)) for k, v in blocks.items()}
    found = spark.read.parquet(str(tmp_path / "best")).collect()
    assert len(found) == len(want) and {(r.term, r.block): sorted(map(tuple, r.best)) for r in found} == want


def test_postings_and_pairs_are_made_once_and_keys_are_not_shuffled(spark, tmp_path, monkeypatch):
    made, real = spark.sparkContext.accumulator(0), st._document_postings

    def counted(words, attributes):
        def run(batches):
            for batch in batches:
                made.add(batch.num_rows)
                yield batch
        found = real(words, attributes)
        return found.mapInArrow(run, found.schema)

    monkeypatch.setattr(st, "_document_postings", counted)
    rows, words = make_words(spark)
    stored = st.write_index(words, str(tmp_path / "index"), ("publish_time",), rows_per_bucket=300)
    written = sum(stored.segment_table(stored.manifest.segments[0], t).count() for t in ("postings", "pairs"))
    assert stored.manifest.buckets > 1 and made.value == written > 0
    # Keys of a term lie together, as its file was written.
    files = stored.segment_table(stored.manifest.segments[0], "neighbours")
    runs = files.rdd.mapPartitions(lambda rs: [sum(1 for _ in itertools.groupby(rs, lambda r: (r.field, r.term)))]).sum()
    assert runs == files.select("field", "term").distinct().count()


def test_files_of_a_bucket_share_its_blocks(spark, tmp_path):
    rows, words = make_words(spark)
    stored = st.write_index(words, str(tmp_path / "index"), ("publish_time",), docs_per_block=4)
    postings = stored.segment_table(stored.manifest.segments[0], "postings").withColumn("file", F.input_file_name())
    assert postings.select("file").distinct().count() > 1
    assert postings.select("bucket", "block", "file").distinct().count() == postings.select("bucket", "block").distinct().count()
