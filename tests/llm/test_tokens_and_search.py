"""SentencePiece scan, token files and graph search against the libraries and brute force."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexiquarry.llm import ann_graph as ag
from lexiquarry.llm import queries as qs
from lexiquarry.llm import sentencepiece_scan as sp
from lexiquarry.llm import token_files as tf
from lexiquarry.llm.pieces import Memo
from lexiquarry.llm.queries import table
from lexiquarry.llm.storage import stage_path

from .conftest import SF_DIR, invented

MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
TEXTS = ["", "Hello  world", "a\nb", "Straße über — x 日本語 😀", " lead and trail ", "x" * 700, "1234 5678.,!!"]


def best_score(vocabulary, text):
    """Largest sum of scores by a plain table over all places."""
    pieces = {t.decode().replace(" ", sp.MARK): vocabulary.scores[i] for i, t in enumerate(vocabulary.text_of) if i in vocabulary.scores}
    text = text.replace(" ", sp.MARK)
    best = [0.0] + [-np.inf] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - vocabulary.longest), end):
            piece = text[start:end]
            score = pieces.get(piece, vocabulary.unknown_score if len(piece) == 1 else -np.inf)
            best[end] = max(best[end], best[start] + score)
    return best[-1]


def score_of(vocabulary, ids):
    """Sum of scores of ids; a run of byte pieces of one character counts once."""
    total, held = 0.0, b""
    for i in ids:
        if i in vocabulary.scores:
            total += vocabulary.scores[i]
            continue
        held += vocabulary.text_of[i]
        try:
            held.decode()
        except UnicodeDecodeError:
            continue
        total, held = total + vocabulary.unknown_score, b""
    return total


@pytest.fixture(scope="module")
def encoder():
    return sp.Encoder(MODEL)


def test_best_segmentation(encoder, rng):
    texts = [t and " " + t for t in [*TEXTS, " ".join(invented(rng, 60))]]
    (first, last, ids, bounds), = encoder.rows(pa.array(texts))
    for i, text in enumerate(texts):
        own = ids[bounds[i]:bounds[i + 1]].tolist()
        assert np.isclose(score_of(encoder.vocabulary, own), best_score(encoder.vocabulary, text))
        assert b"".join(encoder.vocabulary.text_of[j] for j in own).decode() == text


@pytest.mark.parametrize("size", [16, 50, 333])
def test_chunks_give_the_ids_of_the_whole_text(encoder, rng, size):
    v = encoder.vocabulary
    for text in [" " + " ".join(invented(rng, 80)), "日本語テキスト漢字" * 20, "a" * 300, "ab" * 150 + "é" * 40]:
        chunks = [text[s:s + size] for s in range(0, len(text), size)]
        ahead = [text[s + size:s + size + v.longest - 1] for s in range(0, len(text), size)]
        opened = [encoder.open_chunk(c, a) for c, a in zip(chunks, ahead, strict=True)]
        matrices = [o[0] for o in opened]
        left, right = sp.product(matrices), matrices[-1]
        for m in matrices[-2::-1]:
            right = sp.product([m, right])
        assert np.array_equal(left, right)
        begin = np.full(v.longest, -np.inf)
        begin[0] = 0
        states = sp.reaches(begin, matrices)
        entries = [encoder.entries(h, t, a, r) for (_, h, _, t), a, r in zip(opened, ahead, states, strict=True)]
        ids = []
        for (_, head, middle, tail), a, r, leave in zip(opened, ahead, states, sp.leaves(entries), strict=True):
            first, last = encoder.ends(head, tail, a, r, leave)
            ids += [*first, *middle.tolist(), *last]
        (_, _, whole, _), = encoder.rows(pa.array([text]))
        assert ids == whole.tolist()
        assert np.isclose(score_of(v, ids), best_score(v, text))


def test_ids_do_not_depend_on_the_chunks(spark, rng):
    """Some 700 chunks of 256 characters, so the matrices meet in three rounds."""
    docs = table(spark, SF_DIR, "documents").select("doc_id", "text").where("doc_id < 300")
    long = spark.createDataFrame([(10**6, " ".join(invented(rng, 30_000))), (10**6 + 1, "abc" * 5000), (None, "日本" * 300)],
                                 "doc_id long, text string")
    read = [sorted((r.doc_id or -1, r.ids) for r in sp.encode_pieces(docs.union(long), MODEL, chunk_chars=c).collect())
            for c in (256, 4096, 1 << 20)]
    assert read[0] == read[1] == read[2]


def test_encode_and_decode_tables(spark, messy, no_documents):
    coded = sp.encode_pieces(messy, MODEL, keep=["text"], chunk_chars=4096).withColumnRenamed("text", "was")
    rows = sp.decode_pieces(coded, MODEL).collect()
    assert len(rows) == 10 and all((r.was or "") == r.text for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (1, 2)} == {0}
    whole = sp.encode_pieces(messy, MODEL, chunk_chars=1 << 20)
    assert sorted((r.doc_id or 0, r.n_tokens) for r in whole.collect() if r.doc_id != 7) == sorted(
        (r.doc_id or 0, r.n_tokens) for r in rows if r.doc_id != 7)
    assert sp.encode_pieces(no_documents, MODEL).count() == 0
    odd = spark.createDataFrame([(1, None), (2, [-5, 40_000, 1])], "doc_id long, ids array<int>")
    assert [r.text for r in sp.decode_pieces(odd, MODEL).collect()] == ["", ""]
    with pytest.raises(ValueError):
        sp.encode_pieces(messy, MODEL, chunk_chars=10)


def library_ids(texts):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(WORDS)
    return [library.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]


def test_word_pieces_equal_the_library():
    texts = ["", None, "it's a's 'street we'll X'S 'S", "a<|endoftext|>b c", "é, ab́,x", "İstanbul,ok",
             " a, b c　d", "日本,語", "—,—a,b", "x" * 30, "KK,a", "a\x00b\x1cc,", "12ab34,5", "ok</w>,", "don't,won't'll!!"]
    work = tf.WordEncoder(WORDS, 1)
    got = [ids[b[i]:b[i + 1]].tolist() for _, _, ids, b in work.batches(pa.array(texts)) for i in range(len(b) - 1)]
    assert got == library_ids(texts)


def test_a_full_memo_computes_only_what_is_missing():
    memo, asked = Memo(4), []

    def compute(keys):
        asked.extend(keys)
        return [k * 2 for k in keys]

    assert memo.lookup([b"a", b"b", b"c"], compute) == [b"aa", b"bb", b"cc"]
    assert memo.lookup([b"c", b"d", b"e"], compute) == [b"cc", b"dd", b"ee"]
    assert memo.lookup([b"e", b"c"], compute) == [b"ee", b"cc"] and len(memo) <= 4
    assert asked == [b"a", b"b", b"c", b"d", b"e"]


def test_token_files(spark, messy, no_documents):
    path = stage_path(spark, "tokens")
    tf.write_token_files(tf.encode_in_order(messy, WORDS, 1), path)
    rows = tf.ids_checksum(tf.read_token_files(spark, path)).orderBy("start").collect()
    source = sorted(((r.doc_id is not None, r.doc_id or 0), r.text or "") for r in messy.select("doc_id", "text").collect())
    ids = library_ids([t for _, t in source])
    assert [r.n_tokens for r in rows] == list(map(len, ids))
    assert [r.start for r in rows] == [sum(map(len, ids[:i])) for i in range(len(ids))]
    assert [r.ids_crc32 for r in rows] == [zlib.crc32(np.array(i, "<u4").tobytes()) for i in ids]
    empty = stage_path(spark, "tokens")
    tf.write_token_files(tf.encode_in_order(no_documents, WORDS, 1), empty)
    assert spark.read.schema("doc_id long").parquet(empty).count() == 0


def test_counts_alone_are_read_selectively(spark, messy):
    path = stage_path(spark, "tokens")
    tf.write_token_files(tf.encode_in_order(messy, WORDS, 1), path)
    plan = tf.read_token_files(spark, path).where("doc_id = 5").select("n_tokens")._jdf.queryExecution().toString()
    scan = plan[plan.rindex("ReadSchema"):]
    assert "ids" not in scan and "EqualTo(doc_id,5)" in plan


def brute(rows, k=20):
    sound = {i: np.array(v, float) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for q in sound:
        if q % 20 == 0:
            near = sorted((-float(sound[q] @ v), i) for i, v in sound.items() if i != q and len(v) == len(sound[q]))[:k]
            out[q] = [(i, -s) for s, i in near]
    return out


def test_graph_search_on_the_given_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    want = brute(rows)
    got = {}
    for r in qs.QUERIES["op7_graph_search"](spark, SF_DIR).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(got) == set(want) and all(len(got[q]) == 20 for q in want)
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]) >= 0.95
    exact = dict(rows)
    assert all(np.isclose(s, np.dot(np.array(exact[q], float), np.array(exact[i], float))) for q in got for i, s in got[q])


@pytest.mark.parametrize("kind", ["unit", "log-normal", "outliers"])
def test_graph_search_over_several_shards(spark, kind):
    made = np.random.default_rng(11)
    x = made.normal(size=(2400, 24)) @ np.diag(np.linspace(2, 0.3, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if kind == "log-normal":
        x *= made.lognormal(sigma=1.0, size=(len(x), 1))
    if kind == "outliers":
        x[7] *= 1e4
        x[40] *= 1e20
        x[41] *= 1e-30
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    index = ag.build_index(table, shard_rows=400)
    assert index.count() >= 5
    got = {}
    for r in ag.nearest(index, table.where("vec_id % 20 = 0")).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    want = brute(rows)
    assert set(got) == set(want) and all(len(got[q]) == 20 for q in want)
    assert np.mean([len(got[q] & {i for i, _ in want[q]}) / 20 for q in want]) >= 0.9


def test_graph_search_of_odd_vectors(spark, rng):
    rows = [(i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(60)]
    rows += [(100 + i, [3.0, 0.0, 0.0, 0.0]) for i in range(40)]  # one vector many times
    rows += [(200, None), (220, []), (240, [0.0] * 4), (260, [1.0, None, 0.0, 0.0]), (280, [float("nan")] * 4), (300, [float("inf"), 0.0, 0.0, 0.0]),
             (320, [1.0, 2.0]), (None, [1.0, 0.0, 0.0, 0.0]), (0, rows[0][1])]
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, shard int, ids string")
    index = ag.build_index(table, shard_rows=30)
    got = {}
    for r in ag.nearest(index, table.where("vec_id % 20 = 0")).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    want = brute([(i, list(np.array(v, np.float32)) if v and None not in v else v) for i, v in rows])
    want = {q: [i for i, _ in near] for q, near in want.items() if near}
    assert set(got) == set(want)
    assert got[100] == want[100] and got[120] == want[120]
    assert np.mean([len(set(got[q]) & set(want[q])) / len(want[q]) for q in want]) >= 0.95
    nothing = ag.build_index(table.limit(0))
    assert ag.nearest(nothing, table.where("vec_id % 20 = 0")).count() == 0
