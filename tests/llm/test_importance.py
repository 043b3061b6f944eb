"""Importance resampling against a plain version."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from lexiquarry.llm import importance as im

from .conftest import invented

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def runs(text, least=1, most=1):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return [" ".join(w[i:i + n]) for n in range(least, most + 1) for i in range(len(w) - n + 1)], len(w)


def plain(documents, target, least=1, most=1, buckets=10_000, min_words=20, percent=10, seed=2024):
    """[(id, n_features, weight, score, rank)] by counting, scoring and sorting everything."""
    def places(text):
        return [zlib.crc32(f.encode()) % buckets for f in runs(text, least, most)[0]]

    s, t = Counter(), Counter()
    for _, text in documents:
        s.update(places(text))
    for text in target:
        t.update(places(text))
    S, T = sum(s.values()), sum(t.values())
    rows = []
    for i, text in documents:
        f = places(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in f)
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(f), weight, score, None, runs(text)[1]])
    able = sorted((r for r in rows if r[0] is not None and r[5] >= min_words), key=lambda r: (-r[3], r[0], r[1]))
    for rank, r in enumerate(able[:len(able) * percent // 100], 1):
        r[4] = rank
    return Counter(tuple(r[:5]) for r in rows)


def drawn(frame):
    return Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in frame.collect())


@pytest.mark.parametrize("least, most", [(1, 1), (1, 3), (2, 2)])
def test_equals_the_plain_version(spark, rng, messy, least, most):
    rows = [(1000 + i, " ".join(invented(rng, rng.randint(0, 60)))) for i in range(300)]
    rows += [(7000, "Équal text, " + " ".join(invented(rng, 30)))] * 40 + [(7001, "n " * n) for n in (19, 20, 25)]
    rows += [(r.doc_id, r.text) for r in messy.select("doc_id", "text").collect()]
    target = [" ".join(invented(rng, 40)) for _ in range(9)] + [None, "", rows[3][1]]
    docs = spark.createDataFrame([(i, t, 3, "x", 1.5) for i, t in rows], "doc_id long, text string, id int, rank string, weight double")
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    got = im.resample(docs.repartition(5), bench, features=im.Features(least, most, 500))
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert drawn(got) == plain(rows, target, least, most, 500)


@pytest.mark.parametrize("percent", [0, 1, 50, 99, 100])
def test_every_share_is_drawn_exactly(spark, rng, percent):
    rows = [(i, " ".join(invented(rng, 21))) for i in range(101)] + [(5, "one text twenty times " * 20)] * 30
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(rows[0][1],)], "text string")
    assert drawn(im.resample(docs, bench, percent=percent)) == plain(rows, [rows[0][1]], percent=percent)


def test_odd_tables(spark, messy, no_documents):
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert im.resample(no_documents, bench).count() == 0
    assert drawn(im.resample(messy, bench.limit(0))) == plain([(r.doc_id, r.text) for r in messy.collect()], [])


def test_long_texts_are_read_whole(rng):
    """Runs across the blocks of a text longer than one block."""
    text = " ".join(invented(rng, 300_000))
    assert len(text) > 1 << 20
    found = list(im.Features(1, 2, 1000).of(pa.array(["a b", text, None])))
    buckets = np.concatenate([b[rows == 1] for _, _, rows, b, _ in found])
    assert Counter(buckets.tolist()) == Counter(zlib.crc32(f.encode()) % 1000 for f in runs(text, 1, 2)[0])


def test_kth_key_of_equal_scores(spark):
    rows = spark.createDataFrame([(s, i) for i, s in enumerate([5] * 400 + [3, 9] * 50)], "s long, i long")
    want = sorted((r.s, r.i) for r in rows.collect())
    for k in (1, 50, 51, 333, 500):
        found = im.kth_row(rows, ["s", "i"], k, pivots=3)
        assert (found.s, found.i) == want[k - 1]
