"""SimHash classes against plain fingerprints and all pairs."""

import itertools
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from lexiquarry.llm import simhash_rings as sr

from .conftest import invented


def plain_print(text, size=3):
    w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    shingles = [b" ".join(w[i:i + size]) for i in range(max(1, len(w) - size + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows, radius):
    """{(id, fingerprint): smallest id reachable}, by comparing all fingerprints."""
    prints = sorted({f for i, f in rows if i is not None})
    root = {f: f for f in prints}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for a, b in itertools.combinations(prints, 2):
        if (a ^ b).bit_count() <= radius:
            root[find(a)] = find(b)
    least = {}
    for i, f in rows:
        if i is not None:
            least[find(f)] = min(i, least.get(find(f), i))
    return {(i, f): least.get(find(f)) if f in root else None for i, f in rows}


def test_fingerprints_equal_plain_ones(rng):
    texts = [None, "", " \n", "One", "two Words", "a b c", "É é x y", "x" * 5000, *[" ".join(invented(rng, n)) for n in range(3, 90)]]
    texts += [" ".join(invented(rng, 300_000)), "y" * (3 << 20), "ab " + "z" * (2 << 20) + " cd"]
    assert sr.fingerprints(pa.array(texts)).tolist() == [plain_print(t) for t in texts]
    assert sr.fingerprints(pa.array(texts[:9]), size=1).tolist() == [plain_print(t, 1) for t in texts[:9]]
    assert len(sr.fingerprints(pa.array([], pa.string()))) == 0


def test_spark_hashes_shingles_alike(spark):
    assert spark.sql("select xxhash64('das ist für') h").first().h % (1 << 64) == xxhash.xxh64_intdigest("das ist für".encode(), 42)


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 7])
def test_pairs_equal_all_pairs(spark, radius):
    made = np.random.default_rng(radius)
    base = made.integers(0, 2**64, 40, dtype=np.uint64)
    prints = {0, 2**64 - 1, 1 << 63}
    for f in base.tolist():
        prints.add(f)
        for _ in range(12):  # around each, at all distances near the radius, also across the ends of the word
            for b in made.choice(64, made.integers(1, radius + 3), replace=False).tolist():
                f ^= 1 << b
            prints.add(f)
    dense = [sum(1 << int(b) for b in made.choice(12, made.integers(0, 5), replace=False)) for _ in range(150)]
    prints = sorted(prints | set(dense))
    want = {(a, b) for a, b in itertools.combinations([f - (1 << 64) if f >> 63 else f for f in prints], 2)
            if ((a ^ b) & (2**64 - 1)).bit_count() <= radius}
    frame = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in prints], "f long")
    got = [(r.a, r.b) for r in sr.close_pairs(frame, radius).collect()]
    assert len(got) == len(set(got)) and {tuple(sorted(p)) for p in got} == {tuple(sorted(p)) for p in want}
    assert radius == 0 or len(want) > 100


@pytest.mark.parametrize("radius", [0, 2])
def test_components_equal_plain_ones(spark, rng, messy, radius):
    rows = []
    for g in range(12):
        words = invented(rng, 150)
        for k in range(12):
            rows.append((100 * g + k, " ".join(words)))
            words[rng.randrange(150)] = invented(rng, 1)[0]
    rows += [(5000 + i, t) for i, t in enumerate([None, "", "  ", "the same"] * 10)] + [(None, rows[0][1]), (None, "nobody else")]
    rows += [(3, rows[30][1]), (3, "an id with several texts")]
    rows += [(r.doc_id, r.text) for r in messy.select("doc_id", "text").collect()]
    docs = spark.createDataFrame([(i, t, 1, 2, "c") for i, t in rows], "doc_id long, text string, f int, id int, component string")
    got = sr.near_duplicates(docs, radius=radius)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    want = plain_components([(i, plain_print(t)) for i, t in rows], radius)
    found = got.collect()
    assert len(found) == len(rows)
    assert {((r.doc_id, int(r.fingerprint, 16)), r.component_id) for r in found} == set(want.items())
    assert all(len(r.fingerprint) == 16 for r in found)


def test_no_documents(spark, no_documents):
    assert sr.near_duplicates(no_documents).count() == 0
