"""N-gram join, decontamination and passages against brute force."""

import itertools
import math
import os
import re
import time
from collections import Counter

import pyarrow as pa
import pytest

from lexiquarry.llm import arrays as ar
from lexiquarry.llm import components as co
from lexiquarry.llm import decontaminate as dc
from lexiquarry.llm import ngram_join as nj
from lexiquarry.llm import substring_chain as sc
from lexiquarry.session import settle, stage_dir

from .conftest import invented


def words(text):
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", folded)


def shingles(text):
    w = words(text)
    return [tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))] if w else []


def classes(rows):
    """Smallest reachable id by plain comparison of all pairs."""
    sets = {}
    for i, text in rows:
        sets.setdefault(i, []).append(frozenset(shingles(text)))
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sets, 2):
        if any(x and 100 * len(x & y) >= 80 * len(x | y) for x in sets[a] for y in sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}, {i: max(map(len, s)) for i, s in sets.items()}


def edited(rng, text, n):
    out = list(text)
    for _ in range(n):
        out[rng.randrange(len(out))] = invented(rng, 1)[0]
    return out


def test_classes_equal_all_pairs(spark, rng, messy):
    base = invented(rng, 120)
    shared = invented(rng, 40)
    rows = [(100 + i, " ".join(edited(rng, base, rng.randint(0, 4)))) for i in range(40)]
    rows += [(300 + i, " ".join(shared + invented(rng, 12))) for i in range(20)]
    rows += [(400 + i, "same short text") for i in range(5)] + [(500, "same short"), (501, "Same  SHORT")]
    rows += [(r.doc_id, r.text) for r in messy.select("doc_id", "text").collect() if r.doc_id is not None]
    docs = spark.createDataFrame([(i, t, i, "x") for i, t in rows], "doc_id long, text string, component long, token string")
    got = {r.doc_id: (r.component_id, r.n_shingles) for r in nj.similarity_classes(docs).collect()}
    want, sizes = classes(rows)
    assert got == {i: (want[i], sizes[i]) for i in want}


def test_classes_of_odd_tables(spark, messy, no_documents):
    rows = nj.similarity_classes(messy).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == [(False, i) for i in range(1, 9)] + [(True, 0)]
    assert nj.similarity_classes(no_documents).count() == 0


def test_residual_pairs_in_cells(spark, monkeypatch):
    monkeypatch.setattr(nj, "BLOCK_DOCS", 3)
    rows = [(1, i, i, 10, 0) for i in range(10)]
    at = spark.createDataFrame(rows, "token long, id long, component long, n int, pos int").selectExpr("*", "10L as f")
    assert nj._all_pairs(at, 80).count() == 45


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(20, 60)] + [(7, 9), (9, 3), (100, 200), (200, 150), (5, 5)]
    got = {r.node: r.component for r in co.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 20 for i in range(20, 61)}, 7: 3, 9: 3, 3: 3, 100: 100, 200: 100, 150: 100}


def leaks(documents, items):
    """Best similarity of any item-sized window, by plain comparison."""
    out = {}
    for (d, text), (i, item) in itertools.product(documents, items):
        if len(words(item)) < 5 or len(words(text)) < 5:
            continue
        a, b = shingles(text), Counter(shingles(item))
        n = min(len(a), sum(b.values()))
        best = max(sum((Counter(a[s:s + n]) & b).values()) / sum((Counter(a[s:s + n]) | b).values()) for s in range(len(a) - n + 1))
        if best >= 0.8:
            out[d, i] = max(out.get((d, i), 0), best)
    return out


@pytest.mark.parametrize("block_words", [1_000_000, 60])
def test_leaks_equal_all_windows(spark, rng, block_words):
    items = [(i, " ".join(invented(rng, n))) for i, n in enumerate([5, 6, 30, 30, 45, 60])] + [(10, "four words are few"), (11, None)]
    documents = [(0, None), (1, ""), (2, "a b")]
    for k in range(40):
        item = words(rng.choice(items[:6])[1])
        item = edited(rng, item, rng.choice([0, 0, 1])) if len(item) > 20 else item
        item = item[rng.randint(0, 2):len(item) - rng.randint(0, 2)]
        documents.append((10 + k, " ".join(invented(rng, rng.randint(0, 50)) + item + invented(rng, rng.randint(0, 50)))))
    docs = spark.createDataFrame([(*d, 1, 2.0) for d in documents], "doc_id long, text string, item_id int, similarity double")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = dc.find_leaks(docs, bench, block_words=block_words).collect()
    want = leaks(documents, items)
    assert want and {(r.doc_id, r.item_id): round(r.similarity, 9) for r in found} == {k: round(v, 9) for k, v in want.items()}
    kept = {r.doc_id for r in dc.without_leaks(docs, bench, block_words=block_words).collect()}
    assert kept == {d for d, _ in documents} - {d for d, _ in want}


def test_leaks_of_odd_tables(spark, messy, no_documents):
    bench = spark.createDataFrame([(1, "a b c d e f g h")], "item_id long, text string")
    assert sorted(r.doc_id for r in dc.find_leaks(messy, bench).collect()) == [5, 5, 6]
    assert dc.find_leaks(messy, bench.limit(0)).count() == 0 and dc.find_leaks(no_documents, bench).count() == 0
    assert dc.without_leaks(messy, bench.limit(0)).count() == 10


def test_index_finds_all_within_the_radius(rng):
    import numpy as np
    made = np.random.default_rng(3)
    items = [(i, made.integers(0, 2**64, 34, dtype=np.uint64)) for i in range(50)]
    index = dc.ItemIndex(items, 5, dc.Fraction(4, 5)).classes[0]
    prints = index.prints.copy()
    for b in range(0, 38, 2):  # 19 bits off
        prints ^= np.uint64(1) << np.uint64(b * 1.6)
    found = {(w, i) for w, i, _ in index.candidates(prints)}
    apart = np.bitwise_count(prints[:, None] ^ index.prints[None])
    assert found == {tuple(x) for x in np.argwhere(apart <= dc.RADIUS)} and len(found) >= 50


def test_passages(spark, rng):
    passage, other = invented(rng, 80), invented(rng, 60)
    fuzzy = [w if i not in (20, 41, 63) else "changed" for i, w in enumerate(passage)]
    line = invented(rng, 8)
    texts = {1: invented(rng, 30) + passage + invented(rng, 30), 2: passage, 3: invented(rng, 200) + fuzzy + invented(rng, 5),
             4: invented(rng, 100), 5: passage[:40] + invented(rng, 60), 6: line * 10, 7: invented(rng, 9) + line * 12,
             # No document before has enough of this passage: its halves have homes in 8 and 9.
             8: invented(rng, 20) + other[:30] + invented(rng, 20), 9: invented(rng, 20) + other[30:] + invented(rng, 20),
             10: invented(rng, 9) + other, 11: other + invented(rng, 30)}
    docs = spark.createDataFrame([(i, " ".join(t), "home", 3) for i, t in texts.items()], "doc_id long, text string, seed string, pos int")
    rows = sc.repeated_passages(docs).collect()
    assert {r.doc_id for r in rows} == {2, 3, 7, 11}
    found = {(r.doc_id, r.source_id): r for r in rows}
    assert (found[2, 1].start_word, found[2, 1].end_word, found[2, 1].source_start) == (0, 80, 30)
    assert (found[3, 1].start_word, found[3, 1].end_word, found[3, 1].matched) == (200, 280, 77)
    assert (found[11, 10].start_word, found[11, 10].end_word, found[11, 10].source_start) == (0, 60, 9)


def passages(spark, texts):
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")
    return sc.repeated_passages(docs).collect()


def test_passages_pieced_together_from_poor_homes_on_both_levels(spark, rng):
    a, b, c = (invented(rng, 20) for _ in range(3))
    rows = passages(spark, {1: a + b, 2: b + c, 3: a + b + c, 4: a + b + c})
    assert {(r.doc_id, r.source_id, r.start_word, r.end_word) for r in rows} == {(4, 3, 0, 60)}


def test_passages_on_both_sides_of_a_gap_are_both_found(spark, rng):
    texts = {}
    for n, (one, other) in enumerate(((40, 40), (50, 30), (60, 0))):
        p, q = invented(rng, 60), invented(rng, 60)
        texts[10 * n + 1] = p + invented(rng, one) + q
        texts[10 * n + 2] = p + invented(rng, other) + q
    rows = passages(spark, texts)
    # By brute force: the longest equal runs.
    for n, other in enumerate((40, 30, 0)):
        found = {(r.start_word, r.end_word) for r in rows if r.doc_id == 10 * n + 2}
        assert all(any(a <= at and at + 60 <= b for a, b in found) for at in (0, 60 + other))
    assert all(r.matched >= 0.8 * max(r.end_word - r.start_word, r.source_end - r.source_start) for r in rows)


def test_the_longest_part_of_a_chain_is_kept_across_its_worst_gap():
    import numpy as np
    a = np.arange(200)
    b = np.where((a >= 30) & (a < 40), -1, a)
    b[70:] = np.where(a[70:] % 9 < 5, a[70:], -1)
    parts = sc.align(np.array([[0, 200, 0, 200, 0]]), a, b, 50, 0.8)
    assert parts and parts[0][0] == 0 and parts[0][1] >= 70
    assert all(n >= 0.8 * (p1 - p0) for p0, p1, _, _, n in parts)


def test_passages_whose_halves_lie_apart_in_one_earlier_document(spark, rng):
    a, b, far = invented(rng, 30), invented(rng, 30), invented(rng, 3000)
    rows = passages(spark, {1: far[:100] + b + far[100:] + a + far[:50], 5: invented(rng, 9) + a + b, 6: a + b + invented(rng, 9)})
    assert {(r.doc_id, r.source_id, r.start_word, r.end_word) for r in rows} == {(6, 5, 0, 60)}


def changed_at_every(rng, words, every):
    return [f"new{rng.random()}" if i % every == every - 1 else w for i, w in enumerate(words)]


def test_edited_passages_with_few_seeds(spark, rng):
    texts = {}
    for i in range(40):
        words = invented(rng, 55)
        texts[2 * i] = invented(rng, 100) + words + invented(rng, 100)
        texts[2 * i + 1] = invented(rng, 100) + changed_at_every(rng, words, 8) + invented(rng, 100)
    found = {r.doc_id for r in passages(spark, texts) if r.source_id == r.doc_id - 1}
    assert len(found) >= 38 and all(i % 2 for i in found)


def test_passages_that_a_document_repeats_are_found_each_time(spark, rng):
    p = invented(rng, 60)
    rows = passages(spark, {1: invented(rng, 10) + p, 9: p + invented(rng, 40) + p + invented(rng, 70) + p})
    assert {(r.doc_id, r.source_id, r.start_word, r.end_word, r.source_start) for r in rows} == {
        (9, 1, at, at + 60, 10) for at in (0, 100, 230)}


def test_passages_of_odd_tables(spark, messy, no_documents):
    twice = messy.unionByName(messy.selectExpr("*").withColumn("doc_id", messy["doc_id"] + 100))
    rows = sc.repeated_passages(twice).collect()
    assert {(r.doc_id, r.source_id) for r in rows} == {(107, 7)}
    assert sc.repeated_passages(no_documents).count() == 0


def test_chain_takes_the_best_collinear_set():
    import numpy as np
    segments = np.array([[0, 20, 100, 120, 20], [30, 50, 130, 150, 20], [30, 50, 10, 30, 20], [55, 80, 155, 180, 25]])
    assert sc.chain(segments)[0] == [0, 1, 3]


def test_common_words_equal_the_plain_table(rng):
    import numpy as np

    def plain(a, b):
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                table[i + 1, j + 1] = table[i, j] + 1 if a[i] == b[j] else max(table[i, j + 1], table[i + 1, j])
        return table[-1, -1]

    for _ in range(200):
        a, b = (np.array([rng.randrange(rng.choice([2, 9, 60])) for _ in range(rng.randrange(90))], np.int32) for _ in range(2))
        assert sc.common_words(a, b) == plain(a, b)


def test_seed_bits_hold_all_seeds_of_two_rows(spark, rng):
    import numpy as np
    shared, twice = invented(rng, 40), invented(rng, 9)
    texts = [None, "", "a b", " ".join(shared + invented(rng, 300)), " ".join(invented(rng, 20) + shared), " ".join(twice * 5)]
    bits = sc._met_twice(spark.createDataFrame([(t,) for t in texts], "text string")).value
    held = lambda words: [bits[h >> np.uint64(39)] >> (7 - int((h >> np.uint64(36)) & np.uint64(7))) & 1 for h in words]
    of = [sc.seeds(w)[0] for _, w in sc.ar.words_by_row(sc.pa.array(texts))]
    both = np.intersect1d(of[3], of[4])
    assert len(both) > 5 and all(held(both))
    assert len(bits) == 1 << 25 and not any(held(np.setdiff1d(of[3], both))) and not any(held(of[5]))


def test_passages_leave_only_the_tables_that_the_result_reads(spark, rng):
    folder = f"{stage_dir(spark)}/lexiquarry"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    p = invented(rng, 60)
    docs = spark.createDataFrame([(1, " ".join(p)), (2, " ".join(invented(rng, 9) + p))], "doc_id long, text string")
    result = sc.repeated_passages(docs)
    left = {name.split("-")[0] for name in set(os.listdir(folder)) - before}
    assert left == {"passages", "hopeful"}
    assert [(r.doc_id, r.start_word, r.end_word) for r in result.collect()] == [(2, 9, 69)]


def test_a_settled_table_leaves_no_shuffle_files(spark):
    local = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    folders = [str(f) for f in local.localDirs()]
    files = lambda: {f for top in folders for _, _, names in os.walk(top) for f in names if f.startswith("shuffle_")}
    before = files()
    settle(spark.range(1000).repartition(3, "id"), "dealt")
    end = time.time() + 20
    while files() - before and time.time() < end:
        time.sleep(0.2)
    assert not files() - before


@pytest.mark.parametrize("rounds", [1, 5])
def test_all_pairs_in_rounds_are_those_of_a_plain_search(spark, rng, monkeypatch, rounds):
    p, few = invented(rng, 60), invented(rng, 6)
    texts = {i: [*invented(rng, 5 + i), *(p[i:i + 55] if i < 4 else few), *invented(rng, 30)] for i in range(9)}
    texts[20] = p[:20] + p[25:]  # two segments
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()] + [(3, " ".join(invented(rng, 7)))], "id long, text string")
    own = {i: sc.seeds(next(ar.words_by_row(pa.array([" ".join(t)])))[1]) for i, t in texts.items()}
    found = [(int(s), i, int(pos)) for i, (hashes, places, _) in own.items() for s, pos in zip(hashes.view("int64"), places, strict=True)]
    first = {(s, i): min(pos for t, j, pos in found if (t, j) == (s, i)) for s, i, _ in found}
    rest = spark.createDataFrame([(s, i, pos, first[s, i] == pos) for s, i, pos in found], "seed long, id long, pos int, first boolean")
    matches = [(i, j, pos, at) for s, i, pos in found for (t, j), at in first.items() if s == t and j < i]
    plain = sc._chains(spark.createDataFrame(matches, "id long, home long, pos int, home_pos int"))
    as_set = lambda chains: {(r.id, r.home, tuple(r.segments)) for r in chains.collect()}
    monkeypatch.setattr(sc, "CELL_MATCHES", 1 if rounds > 1 else 1 << 20)
    chains = sc._all_chains(rest, docs, 50, math.ceil(len(matches) / rounds))
    assert as_set(chains) == as_set(sc._hopeful(plain, docs, 50))
    assert {(r.id, r.home) for r in chains.collect()} >= {(1, 0), (2, 1), (20, 3)}


def test_seeds_of_many_rows_at_once_are_those_of_each(rng):
    texts = [" ".join(rng.choices(["aa", "b", "cc", "d", "e f"], k=n)) for n in (0, 1, 4, 5, 6, 7, 8, 9, 0, 40, 300)] + ["x y z v w " * 30, "", None]
    texts += [" ".join(f"w{i}" for i in rng.choices(range(400), k=n)) for n in range(3, 60)]
    blocks = list(ar.words_by_block(pa.array(texts)))
    assert len(blocks) == 1
    for window, k in ((sc.WINDOW, sc.K), (6, 3), (1, 2)):
        rows, hashes, places, own = sc.seeds_of_rows(*blocks[0][1:], k=k, window=window)
        for i, words in ar.words_by_row(pa.array(texts)):
            want, at, again = sc.seeds(words, k, window)
            mine = rows == i
            repeated = own[mine] != hashes[mine]
            assert hashes[mine].tolist() + own[mine][repeated].tolist() == want.tolist(), (i, k, window)
            assert places[mine].tolist() + places[mine][repeated].tolist() == at.tolist() and again.sum() == repeated.sum()
