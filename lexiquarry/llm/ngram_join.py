"""Near-duplicate documents: a Jaccard join on word n-grams with rare-first prefix filtering.

1. One pass counts the n-grams by hash bucket, over all documents. The counts order n-grams, rare first.
   They only steer the order: any fixed order gives the same links.
2. A document becomes its set of n-gram hashes. Documents of equal sets are one class, kept by its smallest id.
3. Two sets of similarity t share an n-gram among their first n - ceil(t n) + 1 ones. These prefixes are
   joined; pairs pass a length and a positional filter there, then a suffix filter that bounds the
   overlap by the counts of n-grams in 64 ranges.
4. Only classes of links are asked for, so pairs inside a class already known are never made. Some star
   rounds link each document to one candidate (its prefix n-gram's pivot, first the most typical document),
   which settles groups of copies with one pair per document. Then all pairs of different classes that still share a prefix n-gram are
   made, in square blocks where many documents share it, so nothing is capped.
5. A pair is verified once, on the whole sets.

Hashes have 64 bits; sets are compared by hash.

Defined results: words are runs of characters other than ASCII white space, A-Z folded. With fewer words than
`size` all of them are one n-gram. A null, empty or wordless text has the empty set and links with
nothing. All rows of one id are one document. A null id keeps its row, with a null class if it has no
smaller link. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiquarry.llm import arrays as ar
from lexiquarry.llm import sketch as sk
from lexiquarry.llm.components import components
from lexiquarry.llm.storage import settle

ORDER_BITS = 20
RANGES = 64
BLOCK_DOCS = 512
STAR_ROUNDS = 2


def least_overlap(total: Column, percent: int) -> Column:
    """Smallest intersection of two sets with `total` elements together that are similar enough."""
    return F.ceil(total * percent / (100 + percent) - 1e-9)


def document_sets(batch: pa.RecordBatch, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct n-gram hashes) of the text column, which is the last one."""
    for row, words in ar.words_by_row(batch.column(batch.num_columns - 1)):
        yield row, np.unique(ar.shingle_hashes(words, size))


def _prefixes(docs: DataFrame, size: int, percent: int, order) -> DataFrame:
    """(id, n, h1, h2, common, prefix, ranges) of every row.

    h1 and h2 stand for the set; `common` is the mean count of its n-grams, so it is largest for the documents
    in the middle of a group of near copies, whose n-grams the others share.
    """
    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        counts = order.value
        n, h1, h2, common, prefix, ranges = [], [], [], [], [], []
        for _, tokens in document_sets(batch, size):
            kept = len(tokens) - (len(tokens) * percent + 99) // 100 + 1 if len(tokens) else 0
            count = counts[sk.bucket_of(tokens, ORDER_BITS)]
            rare = np.lexsort((tokens, count))[:kept]
            common.append(count.mean() if len(tokens) else 0.0)
            n.append(len(tokens))
            h1.append(ar.mix(tokens).sum(dtype=np.uint64))
            h2.append(np.bitwise_xor.reduce(ar.mix(tokens ^ np.uint64(0x5851F42D4C957F2D))) if len(tokens) else np.uint64(0))
            prefix.append(ar.signed(tokens[rare]))
            ranges.append(np.bincount(sk.bucket_of(tokens, 6), minlength=RANGES))
        yield {"id": batch.column(0), "n": n, "h1": ar.signed(np.array(h1, np.uint64)),
               "h2": ar.signed(np.array(h2, np.uint64)), "common": common, "prefix": ar.list_column(prefix, pa.int64()),
               "ranges": ar.list_column(ranges, pa.int32())}

    return ar.map_arrow(docs, work, "id long, n int, h1 long, h2 long, common double, prefix array<long>, ranges array<int>")


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough: suffix filter first, then the exact count."""
    known = classes.select("id", "n", "ranges")
    a, b = (known.select(F.col("id").alias(c), F.col("n").alias(f"n_{c}"), F.col("ranges").alias(f"r_{c}")) for c in "ab")
    apart = F.aggregate(F.zip_with("r_a", "r_b", lambda x, y: F.abs(x - y)), F.lit(0), lambda s, x: s + x)
    total = F.col("n_a") + F.col("n_b")
    left = settle(pairs.join(a, "a").join(b, "b").where(apart <= total - 2 * least_overlap(total, percent))
                  .select("a", "b").distinct(), "pairs")
    # Sets are made again for the documents of pairs alone: an id table of fixed size filters the scan.
    wanted = sk.id_filter(left.select("a").union(left.select("b")))

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        part = batch.filter(pa.array(sk.may_hold(wanted.value, batch.column(0))))
        for at in range(0, part.num_rows, 1000):
            rows = part.slice(at, 1000)
            sets = [ar.signed(s) for _, s in document_sets(rows, size)]
            yield {"id": rows.column(0), "s": ar.list_column(sets, pa.int64())}

    sets = ar.map_arrow(docs, work, "id long, s array<long>")
    both = (left.join(sets.select(F.col("id").alias("a"), F.col("s").alias("s_a")), "a")
            .join(sets.select(F.col("id").alias("b"), F.col("s").alias("s_b")), "b"))
    shared = F.size(F.array_intersect("s_a", "s_b"))
    union = F.size("s_a") + F.size("s_b") - shared
    return both.where(100 * shared >= percent * union).select("a", "b").distinct()


def _possible(na: Column, pa_: Column, nb: Column, pb: Column, percent: int) -> Column:
    """Length filter, and positional filter for an n-gram at places pa, pb of the ordered sets."""
    length = (100 * F.least(na, nb)) >= (percent * F.greatest(na, nb))
    return length & (F.least(na - pa_, nb - pb) >= least_overlap(na + nb, percent))


def similarity_classes(documents: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5,
                       threshold: Fraction = Fraction(4, 5)) -> DataFrame:
    """(key, n_shingles, component_id) for every row: the smallest id reachable over links of similar sets.

    `key` is an integer column; `threshold` is a whole percentage.
    """
    percent = int(threshold * 100)
    docs = documents.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    counts = sk.bucket_counts(docs, lambda batch: (s for _, s in document_sets(batch, size)), ORDER_BITS)
    order = docs.sparkSession.sparkContext.broadcast(counts)
    rows = settle(_prefixes(docs, size, percent, order), "prefixes")
    same = ["n", "h1", "h2"]
    best = F.min(F.struct("id", "common", "prefix", "ranges"))
    classes = settle(rows.where("n > 0 and id is not null").groupBy(*same).agg(best.alias("r")).select(*same, "r.*"), "classes")

    postings = classes.select("id", "n", "common", F.posexplode("prefix").alias("pos", "token"))
    several = postings.groupBy("token").agg(F.count("*").alias("f")).where("f > 1")
    shared = settle(postings.join(several, "token"), "postings")

    links = None
    for round_ in range(STAR_ROUNDS + 1):
        at = shared
        if links is not None:
            found = components(links)
            at = (shared.join(found.withColumnRenamed("node", "id"), "id", "left")
                  .withColumn("component", F.coalesce("component", "id")))
            mixed = (at.groupBy("token").agg(F.count("*").alias("f"), F.min("component").alias("lo"),
                                             F.max("component").alias("hi")).where("lo < hi").select("token", "f"))
            at = settle(at.drop("f").join(mixed, "token"), "open")
        else:
            at = at.withColumn("component", F.col("id"))
        pairs = _star_pairs(at, round_, percent) if round_ < STAR_ROUNDS else _all_pairs(at, percent)
        fresh = _verified(pairs, classes, docs, size, percent)
        links = settle(fresh if links is None else links.union(fresh), "links")
    final = components(links).withColumnRenamed("node", "id")
    member = classes.select(*same, "id").join(final, "id", "left").select(
        *same, F.coalesce("component", "id").alias("component_id"))
    return (rows.select("id", *same).join(member, same, "left")
            .groupBy(F.col("id").alias(key)).agg(
                F.max("n").cast("long").alias("n_shingles"),
                F.least(F.min("component_id"), F.col("id")).alias("component_id")))


def _star_pairs(at: DataFrame, round_: int, percent: int) -> DataFrame:
    """One pair (a, b) for each document at most: with the pivot of one of its prefix n-grams.

    In the first round the pivot of an n-gram is its document with the most common n-grams of all, later the
    one with the smallest hash, another one in each round.
    """
    rank = F.struct((F.lit(0.0) if round_ else -F.col("common")).alias("first"), F.xxhash64(F.col("id"), F.lit(round_)).alias("then"))
    pivots = at.groupBy("token").agg(F.min(F.struct(
        rank.alias("rank"), F.col("id").alias("b"), F.col("n").alias("nb"), F.col("pos").alias("pb"),
        F.col("component").alias("cb"))).alias("p"))
    met = at.join(pivots, "token").where((F.col("component") != F.col("p.cb")) & _possible(
        F.col("n"), F.col("pos"), F.col("p.nb"), F.col("p.pb"), percent))
    chosen = met.groupBy("id").agg(F.min(F.struct("p.rank", "p.b")).alias("p"))
    return chosen.select(F.col("id").alias("a"), F.col("p.b").alias("b"))


def _all_pairs(at: DataFrame, percent: int) -> DataFrame:
    """All pairs of different classes that share a prefix n-gram.

    The documents of an n-gram are dealt into groups of about BLOCK_DOCS, and each two groups meet in a cell of
    their own, so that no task gets more than two groups of a frequent n-gram at once.
    """
    groups = F.ceil(F.col("f") / BLOCK_DOCS).cast("int")
    own = F.pmod(F.xxhash64("id"), groups).cast("int")
    dealt = at.withColumn("g", groups).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
    cell = [F.least("own", "other").alias("c1"), F.greatest("own", "other").alias("c2")]
    side = dealt.select("token", *cell, "own", "id", "n", "pos", "component")
    a, b = (side.select("token", "c1", "c2", *[F.col(c).alias(f"{c}_{s}") for c in ("own", "id", "n", "pos", "component")])
            for s in "ab")
    # In a cell of two groups only pairs across them count; each pair is met once for a common n-gram.
    across = ((F.col("c1") == F.col("c2")) & (F.col("id_a") < F.col("id_b"))) | (F.col("own_a") < F.col("own_b"))
    return (a.join(b, ["token", "c1", "c2"])
            .where(across & (F.col("component_a") != F.col("component_b")) & _possible(
                F.col("n_a"), F.col("pos_a"), F.col("n_b"), F.col("pos_b"), percent))
            .select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b")).distinct())
