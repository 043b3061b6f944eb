"""A term index on files that can be replaced, changed by document and read at any time.

An index folder holds segments and manifests. A segment has the tables of some documents:

* `postings` (field, term, block, doc_id, tf, dl, positions and filter columns), and `pairs`, the same for two neighbouring
  words of which one is frequent;
* `blocks`: for each term and block of documents the pairs of term count and document length that no other pair of the
  block beats, so the best score in a block is known for any collection statistics;
* `forward`: each document's length and distinct terms;
* `term_stats`, `pair_stats`, `field_stats`: counts over the segment;
* `neighbours`: the keys under which fuzzy terms find a term;
* `retired`, `retired_terms`, `retired_pairs`, `retired_fields`: documents of earlier segments that the segment replaces, and
  what these had added to the counts.

A manifest names the segments of one version. It is written last, as one file, and readers start from the newest
one, so they see the old index or the new one, never a part of one, also where a writer dies. Folders of old versions stay until
they are removed by hand. There is one writer at a time; two that clash are found when the index is opened.

Tables of terms are split into folders by a hash of the term, so a join with a table of query terms prunes folders. Postings and
pairs are dealt inside by ranges of blocks of documents and sorted, so a frequent term spreads over many files; where a row goes is
known from its own columns, so what makes the rows runs once. Keys of fuzzy terms lie beside their terms, in the order of these.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiquarry.operators.fuzzy import like_in_length, meet, nearest_terms, neighbour_keys
from lexiquarry.operators.index import Lookup
from lexiquarry.operators.word_blocks import give_back_memory, group_numbers, whole_groups
from lexiquarry.session import settle

ROWS_PER_BUCKET = 4_000_000
DOCS_PER_BLOCK = 64
FREQUENT_SHARE = 0.2
# Words of the documents that a task takes at once, terms of a task that writes keys of neighbours, some 20 each, ranges of blocks
# of a bucket at least, and documents of a range, so rows of a frequent term in a file, about.
WORDS_AT_ONCE = 1 << 18
TERMS_PER_TASK = 50_000
SLICES, DOCS_PER_SLICE = 4, 1 << 20

_MANIFEST = ("version long, buckets int, n_blocks int, frequent string, doc_type string, attributes array<string>, "
             "attribute_types array<string>, segments array<string>, n_retired array<long>")
# Columns of the tables; <doc> stands for the type of doc_id, <attributes> for the filter columns.
_TABLES = {
    "postings": "field string, term string, block int, doc_id <doc>, tf long, dl long, positions array<int>, bucket int, <attributes>",
    "pairs": "field string, term string, doc_id <doc>, tf long, dl long, positions array<int>, bucket int",
    "blocks": "field string, term string, block int, best array<struct<tf: long, dl: long>>, bucket int",
    "forward": "field string, doc_id <doc>, dl long, terms array<string>",
    "term_stats": "field string, term string, df long, bucket int",
    "pair_stats": "field string, term string, df long, bucket int",
    "field_stats": "field string, n_docs long, total long",
    "neighbours": "field string, term string, key long, removed int",
    "retired": "segment int, doc_id <doc>",
    "retired_terms": "field string, term string, df long, bucket int",
    "retired_pairs": "field string, term string, df long, bucket int",
    "retired_fields": "field string, n_docs long, total long",
}
# Terms differ sooner than fields when rows are compared.
_TERM_ORDER = ["bucket", "term", "field"]


@dataclass(frozen=True)
class Manifest:
    """What makes up one version; `n_retired` has the number of rows each segment retires."""

    version: int
    buckets: int
    n_blocks: int
    frequent: str
    doc_type: str
    attributes: tuple[str, ...]
    attribute_types: tuple[str, ...]
    segments: tuple[str, ...]
    n_retired: tuple[int, ...]

    def schema(self, table: str) -> str:
        own = ", ".join(f"`{n}` {t}" for n, t in zip(self.attributes, self.attribute_types, strict=True))
        return _TABLES[table].replace("<doc>", self.doc_type).replace("<attributes>", own).rstrip(", ")


def bucket(term: Column, buckets: int) -> Column:
    return (F.crc32(term.cast("binary")) % buckets).cast("int")


@dataclass(frozen=True)
class StoredIndex:
    """One version of the index at `path`."""

    spark: SparkSession
    path: str
    manifest: Manifest

    @property
    def attributes(self) -> tuple[str, ...]:
        return self.manifest.attributes

    def segment_table(self, segment: str, name: str) -> DataFrame:
        # The schema is given, as a table without rows has no file to tell it.
        return self.spark.read.schema(self.manifest.schema(name)).parquet(f"{self.path}/segments/{segment}/{name}")

    def _each(self, name: str, wanted: DataFrame | None = None, keys: Iterable[str] = ()) -> DataFrame:
        """The table of all segments with the segment's number. Joined with `wanted` segment by segment, so that its rows prune
        the folders of each."""
        found = None
        for i, segment in enumerate(self.manifest.segments):
            rows = self.segment_table(segment, name)
            if wanted is not None:
                rows = rows.join(wanted, list(keys))
            rows = rows.withColumn("segment", F.lit(i))
            found = rows if found is None else found.unionByName(rows)
        return found

    def _retired(self, name: str) -> DataFrame | None:
        """A `retired…` table of all segments that retire anything."""
        found = None
        for segment, n in zip(self.manifest.segments, self.manifest.n_retired, strict=True):
            if n:
                rows = self.segment_table(segment, name)
                found = rows if found is None else found.unionByName(rows)
        return found

    def _live(self, rows: DataFrame) -> DataFrame:
        """Rows (segment, doc_id, …) of documents that no later segment replaces."""
        gone = self._retired("retired")
        return (rows if gone is None else rows.join(gone, ["segment", "doc_id"], "left_anti")).drop("segment")

    def _counted(self, name: str, wanted: DataFrame | None, keys: list[str], counts: list[str]) -> DataFrame:
        """Counts of all segments less those of retired documents; what has none left goes."""
        rows = self._each(f"{name}_stats", wanted, keys).drop("segment")
        gone = self._retired(f"retired_{name}s")
        if gone is None and len(self.manifest.segments) == 1:
            return rows
        if gone is not None:
            gone = gone if wanted is None else gone.join(wanted, keys)
            rows = rows.unionByName(gone.withColumns({c: -F.col(c) for c in counts}))
        others = [c for c in rows.columns if c not in counts]
        return rows.groupBy(*others).agg(*[F.sum(c).alias(c) for c in counts]).where(F.col(counts[0]) > 0)

    def vocabulary(self) -> DataFrame:
        return self._counted("term", None, _TERM_ORDER, ["df"]).select("field", "term", "df")

    def fuzzy(self, terms: DataFrame) -> DataFrame:
        """`fuzzy_expand` on the stored keys; terms that only retired documents had are left out."""
        met = meet(self._each("neighbours").drop("segment"), terms)
        if len(self.manifest.segments) > 1:
            met = settle(like_in_length(met).distinct(), "met")
            met = met.join(self._counted("term", self.wanted(met), _TERM_ORDER, ["df"]).select("field", "term"), ["field", "term"])
        return nearest_terms(met, terms)

    def field_stats(self) -> DataFrame:
        return self._counted("field", None, ["field"], ["n_docs", "total"]).select(
            "field", "n_docs", (F.col("total").cast("double") / F.col("n_docs")).alias("avgdl"))

    def doc_stats(self) -> DataFrame:
        return self._live(self._each("forward")).where("dl > 0").select("field", "doc_id", "dl")

    def wanted(self, clauses: DataFrame) -> DataFrame:
        """Distinct (bucket, field, term) as a written table, small enough for the planner to broadcast unless the batch
        is huge. The filter makes it one that may prune partitions."""
        keys = clauses.select("field", "term").distinct().withColumn("bucket", bucket(F.col("term"), self.manifest.buckets))
        return settle(keys, "wanted").where("term <> ''")

    def lookup(self, clauses: DataFrame, terms: Iterable[str] = ()) -> Lookup:
        """Postings and statistics of the (field, term) of a clause table, one plan for batches of any size."""
        wanted = self.wanted(clauses)
        columns = ["field", "term", "doc_id", "tf", "dl", *self.attributes]
        postings = self._live(self._each("postings", wanted, _TERM_ORDER)).select(*columns)
        return Lookup(postings, self.term_counts(wanted), self.field_stats())

    def term_counts(self, wanted: DataFrame) -> DataFrame:
        """(field, term, df) of a table made by `wanted`."""
        return self._counted("term", wanted, _TERM_ORDER, ["df"]).select("field", "term", "df")

    def in_blocks(self, places: DataFrame) -> DataFrame:
        """The postings in the blocks of a table (field, term, block, …), whose other columns come along."""
        keyed = settle(places.withColumn("bucket", bucket(F.col("term"), self.manifest.buckets)), "places").where("term <> ''")
        return self._live(self._each("postings", keyed, [*_TERM_ORDER, "block"])).drop("bucket", "positions")

    def blocks(self, wanted: DataFrame) -> DataFrame:
        """(field, term, block, best): competitive pairs (tf, dl) by block, of the terms of a table made by `wanted`."""
        return self._each("blocks", wanted, _TERM_ORDER).select("field", "term", "block", "best")

    def frequent(self) -> DataFrame:
        """(field, term) of the words whose pairs are stored."""
        return self.spark.read.schema("field string, term string").parquet(f"{self.path}/{self.manifest.frequent}")

    def elements(self, elements: DataFrame) -> DataFrame:
        """Postings with positions of phrase elements (field, term, …): pairs hold a space, words none. Other columns come along."""
        keyed = settle(elements.withColumn("bucket", bucket(F.col("term"), self.manifest.buckets)), "elements")
        columns = [*elements.columns, "doc_id", "dl", "positions"]
        pair = F.contains("term", F.lit(" "))
        words = self._live(self._each("postings", keyed.where(~pair), _TERM_ORDER)).select(*columns)
        pairs = self._live(self._each("pairs", keyed.where(pair), _TERM_ORDER)).select(*columns)
        return words.unionByName(pairs)

    def element_stats(self, elements: DataFrame) -> DataFrame:
        """(field, term, df) of phrase elements."""
        wanted = self.wanted(elements)
        return (self._counted("term", wanted, _TERM_ORDER, ["df"])
                .unionByName(self._counted("pair", wanted, _TERM_ORDER, ["df"])).select("field", "term", "df"))


# ---------------------------------------------------------------- versions

def _manifests(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_MANIFEST).json(f"{path}/manifests/*")


def versions(spark: SparkSession, path: str) -> list[int]:
    """Versions that can be opened, oldest first."""
    try:
        return sorted(r.version for r in _manifests(spark, path).select("version").collect())
    except AnalysisException:  # no folder yet
        return []


def open_index(spark: SparkSession, path: str, version: int | None = None) -> StoredIndex:
    """The newest version of the index at `path`, or a given one."""
    known = versions(spark, path)
    if not known:
        raise FileNotFoundError(f"no index at {path}")
    version = known[-1] if version is None else version
    found = _manifests(spark, path).where(F.col("version") == version).collect()
    if len(found) != 1:
        raise RuntimeError(f"{len(found)} manifests of version {version} at {path}")
    row = found[0].asDict()
    return StoredIndex(spark, path, Manifest(**{k: tuple(v) if isinstance(v, list) else v for k, v in row.items()}))


def _publish(spark: SparkSession, path: str, manifest: Manifest) -> StoredIndex:
    """Make a version known, as the last step of its writer."""
    row = {k: list(v) if isinstance(v, tuple) else v for k, v in vars(manifest).items()}
    (spark.createDataFrame([row], _MANIFEST).coalesce(1)
     .write.json(f"{path}/manifests/{manifest.version:09d}-{uuid.uuid4().hex}"))
    return open_index(spark, path, manifest.version)


# ---------------------------------------------------------------- segments

def _sorted(rows: DataFrame, path: str, order: list[str]) -> None:
    """By ranges, sorted, in one folder a bucket."""
    rows.repartitionByRange(*order).sortWithinPartitions(*order).write.partitionBy("bucket").parquet(path)


def _dealt(rows: DataFrame, index: StoredIndex, path: str, order: list[str]) -> None:
    """Rows with `bucket` and `block`, sorted, in files by bucket and range of blocks."""
    m = index.manifest
    slices = min(max(SLICES, math.ceil(m.n_blocks * DOCS_PER_BLOCK / DOCS_PER_SLICE)), m.n_blocks)
    task = F.col("bucket") * slices + F.floor(F.col("block").cast("long") * slices / m.n_blocks).cast("int")
    (rows.repartitionById(m.buckets * slices, task).sortWithinPartitions(*order)
     .drop(*[c for c in ("block",) if c not in order]).write.partitionBy("bucket").parquet(path))


def _best_pairs(postings: DataFrame, path: str, in_order: bool = False) -> None:
    """Write (bucket, field, term, block, best): the (tf, dl) of a block that no other has more of at less length.

    Unless the postings are given `in_order`, as files have them, they are brought there by ranges. A block of a term whose rows two tasks
    read has a row from each.
    """
    keys = [*_TERM_ORDER, "block"]

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, keys):
            group = group_numbers(table, keys)
            table = table.take(pa.array(np.lexsort([np.array(table["dl"]), -np.array(table["tf"]), group])))
            dl = np.array(table["dl"])
            # Counts fall inside a group; a pair is kept if it is shorter than all before it.
            falling = dl - group * (int(dl.max()) + 1)
            kept = np.flatnonzero(falling < np.minimum.accumulate(np.append(dl.max() + 1, falling[:-1])))
            first = np.searchsorted(group[kept], np.arange(group[-1] + 2)).astype(np.int32)
            part = table.take(pa.array(kept)).combine_chunks().to_batches()[0]
            pairs = pa.StructArray.from_arrays([part["tf"], part["dl"]], ["tf", "dl"])
            yield pa.RecordBatch.from_arrays(
                [part[k].take(pa.array(first[:-1])) for k in keys] + [pa.ListArray.from_arrays(pa.array(first), pairs)], [*keys, "best"])
        give_back_memory()

    rows = postings.select(*keys, "tf", "dl")
    if not in_order:
        rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    schema = ", ".join(f"{k} {'string' if k in ('term', 'field') else 'int'}" for k in keys)
    found = rows.mapInArrow(best, f"{schema}, best array<struct<tf: long, dl: long>>")
    # The rows are in order already; the writer brings those of a folder together.
    found.write.partitionBy("bucket").parquet(path)


def _document_postings(words: DataFrame, attributes: Iterable[str]) -> DataFrame:
    """The postings with positions, as of `build_postings`, made where the documents are: a document and field is one row."""
    attributes, kinds = list(attributes), dict(words.dtypes)
    others = ["field", "doc_id", "dl", *attributes]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = np.cumsum(np.array(pc.fill_null(pc.list_value_length(batch["words"]), 0)))
            at = 0
            while at < batch.num_rows:
                last = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + WORDS_AT_ONCE, "right"))
                last = min(max(last, at + 1), batch.num_rows)
                yield of_rows(batch.slice(at, last - at))
                at = last
            give_back_memory()

    def of_rows(part: pa.RecordBatch) -> pa.RecordBatch:
        flat, row = part["words"].flatten(), np.array(pc.list_parent_indices(part["words"]), np.int64)
        there = np.array(pc.is_valid(flat), bool)
        place = (np.arange(len(row)) - np.searchsorted(row, row))[there]
        coded, row = flat.filter(pa.array(there)).dictionary_encode(), row[there]
        # By term, as the tables are sorted later: that merges the runs of blocks with few comparisons.
        by_name = np.array(pc.array_sort_indices(coded.dictionary), np.int64)
        key = np.argsort(by_name)[np.array(coded.indices, np.int64)] * part.num_rows + row
        order = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.diff(key[order], prepend=-1))
        bounds, key = np.append(first, len(key)).astype(np.int32), key[order][first]
        rows = pa.array(key % part.num_rows)
        return pa.RecordBatch.from_arrays(
            [coded.dictionary.take(pa.array(by_name[key // part.num_rows])), pa.array(np.diff(bounds).astype(np.int64)),
             pa.ListArray.from_arrays(pa.array(bounds), pa.array(place[order].astype(np.int32)))]
            + [part[c].take(rows) for c in others], ["term", "tf", "positions", *others])

    own = ", ".join(f"`{a}` {kinds[a]}" for a in attributes)
    schema = f"term string, tf long, positions array<int>, field string, doc_id {kinds['doc_id']}, dl long" + (f", {own}" if own else "")
    found = words.select("field", "doc_id", F.size("words").cast("long").alias("dl"), *attributes, "words").mapInArrow(run, schema)
    return found.select("field", "term", "doc_id", "tf", "dl", *attributes, "positions")


def _write_neighbours(terms: DataFrame, path: str) -> None:
    """Only terms are dealt out, not their keys, which are many times as large."""
    n_tasks = max(math.ceil(terms.count() / TERMS_PER_TASK), 1)
    dealt = terms.select("field", "term").repartition(n_tasks, "term").sortWithinPartitions("field", "term")
    neighbour_keys(dealt).write.option("compression", "zstd").parquet(path)


def pair_words(words: DataFrame, frequent: list[tuple[str, str]]) -> DataFrame:
    """The table with each document's words replaced by its pairs of neighbours in which one is frequent in the field; other places are null."""
    listed = {}
    for name, term in frequent:
        listed.setdefault(name, []).append(term)

    def is_frequent(w: Column) -> Column:
        found = F.lit(False)
        for name, terms in listed.items():
            found |= (F.col("field") == name) & w.isin(*terms)
        return found

    second = F.slice("words", F.lit(2), F.greatest(F.size("words") - 1, F.lit(0)))
    joined = F.zip_with(F.slice("words", F.lit(1), F.greatest(F.size("words") - 1, F.lit(0))), second, lambda a, b: F.when(
        is_frequent(a) | is_frequent(b), F.concat(a, F.lit(" "), b)))
    return words.withColumn("words", joined)


def _placed(rows: DataFrame, buckets: int, n_blocks: int) -> DataFrame:
    return rows.withColumns({"bucket": bucket(F.col("term"), buckets),
                             "block": F.pmod(F.xxhash64("doc_id"), F.lit(n_blocks)).cast("int")})


def _write_tables(index: StoredIndex, segment: str, postings: DataFrame, forward: DataFrame) -> None:
    folder = f"{index.path}/segments/{segment}"
    _dealt(postings, index, f"{folder}/postings", [*_TERM_ORDER, "block", "doc_id"])
    forward.write.parquet(f"{folder}/forward")
    written = index.segment_table(segment, "postings")
    _sorted(written.groupBy(*_TERM_ORDER).agg(F.count("*").alias("df")), f"{folder}/term_stats", _TERM_ORDER)
    _best_pairs(written, f"{folder}/blocks", in_order=True)
    (index.segment_table(segment, "forward").where("dl > 0").groupBy("field")
     .agg(F.count("*").alias("n_docs"), F.sum("dl").alias("total")).coalesce(1).write.parquet(f"{folder}/field_stats"))
    _write_neighbours(index.segment_table(segment, "term_stats"), f"{folder}/neighbours")


def _write_pairs(index: StoredIndex, segment: str, pairs: DataFrame) -> None:
    folder = f"{index.path}/segments/{segment}"
    _dealt(pairs, index, f"{folder}/pairs", [*_TERM_ORDER, "doc_id"])
    (index.segment_table(segment, "pairs").groupBy(*_TERM_ORDER).agg(F.count("*").alias("df"))
     .write.partitionBy("bucket").parquet(f"{folder}/pair_stats"))


def _write_frequent(index: StoredIndex, segment: str) -> None:
    stats = index.segment_table(segment, "field_stats")
    common = (index.segment_table(segment, "term_stats").join(F.broadcast(stats), "field")  # one row a field
              .where(F.col("df") >= FREQUENT_SHARE * F.col("n_docs")))
    common.select("field", "term").write.parquet(f"{index.path}/{index.manifest.frequent}")


def _write_segment(index: StoredIndex, words: DataFrame) -> str:
    """A new segment of a settled table of words, not yet part of any version. The index may be one to be."""
    m, segment = index.manifest, uuid.uuid4().hex
    forward = words.select("field", "doc_id", F.greatest(F.size("words"), F.lit(0)).cast("long").alias("dl"),
                           F.array_distinct("words").alias("terms"))
    _write_tables(index, segment, _placed(_document_postings(words, m.attributes), m.buckets, m.n_blocks), forward)
    if not m.segments:
        _write_frequent(index, segment)
    # A document of m distinct words lends each a share of 1 / n_docs, so there are at most m / FREQUENT_SHARE on average.
    listed = [(r.field, r.term) for r in index.frequent().collect()]
    own_length = words.withColumn("own_dl", F.size("words").cast("long"))
    pairs = _document_postings(pair_words(own_length, listed), ["own_dl"]).drop("dl").withColumnRenamed("own_dl", "dl")
    _write_pairs(index, segment, _placed(pairs, m.buckets, m.n_blocks))
    return segment


def _next(spark: SparkSession, path: str) -> int:
    return max(versions(spark, path), default=0) + 1


def _sizes(words: DataFrame, rows_per_bucket: int, docs_per_block: int) -> tuple[int, int]:
    """Buckets for all words, and blocks for the documents of the field that has most."""
    n = words.groupBy("field").agg(F.sum(F.greatest(F.size("words"), F.lit(0)).cast("long")).alias("w"), F.count("*").alias("d"))
    n = n.agg(F.sum("w").alias("w"), F.max("d").alias("d")).first()
    return max(1, math.ceil((n.w or 0) / rows_per_bucket)), max(1, math.ceil((n.d or 0) / docs_per_block))


def write_index(words: DataFrame, path: str, attributes: Iterable[str] = (), rows_per_bucket: int = ROWS_PER_BUCKET,
                docs_per_block: int = DOCS_PER_BLOCK) -> StoredIndex:
    """Replace the index at `path` in one step by that of `words` (doc_id, field, words, *attributes), one row a document and field."""
    spark, attributes = words.sparkSession, tuple(attributes)
    words = settle(words.select("doc_id", "field", "words", *attributes), "words")
    kinds = dict(words.dtypes)
    buckets, n_blocks = _sizes(words, rows_per_bucket, docs_per_block)
    manifest = Manifest(_next(spark, path), buckets, n_blocks, f"frequent/{uuid.uuid4().hex}", kinds["doc_id"], attributes,
                        tuple(kinds[a] for a in attributes), (), ())
    segment = _write_segment(StoredIndex(spark, path, manifest), words)
    return _publish(spark, path, replace(manifest, segments=(segment,), n_retired=(0,)))


def _retire(index: StoredIndex, ids: DataFrame, folder: str) -> int:
    """Write what is live now of the documents `ids`, to be left out from the next version on. The number of documents retired."""
    spark, n_buckets = index.spark, index.manifest.buckets
    ids = ids.select(F.col("doc_id").cast(index.manifest.doc_type)).distinct()
    forward = index._each("forward")
    gone = index._retired("retired")
    live = forward if gone is None else forward.join(gone, ["segment", "doc_id"], "left_anti")
    old = settle(live.join(ids, "doc_id", "left_semi"), "replaced")
    old.select("segment", "doc_id").distinct().write.parquet(f"{folder}/retired")
    terms = (old.select("field", F.explode("terms").alias("term")).groupBy("field", "term").agg(F.count("*").alias("df"))
             .withColumn("bucket", bucket(F.col("term"), n_buckets)))
    terms.write.parquet(f"{folder}/retired_terms")
    (old.where("dl > 0").groupBy("field").agg(F.count("*").alias("n_docs"), F.sum("dl").alias("total"))
     .write.parquet(f"{folder}/retired_fields"))
    pairs = index._each("pairs").join(old.select("segment", "field", "doc_id"), ["segment", "field", "doc_id"], "left_semi")
    pairs.groupBy(*_TERM_ORDER).agg(F.count("*").alias("df")).write.parquet(f"{folder}/retired_pairs")
    return spark.read.schema(index.manifest.schema("retired")).parquet(f"{folder}/retired").count()


def _add(index: StoredIndex, words: DataFrame, ids: DataFrame) -> StoredIndex:
    m = index.manifest
    segment = _write_segment(index, words)
    n = _retire(index, ids, f"{index.path}/segments/{segment}")
    return _publish(index.spark, index.path, replace(
        m, version=_next(index.spark, index.path), segments=(*m.segments, segment), n_retired=(*m.n_retired, n)))


def upsert(index: StoredIndex, words: DataFrame) -> StoredIndex:
    """Add documents, replacing those of the same id whole: a new segment and a new version."""
    words = settle(words.select("doc_id", "field", "words", *index.attributes), "words")
    return _add(index, words, words)


def delete_documents(index: StoredIndex, ids: DataFrame) -> StoredIndex:
    """Drop the documents of a table with `doc_id`: a segment that only retires."""
    nothing = index._each("postings").limit(0).select(
        "doc_id", "field", F.array().cast("array<string>").alias("words"), *index.attributes)
    return _add(index, nothing, ids)


def compact(index: StoredIndex, rows_per_bucket: int = ROWS_PER_BUCKET, docs_per_block: int = DOCS_PER_BLOCK) -> StoredIndex:
    """Merge all segments into one, without what is retired. Texts are not read again."""
    size = index.field_stats().agg(F.sum(F.col("avgdl") * F.col("n_docs")).alias("w"), F.max("n_docs").alias("d")).first()
    manifest = replace(index.manifest, version=_next(index.spark, index.path), buckets=max(1, math.ceil((size.w or 0) / rows_per_bucket)),
                       n_blocks=max(1, math.ceil((size.d or 0) / docs_per_block)))
    merged, segment = replace(index, manifest=manifest), uuid.uuid4().hex
    postings = _placed(index._live(index._each("postings")), manifest.buckets, manifest.n_blocks)
    _write_tables(merged, segment, postings, index._live(index._each("forward")))
    _write_pairs(merged, segment, _placed(index._live(index._each("pairs")), manifest.buckets, manifest.n_blocks))
    return _publish(index.spark, index.path, replace(manifest, segments=(segment,), n_retired=(0,)))
