"""Stages of the corpus pipeline, each one operator and what its result does to the documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiquarry.llm import arrays as ar
from lexiquarry.llm import decontaminate as dc
from lexiquarry.llm import ngram_join as nj
from lexiquarry.llm import sentencepiece_scan as sp
from lexiquarry.llm import substring_chain as sc
from lexiquarry.llm import toxicity as tx
from lexiquarry.llm.sampling import held_out
from lexiquarry.llm.storage import settle

TOXIC_CATEGORIES = ("junk", "toxic", "abusive_junk")


def toxicity_labels(labels: DataFrame) -> DataFrame:
    """The categories that the label table supports, in chain order: low quality, toxic, and both."""
    junk, toxic = F.col("quality") == 0, F.col("toxic") == 1
    return labels.select("doc_id", junk.cast("int").alias("junk"), toxic.cast("int").alias("toxic"),
                         (junk & toxic).cast("int").alias("abusive_junk"))


def fit_chain(docs: DataFrame, labels: DataFrame) -> tx.Chain:
    return tx.fit_toxicity(docs, toxicity_labels(labels).where(~held_out(F.col("doc_id"))), TOXIC_CATEGORIES)


def keep_civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows are judged where they are, so no text is shuffled."""
    chain = fit_chain(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    place, link = docs.columns.index("text"), TOXIC_CATEGORIES.index("toxic")

    def civil(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                p = chain.probabilities(part.column(place))[:, link]
                yield part.filter(pa.array(p < chain.threshold("toxic")))

    return docs.mapInArrow(civil, docs.schema)


def keep_one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    classes = nj.similarity_classes(docs)
    spare = classes.where(F.col("doc_id") != F.col("component_id")).select("doc_id")
    kept = docs.join(spare, "doc_id", "left_anti")
    # Copies of one row have the same id and class, so they are told apart last, by id and text; where the join has
    # dealt the rows out by id, this needs no further shuffle. Different texts under one id all stay.
    return kept.withColumn("__own", F.xxhash64("text")).dropDuplicates(["doc_id", "__own"]).select(*docs.columns)


def with_text_keys(docs: DataFrame) -> DataFrame:
    """The rows with `__row`: one number for each pair of id and text, null for a null id.

    Where an id has several texts, the one with the smallest hash keeps the id as its number. The others get
    numbers of 2**62 and above, made of their hashes, so they count as later documents.
    """
    mark = F.xxhash64("text")
    several = settle(docs.where("doc_id is not null").groupBy("doc_id").agg(F.min(mark).alias("__least"), F.max(mark).alias("__most"))
                     .where("__least < __most").select("doc_id", "__least"), "several")
    other = F.shiftrightunsigned(F.xxhash64("doc_id", mark), 2).bitwiseOR(F.lit(1 << 62))
    return docs.join(several, "doc_id", "left").select(
        *docs.columns, F.when(mark != F.col("__least"), other).otherwise(F.col("doc_id").cast("long")).alias("__row"))


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages are found and cut in each text by itself, also where several texts share an id."""
    keyed = with_text_keys(docs)
    found = sc.repeated_passages(keyed, key="__row")
    spans = found.groupBy("__row").agg(F.collect_set(F.struct("start_word", "end_word")).alias("__spans"))
    joined = keyed.join(spans, "__row", "left").select(*docs.columns, "__spans")
    names = docs.columns
    place, count = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                spans, columns = part.column(part.num_columns - 1), part.columns[:-1]
                if spans.null_count < len(spans):
                    touched = [s.is_valid for s in spans]
                    texts = [without_spans(t.as_py(), s) if on and t.is_valid else t.as_py()
                             for t, s, on in zip(columns[place], spans, touched, strict=True)]
                    if count is not None:
                        sizes = zip(texts, columns[count].to_pylist(), touched, strict=True)
                        columns[count] = pa.array([len(t) if on and t is not None else n for t, n, on in sizes], columns[count].type)
                    columns[place] = pa.array(texts, columns[place].type)
                yield pa.record_batch(columns, names=names)

    return joined.mapInArrow(cut, docs.schema)


def without_spans(text: str, spans: pa.ListScalar) -> str:
    """The text without the words of the spans; white space before a word goes with it."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    starts, ends = ar.word_bounds(data, np.zeros(0, np.int64), ar.SPACE_TABLE)
    drop = np.zeros(len(starts) + 1, np.int64)
    for a, b in zip(spans.values.field("start_word").to_pylist(), spans.values.field("end_word").to_pylist(), strict=True):
        drop[min(a, len(starts))] += 1
        drop[min(b, len(starts))] -= 1
    gone = np.cumsum(drop[:-1]) > 0
    before = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    keep = np.zeros(len(data) + 1, np.int64)
    np.add.at(keep, before[gone], 1)
    np.add.at(keep, ends[gone], -1)
    return data[np.cumsum(keep[:-1]) == 0].tobytes().decode("utf-8", "surrogatepass").lstrip(" \t\n\v\f\r" if gone[:1].any() else "")


def keep_clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return dc.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def model_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sp.encode_pieces(docs, model_file())
