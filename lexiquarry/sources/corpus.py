"""Views a `documents` table as an article table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiquarry.functions.text import valid_date

FIRST_SENTENCE = r"^([^.!?\n]*)"


def documents_as_articles(documents: DataFrame) -> DataFrame:
    """Columns doc_id, title, abstract, lang, source, publish_raw of a `documents` table.

    The title is the first sentence. `publish_raw` imitates the date column of an article table:
    mostly full dates, some years only, some nulls.
    """
    last_digit = F.col("doc_id") % 10
    date = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("doc_id") % 700).cast("int"))
    return documents.select(
        "doc_id",
        F.regexp_extract("text", FIRST_SENTENCE, 1).alias("title"),
        F.col("text").alias("abstract"),
        "lang",
        "source",
        F.when(last_digit == 0, F.lit("2020"))
        .when(last_digit == 1, F.lit(None).cast("string"))
        .otherwise(F.date_format(date, "yyyy-MM-dd")).alias("publish_raw"),
    )


# Session setting: deal the documents out to so many partitions before anything else. Unset by default; of use
# where the files have fewer row groups than the cluster has cores.
PARTITIONS = "lexiquarry.corpus.partitions"


def load_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article view of `<sf_dir>/documents.parquet` with checked `publish_time`."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    partitions = spark.conf.get(PARTITIONS, None)
    if partitions:
        documents = documents.repartition(int(partitions))
    return documents_as_articles(documents).withColumn("publish_time", valid_date(F.col("publish_raw")))
