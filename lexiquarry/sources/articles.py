"""Article tables: typed schema, CSV reading, row cuts, date checks, JSON and stage outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiquarry.functions.text import valid_date

# Columns of an article table in declared order, and which of them are special.
ARTICLE_FIELDS = (
    "cord_uid", "sha", "source_x", "title", "pr_title", "doi", "pmcid", "license", "abstract", "pr_abstract",
    "publish_time", "authors", "journal", "who_covidence_id", "arxiv_id", "pdf_json_files", "pmc_json_files",
    "url", "s2_id")
PROCESSED_FIELDS = {"pr_title": "title", "pr_abstract": "abstract"}
NOT_SEARCHABLE = {"cord_uid"}
RANKED_FIELDS = {"title", "pr_title", "abstract", "pr_abstract"}
DATE_FIELDS = {"publish_time"}


def article_schema(date_as_text: bool = False) -> T.StructType:
    """The declared mapping as a schema; search traits sit in the field metadata."""
    fields = []
    for name in ARTICLE_FIELDS:
        is_date = name in DATE_FIELDS and not date_as_text
        traits = {"searchable": name not in NOT_SEARCHABLE}
        if name in RANKED_FIELDS:
            traits["similarity"] = "BM25"
        fields.append(T.StructField(name, T.DateType() if is_date else T.StringType(), True, traits))
    return T.StructType(fields)


def searchable_fields(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if f.metadata.get("searchable")]


def read_articles_csv(spark: SparkSession, path: str) -> DataFrame:
    """All-string article table from CSV with a header and quoted cells that may span lines.

    Columns are taken by their header name: others are left out, missing ones are null, and the order does
    not matter. All files of a folder have the same header. A quoted multi-line CSV file cannot be split, so
    give a folder of files rather than one big file; for repeated work convert it to parquet once.
    """
    rows = spark.read.csv(path, header=True, inferSchema=False, multiLine=True, quote='"', escape='"')
    names = [n for n in ARTICLE_FIELDS if n not in PROCESSED_FIELDS]
    return rows.select(*[
        (F.col(f"`{n}`") if n in rows.columns else F.lit(None).cast("string")).alias(n) for n in names])


def with_processed_copies(articles: DataFrame) -> DataFrame:
    """Add the columns that later steps rewrite, leaving the raw ones as they are."""
    return articles.withColumns({new: F.col(raw) for new, raw in PROCESSED_FIELDS.items()})


def validate_dates(articles: DataFrame, raw: str = "publish_time", to: str | None = None) -> DataFrame:
    """Replace a date text by a DATE, null when it is not a full date."""
    return articles.withColumn(to or raw, valid_date(F.col(raw)))


def rejected_dates(articles: DataFrame, raw: str = "publish_time") -> DataFrame:
    """Each date text that `validate_dates` turns into null, with its number of rows."""
    return (articles.where(F.col(raw).isNotNull() & valid_date(F.col(raw)).isNull())
            .groupBy(F.col(raw).alias("rejected")).agg(F.count("*").alias("n_rows")))


def tail_rows(rows: DataFrame, n: int = 1000, key: str | None = None) -> DataFrame:
    """Last n rows, last first. Without a key column the read order of the files counts."""
    if key:
        return rows.orderBy(F.col(key).desc()).limit(n)
    order = "__read_order"
    return (rows.withColumn(order, F.monotonically_increasing_id())
            .orderBy(F.col(order).desc()).limit(n).drop(order))


def head_rows(rows: DataFrame, n: int = 1000, key: str | None = None) -> DataFrame:
    """First n rows; give a key column for a repeatable result."""
    return rows.orderBy(key).limit(n) if key else rows.limit(n)


def to_typed(articles: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """Select and cast the columns a schema declares, keeping its metadata; missing ones are null."""
    wanted = schema or article_schema()
    present = set(articles.columns)

    def column(field: T.StructField) -> Column:
        source = F.col(field.name) if field.name in present else F.lit(None)
        if isinstance(field.dataType, T.DateType) and dict(articles.dtypes).get(field.name) == "string":
            source = valid_date(source)
        return source.cast(field.dataType).alias(field.name, metadata=field.metadata)

    return articles.select(*[column(f) for f in wanted.fields])


def rows_as_json(rows: DataFrame, key: str) -> DataFrame:
    """One JSON document per row next to its key; null columns are kept as JSON nulls."""
    return rows.select(
        F.col(key), F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("document"))


def write_json_documents(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_comparison(comparison: DataFrame, path: str, file_format: str = "parquet") -> None:
    """Write a flat comparison table, one folder per query."""
    writer = comparison.write.mode("overwrite").partitionBy("query_id")
    if file_format == "csv":
        writer.csv(path, header=True, escape='"')
    else:
        writer.format(file_format).save(path)
