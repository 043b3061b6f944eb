"""Rows that a step cannot take, set aside with their reasons while all others go on."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MALFORMED = "malformed record"
RECORD = "__record"
REASONS = "reasons"


@dataclass(frozen=True)
class Screened:
    """`rejected` has the columns of the input and `reasons`; `counts` the rows read, rejected, and those for each reason."""

    accepted: DataFrame
    rejected: DataFrame
    counts: dict[str, int]


def screen(rows: DataFrame, reasons: dict[str, Column], path: str) -> Screened:
    """Write the rows to `path`, those for which a condition holds apart from the others; a null condition does not hold.

    One pass writes both tables and counts, so the step that follows never meets a rejected row, and the report is there
    even where nobody asks for it.
    """
    held = [F.when(F.coalesce(condition, F.lit(False)), F.lit(name)) for name, condition in reasons.items()]
    found = F.array_compact(F.array(*held)).cast("array<string>")
    flagged = rows.withColumns({REASONS: found, "__rejected": F.size(found) > 0})
    seen = Observation(f"screen {path}")
    counts = [F.count_if(F.array_contains(REASONS, name)).alias(name) for name in reasons]
    flagged = flagged.observe(seen, F.count("*").alias("read"), F.count_if("__rejected").alias("rejected"), *counts)
    flagged.write.partitionBy("__rejected").parquet(path)
    spark = rows.sparkSession
    written = spark.read.schema(T.StructType([*flagged.schema.fields])).parquet(path)
    return Screened(written.where(~F.col("__rejected")).drop("__rejected", REASONS),
                    written.where("__rejected").drop("__rejected"), seen.get)


def read_csv_records(spark: SparkSession, path: str, columns: list[str] | None = None, multi_line: bool = True) -> DataFrame:
    """All-string rows of CSV files and `__record`, the text of a row that has not as many cells as there are columns, else null.

    Without `columns`, the header names them.
    """
    options = {"quote": '"', "escape": '"', "multiLine": multi_line, "header": columns is None}
    names = columns or [c for c in spark.read.csv(path, inferSchema=False, **options).columns]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, RECORD]])
    return spark.read.csv(path, schema=schema, mode="PERMISSIVE", columnNameOfCorruptRecord=RECORD, **options)


def screen_csv(spark: SparkSession, path: str, key: str, to: str, columns: list[str] | None = None, multi_line: bool = True,
               more: dict[str, Column] | None = None) -> Screened:
    """CSV rows that can be indexed: not malformed, with an id, and with none of the conditions `more`."""
    rows = read_csv_records(spark, path, columns, multi_line)
    malformed = F.col(RECORD).isNotNull()
    reasons = {MALFORMED: malformed, "no id": ~malformed & F.col(key).isNull(), **(more or {})}
    done = screen(rows, reasons, to)
    return Screened(done.accepted.drop(RECORD), done.rejected, done.counts)
