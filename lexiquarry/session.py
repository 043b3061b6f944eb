"""Session helpers: settings the jobs rely on, and written stage tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Runtime SQL settings the plans are written for. All are Spark defaults or harmless to repeat.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Stage folders of local sessions without a configured one; the setting itself is fixed at start.
_LOCAL_STAGE_DIRS: dict[str, str] = {}


def build_session(app_name: str = "lexiquarry", master: str | None = None, **conf: str) -> SparkSession:
    """Return a session with the recommended settings; `conf` uses `_` for `.` in keys."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(RECOMMENDED_CONF)
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def stage_dir(spark: SparkSession) -> str:
    """The shared folder for stage tables: `spark.checkpoint.dir`, or a temporary one in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_STAGE_DIRS:
        _LOCAL_STAGE_DIRS[application] = tempfile.mkdtemp(prefix="lexiquarry-stage-")
    return _LOCAL_STAGE_DIRS[application]


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{stage_dir(spark)}/lexiquarry/{name}-{uuid.uuid4().hex}"


# Spark's setting that deletes the shuffle files of a job as it ends, not when the driver next collects its garbage.
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_cleaned(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_CLEAN_UP, None)
    spark.conf.set(_CLEAN_UP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEAN_UP) if before is None else spark.conf.set(_CLEAN_UP, before)


# Folders of the stage tables that were written on the way to a part of `settle_parts`, innermost part last.
_ON_THE_WAY: ContextVar[tuple[list[str], ...]] = ContextVar("on_the_way", default=())


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as a stage table in the shared folder and read it back.

    Cuts the lineage, survives lost executors, and gives the planner the true file size, so it
    broadcasts the table only below `spark.sql.autoBroadcastJoinThreshold` and shuffles beyond. What was shuffled for it goes.
    """
    return settle_parts([lambda: df], name)


def settle_parts(parts: Iterable[Callable[[], DataFrame]], name: str) -> DataFrame:
    """One stage table of the rows of all parts, which are made and written one after another.

    Stage tables that were settled inside of the call of a part go as soon as it is written, so nothing else may read them later.
    """
    path, folders = None, _ON_THE_WAY.get()
    for part in parts:
        own: list[str] = []
        token = _ON_THE_WAY.set((*folders, own))
        try:
            df = part()
        finally:
            _ON_THE_WAY.reset(token)
        spark, schema = df.sparkSession, df.schema
        path = path or stage_path(spark, name)
        with _shuffles_cleaned(spark):
            df.write.mode("append").option("compression", "zstd").parquet(path)
        _delete(spark, own)
    if path is None:
        raise ValueError("no parts")
    for outer in folders[-1:]:
        outer.append(path)
    return spark.read.schema(schema).parquet(path)


def drop_settled(*tables: DataFrame) -> None:
    """Delete stage tables as `settle` returns them, once all that is made of them is settled too."""
    for table in tables:
        folders = {unquote(f.rsplit("/", 1)[0]) for f in table.inputFiles()}
        for folder in folders:
            if "/lexiquarry/" not in folder:
                raise ValueError(f"not a stage table: {folder}")
        _delete(table.sparkSession, folders)


def _delete(spark: SparkSession, folders: Iterable[str]) -> None:
    context = spark.sparkContext
    for folder in folders:
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def local_table(spark: SparkSession, rows: list[dict], schema: pa.Schema) -> DataFrame:
    """Turn a few argument rows into a DataFrame whose exact size the planner knows."""
    columns = {f.name: [row.get(f.name) for row in rows] for f in schema}
    return spark.createDataFrame(pa.table(columns, schema=schema))


# Generous size of one row of a table of query arguments or hits.
ROW_BYTES = 500


def broadcast_at_most(df: DataFrame, n_rows: int) -> DataFrame:
    """`df` with a broadcast hint if `n_rows` rows, its proven bound, are below the planner's own broadcast limit."""
    return F.broadcast(df) if n_rows * ROW_BYTES <= broadcast_limit(df.sparkSession) else df


def broadcast_limit(spark: SparkSession) -> int:
    """Bytes up to which the planner broadcasts by itself."""
    return size_in_bytes(spark.sql("set spark.sql.autoBroadcastJoinThreshold").first().value)


def size_in_bytes(text: str) -> int:
    """Bytes of a setting such as "10485760b", "10MB" or "-1"."""
    number = text.strip().lower().rstrip("b")
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}
    return int(number[:-1]) * units[number[-1]] if number[-1:] in units else int(number)
