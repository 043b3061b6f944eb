"""Stage tables in the cluster's shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from lexiquarry.session import drop_settled, settle, stage_dir

__all__ = ["drop_settled", "settle", "stage_path"]


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh path below `spark.checkpoint.dir`, or below a local folder where that is unset."""
    return f"{stage_dir(spark)}/lexiquarry/{name}-{uuid.uuid4().hex}"

