"""A folder that driver and executors share, for tables that a job writes and reads again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession, name: str) -> str:
    """A new path under spark.checkpoint.dir. Where that is unset, a temporary folder, in local mode only: on a cluster executors
    would write what nobody else can read."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="spark-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as it stands in a folder that tasks share, so that it is computed once."""
    at = scratch(df.sparkSession, name)
    df.write.parquet(at)
    return df.sparkSession.read.parquet(at)
