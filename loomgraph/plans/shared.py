"""Cutting lineage in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import NullType


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a temporary folder only where that is unset and Spark is local (tests)."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at is None and spark.sparkContext.getCheckpointDir() is None and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(at or tempfile.mkdtemp(prefix="loomgraph-"))
    return at or spark.sparkContext.getCheckpointDir()


def checkpoint(df: DataFrame) -> DataFrame:
    """df as a table in the shared folder: its rows are reckoned once, and its size is known to later joins."""
    folder = shared_folder(df.sparkSession)
    if any(isinstance(f.dataType, NullType) for f in df.schema):  # Parquet has no column of nothing
        return df.checkpoint()
    path = f"{folder}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
