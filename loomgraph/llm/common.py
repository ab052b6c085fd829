"""What the training-data operators share: table access, shared scratch space, Arrow helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Lets Python workers import this package when the driver runs outside the repository."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(x for x in (root, env.get("PYTHONPATH", "")) if x)


def scratch(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; a temporary one only where that is unset and Spark is local (tests)."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at is None:
        held = spark.sparkContext.getCheckpointDir()
        if held is None:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="loomgraph-"))
            held = spark.sparkContext.getCheckpointDir()
        at = held
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(at)
    return at


_written: list[str] = []


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a table in the shared folder and reads it: lineage ends, lost executors cost nothing.

    The table stays until release() or discard().
    """
    spark = df.sparkSession
    path = f"{scratch(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _written.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def discard(df: DataFrame) -> None:
    """Deletes the table behind what materialise() gave, which nothing may read any more."""
    path = df.written_to
    _delete(df.sparkSession, path)
    _written.remove(path)


def release(spark: SparkSession) -> None:
    """Deletes all tables that this process has written and not discarded; results that read them must be used by then."""
    while _written:
        _delete(spark, _written.pop())


def id_text(docs: DataFrame) -> DataFrame:
    """doc_id and text alone (extra columns go); a null text is empty."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def record_batch(columns: dict[str, tuple[list, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in columns.values()], names=list(columns))


def texts_of(batches, size: int = 256):
    """(ids, texts) in slices of at most `size` rows, so a few long texts never meet in one list."""
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            part = batch.slice(at, size)
            yield part.column("doc_id").to_pylist(), part.column("text").to_pylist()
