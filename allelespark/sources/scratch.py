"""Tables in the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession, kind: str = "table") -> str:
    """A new path under spark.checkpoint.dir; only a local session, where driver and tasks share a disk, may do without."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="spark-")
    return f"{folder.rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def kept(df: DataFrame) -> DataFrame:
    """The rows as a Parquet table there: what several results need is computed once, and outlives an executor."""
    path = shared_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
