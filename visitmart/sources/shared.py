"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path under ``spark.checkpoint.dir``; only a local session without it (tests) gets a folder of its own.
    On a cluster each machine would write to a disk that the others don't see, so that its absence is an error."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="spark-shared-"))
        root = context.getCheckpointDir()
    return f"{root.rstrip('/')}/visitmart/{name}-{uuid.uuid4().hex}"


def written_once(df: DataFrame, name: str) -> DataFrame:
    """``df`` as files in the shared folder: what made it runs once, each reader scans only the columns it needs, and a lost
    executor costs no more than its running tasks. The files stay until that folder is cleaned."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
