"""Where intermediate tables go: the shared folder the cluster names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or the checkpoint folder already set on the context.

    Only a local session may fall back on a folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if named is None:
        named = context.getCheckpointDir()
    if named is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        named = tempfile.mkdtemp(prefix="revaudit-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared folder and read back: later uses neither recompute the table
    nor depend on executors that may be lost."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    # the schema is known: no job has to read it from the files
    return df.sparkSession.read.schema(df.schema).parquet(path)
