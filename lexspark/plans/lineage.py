"""Cutting lineage in the shared folder the cluster names, and scratch tables in the same place."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_KEY = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session; a temporary one only for local masters without it."""
    named = spark.conf.get(_KEY, None)
    current = spark.sparkContext.getCheckpointDir()
    if named:
        if current is None:
            spark.sparkContext.setCheckpointDir(named)
        return named
    if current is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{_KEY} must name a folder shared by all executors")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lexspark-"))
        current = spark.sparkContext.getCheckpointDir()
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder for a table written and read back."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back.

    The result survives the loss of any executor, and its plan starts anew at a scan of known
    size. Loops need the latter too: a checkpointed DataFrame hands on the constraints of its
    old plan, which multiply from round to round.
    """
    path = scratch_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
