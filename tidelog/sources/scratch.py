"""Shared folder for intermediate tables."""

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

_DIR = "spark.checkpoint.dir"


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only in local mode.

    The folder must be one that the driver and all executors see (a mounted one may have a
    `file:` path).  What is written there stays until the folder is removed, after the
    session: tables may still be read from it.
    """
    context = spark.sparkContext
    named = spark.conf.get(_DIR, None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise ValueError(f"set {_DIR} to a folder that every executor can reach")
    return _local_folder(context.applicationId)


@cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="tidelog-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Write the rows out and read them back: later uses neither recompute nor differ."""
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
