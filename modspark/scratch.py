"""Intermediate tables in the folder that the session names for checkpoints."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def scratch_folder(spark: SparkSession, name: str = "modspark") -> str:
    """A new path under ``spark.checkpoint.dir`` or the context's checkpoint folder.

    A session with neither uses a local folder if it is local itself; on a cluster executors would
    each write to their own disk, so there it is an error.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not re.match(r"local(\[[^]]*\])?$", master):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all machines of {master} share")
        root = tempfile.mkdtemp(prefix="modspark-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Write a frame and read it back: computed once, and lost executors lose nothing."""
    path = scratch_folder(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def freed_shuffles(spark: SparkSession):
    """Inside, the shuffle files of each query are removed when it ends.

    For use around writes of intermediate tables, whose shuffles nobody reads again.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)
