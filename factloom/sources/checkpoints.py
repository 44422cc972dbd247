"""Reliable checkpoints in the folder that the session names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where it is unset, a temporary one, but only if all tasks run on this machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="factloom-")
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def bounded(df: DataFrame, rows: int = 10_000) -> DataFrame:
    """A table to be joined with another: a broadcast if it has been counted and is small, else as it is."""
    from pyspark.sql import functions as F

    kept = cut(df)
    return F.broadcast(kept) if kept.count() <= rows else kept
