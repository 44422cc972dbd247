"""Session helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import os
import tempfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

ROOT = str(Path(__file__).resolve().parents[2])


def ensure_importable(spark: SparkSession) -> None:
    """Let local Python workers import this package whatever the driver's working directory.

    On a cluster ship the package with ``--py-files``; the entry is then only a path that does not exist.
    """
    env = spark.sparkContext.environment
    path = env.get("PYTHONPATH", "")
    if ROOT not in path.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (path, ROOT) if x)


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where it is unset, a temporary one, but only if all tasks run on this machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="factloom-")
    return folder


def free(df: DataFrame, *stems: str) -> list[str]:
    """Column names that df does not have, one for each stem."""
    taken = {c.lower() for c in df.columns}
    return [next(s for s in (stem + "_" * k for k in range(len(taken) + 1)) if s not in taken) for stem in stems]


def row_key(id_col: str, text_col: str) -> Column:
    """128 bits of a row's id and text."""
    row = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    return F.struct(F.xxhash64(*row).alias("x"), F.xxhash64(F.lit(1), *reversed(row)).alias("y"))


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the folder that the cluster names in ``spark.checkpoint.dir``.

    A folder of our own is set only where neither the session nor the context has one (tests on one machine).
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def keep_rows(docs: DataFrame, row: Column, rows: DataFrame) -> DataFrame:
    """docs without the rows whose key ``row`` does not stay, and once each of those that do. rows: row, times, stays."""
    names = docs.columns
    (own,) = free(docs, "_row")
    keyed = docs.withColumn(own, row)
    off = rows.where("not stays or times > 1").select(F.col("row").alias(own))
    kept = keyed.join(off, own, "left_anti").select(*[F.col(f"`{c}`") for c in names])
    again = cut(rows.where("stays and times > 1").select(F.col("row").alias(own)))
    if again.isEmpty():
        return kept
    hashed = [F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    once = keyed.join(again, own, "left_semi").groupBy(own).agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in names]), F.xxhash64(*hashed)).alias("kept_row"))
    return kept.unionByName(once.select("kept_row.*"))


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of frames that nothing refers to any more; else they stay until the driver happens
    to collect its garbage, and a job of many steps holds the disk of all of them."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
