"""Mini-batches: a pool in which the last message of a key counts, and runs of a stream until its input is used up."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from factloom.operators.selection import first_by
from factloom.sources.checkpoints import shared_folder


def pool(messages: DataFrame, keys: list[str], order: list[str], processed: DataFrame | None) -> DataFrame:
    """The last message of each key, without keys that are in ``processed``."""
    last = first_by(messages, keys, [F.col(c).desc() for c in order])
    return last if processed is None else last.join(processed.select(*keys), keys, "left_anti")


def folder(spark: SparkSession) -> str:
    """A new folder where all machines of the session can write."""
    return f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"


def stream_of(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet file or folder as a stream."""
    schema = spark.read.parquet(path).schema
    parent, _, name = path.rpartition("/")
    return spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{parent}/{name}*")


def process(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Hand each mini-batch that is available to ``handle`` and stop."""
    stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def run_once(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """All messages of a stream, by way of mini-batches written each under its number: a batch that is run again replaces
    itself, and of a key that comes in several batches the first one counts, so nothing comes twice."""
    out = folder(spark)

    def write(batch: DataFrame, number: int) -> None:
        batch.dropDuplicates(keys).write.mode("overwrite").parquet(f"{out}/rows/batch={number}")

    process(stream_of(spark, path), write, f"{out}/checkpoint")
    return first_by(spark.read.parquet(f"{out}/rows"), keys, ["batch"]).drop("batch")


def window_counts(spark: SparkSession, path: str, at: str, width: str, keys: list[str]) -> DataFrame:
    """Counts by window and key of a stream with a watermark, in update mode: the state drops windows that the watermark has
    passed, each batch writes the counts that it changed, and the last batch that has a window counts."""
    out = folder(spark)
    s = stream_of(spark, path).withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, "1 day")
    counts = s.groupBy(F.window(at, width).alias("w"), *keys).agg(F.count("*").alias("n"))

    def write(batch: DataFrame, number: int) -> None:
        batch.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), *keys, "n").write.mode("overwrite").parquet(f"{out}/rows/batch={number}")

    counts.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return first_by(spark.read.parquet(f"{out}/rows"), ["window_start", *keys], [F.col("batch").desc()]).drop("batch")
