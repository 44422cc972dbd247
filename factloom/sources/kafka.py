"""Messages from Kafka: the key is a document's uuid, the value JSON with its ontologies. Needs Spark's Kafka package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from factloom.streaming.minibatch import pool

VALUE = "ontologies ARRAY<STRUCT<ontology: STRING>>"


def messages(spark: SparkSession, servers: str, topic: str, per_batch: int) -> DataFrame:
    """The topic as a stream of at most ``per_batch`` messages a batch."""
    raw = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("maxOffsetsPerTrigger", per_batch).load()
    return parse(raw)


def parse(raw: DataFrame) -> DataFrame:
    """(ontology, doc_id, at): one row for each ontology of a message; messages that can't be read give none."""
    value = F.from_json(F.col("value").cast("string"), VALUE)
    rows = raw.select(F.col("key").cast("string").alias("doc_id"), F.col("timestamp").alias("at"), F.explode(value["ontologies"]["ontology"]).alias("ontology"))
    return rows.where("doc_id IS NOT NULL AND ontology IS NOT NULL")


def run(stream: DataFrame, processed: str, handle: Callable[[DataFrame, str], None], checkpoint: str, wait: str = "30 seconds"):
    """Start a query that, at most every ``wait``, takes the new documents of each ontology and hands them to ``handle``.

    The last message of a (ontology, document) counts; pairs in the table of processed ones are skipped, and a batch's pairs
    are written under its number, so that a batch that is run again changes nothing.
    """

    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        try:
            done = spark.read.parquet(processed).where(F.col("batch") != number)
        except Exception as e:  # the table of the first batch
            if "PATH_NOT_FOUND" not in str(e):
                raise
            done = None
        new = pool(batch, ["ontology", "doc_id"], ["at"], done).persist()
        for row in new.select("ontology").distinct().collect():  # versions in use, a handful
            handle(new.where(F.col("ontology") == row.ontology), row.ontology)
        new.select("ontology", "doc_id").write.mode("overwrite").parquet(f"{processed}/batch={number}")
        new.unpersist()

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(processingTime=wait).start()
