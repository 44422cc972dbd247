"""Annotated documents as XML, hand-written test sentences, and archives."""

from __future__ import annotations

import io
import tarfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

_ARG = "STRUCT<_role: STRING, _mention_id: STRING, _score: DOUBLE>"
_EVENT = f"STRUCT<_id: STRING, _event_type: STRING, _anchor_node_id: STRING, _score: DOUBLE, EventMentionArg: ARRAY<{_ARG}>>"
_MENTION = "STRUCT<_id: STRING, _mention_type: STRING, _entity_type: STRING, _syn_node_id: STRING>"
_SENTENCE = f"STRUCT<_id: STRING, _char_offsets: STRING, Contents: STRING, MentionSet: STRUCT<Mention: ARRAY<{_MENTION}>>, EventMentionSet: STRUCT<EventMention: ARRAY<{_EVENT}>>>"
DOCUMENT = f"_docid STRING, _language STRING, OriginalText STRUCT<Contents: STRING>, Sentences STRUCT<Sentence: ARRAY<{_SENTENCE}>>"


def read_annotated(spark: SparkSession, path: str) -> DataFrame:
    """One row for each document, nested as in the file."""
    return spark.read.format("xml").option("rowTag", "Document").schema(DOCUMENT).load(path)


def sentences(documents: DataFrame) -> DataFrame:
    s = F.posexplode("Sentences.Sentence").alias("sentence", "s")
    out = documents.select(F.col("_docid").alias("doc_id"), s)
    ends = F.split("s._char_offsets", ":")
    return out.select("doc_id", "sentence", F.col("s._id").alias("sentence_id"), F.get(ends, F.lit(0)).cast("int").alias("start"), F.get(ends, F.lit(1)).cast("int").alias("end"), F.col("s.Contents").alias("text"), "s")


def mentions(documents: DataFrame) -> DataFrame:
    m = sentences(documents).select("doc_id", "sentence", F.explode("s.MentionSet.Mention").alias("m"))
    return m.select("doc_id", "sentence", F.col("m._id").alias("mention_id"), F.col("m._mention_type").alias("mention_type"), F.col("m._entity_type").alias("entity_type"))


def event_mentions(documents: DataFrame) -> DataFrame:
    e = sentences(documents).select("doc_id", "sentence", F.explode("s.EventMentionSet.EventMention").alias("e"))
    return e.select("doc_id", "sentence", F.col("e._id").alias("event_id"), F.col("e._event_type").alias("event_type"), F.col("e._score").alias("score"), F.col("e.EventMentionArg").alias("arguments"))


def event_arguments(documents: DataFrame) -> DataFrame:
    a = event_mentions(documents).select("doc_id", "event_id", F.explode("arguments").alias("a"))
    return a.select("doc_id", "event_id", F.col("a._role").alias("role"), F.col("a._mention_id").alias("mention_id"), F.col("a._score").alias("score"))


def from_sentences(spark: SparkSession, texts: list[str]) -> DataFrame:
    """Hand-written sentences as documents."""
    return spark.createDataFrame([(f"doc-{i}", t) for i, t in enumerate(texts)], "doc_id STRING, text STRING")


def _members(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for path, content in zip(b.column("path").to_pylist(), b.column("content").to_pylist()):
            with tarfile.open(fileobj=io.BytesIO(content)) as t:
                for m in t:
                    if m.isfile():
                        yield pa.RecordBatch.from_pydict({"archive": [path], "name": [m.name], "content": [t.extractfile(m).read()]})


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(archive, name, content) of the files in tar archives; an archive is read by one task."""
    raw = spark.read.format("binaryFile").load(path).select("path", "content")
    return raw.mapInArrow(_members, "archive STRING, name STRING, content BINARY")
