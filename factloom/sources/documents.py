"""Documents from JSON, CSV and TSV, sentences, chunks, crawls and annotations. Schemas are stated, never inferred."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

CDR = "document_id STRING, source_uri STRING, extracted_text STRING, content_type STRING, extracted_metadata STRUCT<Author:STRING, CreationDate:STRING, Pages:INT>"
METADATA = "doc_id STRING, cdr_path STRING, creation_date STRING, confidence DOUBLE, doc_type STRING, sgm_path STRING, cdr_uuid STRING, offset INT, author STRING, source_uri STRING"
CAUSAL = (
    "docid STRING, relation_type STRING, semantic_class STRING, connective_text STRING, prob DOUBLE, "
    "arg1_text ARRAY<STRING>, arg1_span_list ARRAY<ARRAY<INT>>, arg2_text ARRAY<STRING>, arg2_span_list ARRAY<ARRAY<INT>>"
)
PAPER = "paper_id STRING, metadata STRUCT<title:STRING>, abstract ARRAY<STRUCT<text:STRING>>, body_text ARRAY<STRUCT<text:STRING>>"
#: Connectives whose arguments come in the opposite order.
FLIPPED = ("after", "because", "since", "as", "due to", "as a result of")


def read_cdr(spark: SparkSession, path: str) -> DataFrame:
    """Documents with text; author and date default to UNKNOWN, tabs and line breaks in them become spaces."""
    raw = spark.read.schema(CDR).json(path, multiLine=True).where("extracted_text IS NOT NULL")
    known = lambda c: F.coalesce(F.regexp_replace(F.col(c), "[\\t\\r\\n]", " "), F.lit("UNKNOWN"))
    date = F.date_format(F.to_timestamp("extracted_metadata.CreationDate"), "yyyyMMdd")
    return raw.select(
        F.col("document_id").alias("doc_id"), F.col("source_uri"), F.col("extracted_text").alias("text"), F.col("content_type"), known("extracted_metadata.Author").alias("author"),
        F.coalesce(date, F.lit("UNKNOWN")).alias("creation_date"), F.col("extracted_metadata.Pages").alias("pages"),
    )


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Ten tab-separated columns without a header; the date is null where it is unknown."""
    df = spark.read.schema(METADATA).csv(path, sep="\t")
    return df.withColumn("creation_date", F.to_date(F.expr("try_to_timestamp(creation_date, 'yyyyMMdd')")))


def read_papers(spark: SparkSession, path: str) -> DataFrame:
    """Scientific papers: abstract paragraphs, an empty line, and the body."""
    join_ = lambda c: F.array_join(F.transform(c, lambda p: p["text"]), "\n")
    return spark.read.schema(PAPER).json(path, multiLine=True).select(F.col("paper_id").alias("doc_id"), F.concat_ws("\n\n", join_("abstract"), join_("body_text")).alias("text"))


def paper_date(value: Column) -> Column:
    return F.coalesce(F.try_to_timestamp(value, F.lit("yyyy-MM-dd")), F.try_to_timestamp(value, F.lit("yyyy")))


def read_causal(spark: SparkSession, path: str) -> DataFrame:
    """Causal relations with one span for each argument; arguments swap for connectives that name the effect first."""
    df = spark.read.schema(CAUSAL).json(path, multiLine=True)
    flip = F.lower("connective_text").isin(*FLIPPED)
    side = lambda k, part: F.when(flip, F.col(f"arg{3 - k}_{part}")).otherwise(F.col(f"arg{k}_{part}"))[0]
    out = df.withColumn("doc_id", F.regexp_replace("docid", r"\.(xml|sgm|txt|json)$", ""))
    spans = [c for k in (1, 2) for c in (side(k, "text").alias(f"arg{k}_text"), side(k, "span_list")[0].alias(f"arg{k}_start"), side(k, "span_list")[1].alias(f"arg{k}_end"))]
    return out.select("doc_id", "relation_type", "semantic_class", "connective_text", "prob", *spans)


def attach_events(relations: DataFrame, events: DataFrame, models: list[str]) -> DataFrame:
    """Each argument gets the event of the same span in its document, from the first model of ``models`` that has one."""
    rank = F.array_position(F.array(*[F.lit(m) for m in models]), F.col("model"))
    best = events.where(rank > 0).groupBy("doc_id", "start", "end").agg(F.min_by("event_id", F.struct(rank, F.col("event_id"))).alias("event_id"))
    out = relations
    for k in (1, 2):
        e = best.select("doc_id", F.col("start").alias(f"arg{k}_start"), F.col("end").alias(f"arg{k}_end"), F.col("event_id").alias(f"event{k}"))
        out = out.join(e, ["doc_id", f"arg{k}_start", f"arg{k}_end"])
    return out.where("event1 <> event2")


def sentences(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, sent, s, start_char): lines in order with the offset of their first character."""
    s = docs.select("doc_id", F.posexplode(F.split(text, "\n")).alias("sent", "s")).withColumn("sent", F.col("sent").cast("long"))
    before = F.sum(F.length("s").cast("long") + 1).over(W.partitionBy("doc_id").orderBy("sent").rowsBetween(W.unboundedPreceding, -1))
    return s.withColumn("start_char", F.coalesce(before, F.lit(0).cast("long")))


def mark_first(text: Column, pattern: str) -> Column:
    """Double brackets around the first match of a pattern."""
    hit = F.regexp_substr(text, F.lit(pattern))
    at = F.instr(text, hit)
    return F.when(hit.isNull(), text).otherwise(F.concat(F.substring(text, F.lit(1), at - 1), F.lit("[["), hit, F.lit("]]"), F.substring(text, at + F.length(hit), F.length(text))))


def split_text(text: str, limit: int) -> list[str]:
    """Near-equal chunks: once a chunk has its share of the text, it ends at the next white space after a full stop."""
    n = max(1, -(-len(text) // limit))
    target = -(-len(text) // n) if text else 0
    out, lo, at = [], 0, 0
    while n > 1 and (at := lo + target) < len(text):
        while at < len(text) and not (text[at].isspace() and text[at - 1] == "."):
            at += 1
        out.append(text[lo:at])
        lo = at
    out.append(text[lo:])
    return [x for x in out if x] or [""]


def chunks(docs: DataFrame, limit: int) -> DataFrame:
    """(doc_id, idx, chunk, char_offset, chunk_id). Where a text may break depends on what stands before, so the split runs in
    Arrow batches; offsets are a running sum by document."""

    @F.arrow_udf("array<string>")
    def split(column: pa.Array) -> pa.Array:
        return pa.array([split_text(x, limit) for x in column.to_pylist()], pa.list_(pa.string()))

    parts = docs.where("text IS NOT NULL").select("doc_id", F.posexplode(split(F.col("text"))).alias("idx", "chunk"))
    before = F.sum(F.length("chunk").cast("long")).over(W.partitionBy("doc_id").orderBy("idx").rowsBetween(W.unboundedPreceding, -1))
    return parts.select("doc_id", "idx", "chunk", F.coalesce(before, F.lit(0).cast("long")).alias("char_offset"), F.concat(F.lit("doc_"), "doc_id", F.lit("_"), "idx").alias("chunk_id"))


def resume(wanted: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What is not processed yet."""
    return wanted.join(done.select(key), key, "left_anti")


def fetch(wanted: DataFrame, get, schema: str) -> DataFrame:
    """Rows that ``get`` (a list of keys to a list of tuples) finds, asked in batches on the executors; unknown keys give none."""
    from pyspark.sql.types import StructType

    names = StructType.fromDDL(schema).fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = get(batch.column(0).to_pylist())
            columns = list(zip(*rows)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    return wanted.mapInArrow(run, schema)
