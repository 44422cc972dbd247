"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from factloom.llm import decontaminate, html_extract, language_id, license_scan, packing, pii_surrogates, quality_classifier, quality_rules, sharding, simhash, stats, trees
from factloom.llm.runtime import table

#: Key of the surrogates in the registered query and in the pipeline; a deployment gives its own.
PII_KEY = "factloom-demonstration-key"


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs)
    out = language_id.identify(docs.select("doc_id", "text"), model)
    return out.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("row_key")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_texts(table(spark, sf_dir, "documents"))


def op4_external_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.external_shuffle(table(spark, sf_dir, "documents"), 24)
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + sharding.RECORD_BYTES
    crc = F.crc32(F.coalesce("text", F.lit("")))
    return out.select("doc_id", size.alias("size"), crc.alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_rules.fit(docs, table(spark, sf_dir, "labels"))
    out = quality_rules.judge(docs.select("doc_id", "text"), model)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_classifier.fit(docs, table(spark, sf_dir, "labels"))
    out = quality_classifier.score(docs.select("doc_id", "text"), model)
    return out.select("doc_id", language_id.held_out().alias("held_out"), "score", "predicted")


def op9_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_surrogates.replace_pii(table(spark, sf_dir, "documents"), PII_KEY).select("doc_id", "text", "n_entities", "kinds")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = license_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", *license_scan.FIELDS)


def conversation_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations whole in sequences under limits that all bind: tokens, examples, and tokens of the assistant."""
    limits = packing.Limits(tokens=4096, segments=4, loss=3200)
    return packing.pack_conversations(table(spark, sf_dir, "conversations"), limits=limits).withColumnRenamed("doc_id", "conv_id").withColumnRenamed("doc_tokens", "conv_tokens")


def quality_base_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts and base rules of op7, which SQL can express as well."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    none = trees.fit(np.zeros((0, len(stats.FEATURES)), np.float32), np.zeros(0))
    return quality_rules.judge(docs, none).select("doc_id", *stats.BASE, "base_failed")


def license_base_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base columns of op10, which SQL can express as well."""
    return op10_license_scan(spark, sf_dir).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")


def shard_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, sizes and slots of op4's shards; SQL has the law that they follow."""
    out = op4_external_shuffle(spark, sf_dir).groupBy("shard").agg(F.count("*").alias("n"), F.min("slot").alias("first_slot"), F.max("slot").alias("last_slot"), F.sum("size").alias("size"))
    total = F.sum("size").over(W.partitionBy())  # 24 rows
    return out.withColumn("total", total).select("shard", "n", "first_slot", "last_slot", "total")


QUERIES = {
    f.__name__: f
    for f in (
        op1_language_id, op2_decontamination, op3_packing, op4_external_shuffle, op5_simhash, op6_html_text, op7_quality_rules,
        op8_quality_classifier, op9_pii_surrogates, op10_license_scan, conversation_packing, quality_base_counts, license_base_places, shard_rows,
    )
}

_WORD = r"[^\x20\x09-\x0D]+"
_TOKEN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The contracts' own columns that SQL can express; the rest (models, hashes, shuffles, markup) is held against brute force in tests/llm.
ORACLE_SQL: dict[str, str] = {
    "quality_base_counts": rf"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), w AS (SELECT doc_id, t, regexp_extract_all(t, '{_WORD}') AS ws FROM d),
        g AS (SELECT doc_id, p, array_to_string(ws[p + 1 : p + 5], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(len(ws) - 4)) AS p FROM w WHERE len(ws) >= 5)),
        r AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + 5)) AS q FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g) WHERE c > 1) GROUP BY 1),
        u AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d) WHERE regexp_matches(l, '{_WORD}') GROUP BY 1)
        SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
          coalesce(u.n, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words, len(ws) < 10 OR 100 * coalesce(r.n, 0) > 20 * len(ws) AS base_failed FROM w LEFT JOIN u USING (doc_id) LEFT JOIN r USING (doc_id)
    """,
    "license_base_places": rf"""
        WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_TOKEN}') AS ws FROM documents),
        h AS (SELECT doc_id, len(ws)::BIGINT AS n_words, list_filter(range(len(ws)), lambda i: ws[i + 1 : i + 2] = ['mit', 'license']) AS m, list_filter(range(len(ws)), lambda i: ws[i + 1 : i + 2] = ['apache', 'license']) AS a,
          list_filter(range(len(ws)), lambda i: ws[i + 1 : i + 3] = ['general', 'public', 'license']) AS g FROM w)
        SELECT doc_id, n_words, (len(m) + len(a) + len(g))::BIGINT AS n_base, list_min(m || a || g) AS first_word, list_max(m || a || g) AS last_word,
          array_to_string(list_filter([CASE WHEN len(a) > 0 THEN 'apache' END, CASE WHEN len(g) > 0 THEN 'gpl' END, CASE WHEN len(m) > 0 THEN 'mit' END], lambda x: x IS NOT NULL), ',') AS base_labels FROM h
    """,
    "shard_rows": """
        WITH t AS (SELECT count(*) AS n, sum(coalesce(strlen(text), 0) + 8)::BIGINT AS total FROM documents), s AS (SELECT k AS shard, ((k + 1) * n + 23) // 24 - (k * n + 23) // 24 AS n, total FROM t, (SELECT unnest(range(24)) AS k))
        SELECT shard::INTEGER AS shard, n, 0::BIGINT AS first_slot, n - 1 AS last_slot, total FROM s WHERE n > 0
    """,
}
