"""Structured inputs: tables of files and the causal relationships between their columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

_REF = "STRUCT<descriptor: STRUCT<inputId: STRING, frameIdx: INT, entryIdx: INT>>"
RELATIONSHIP = f"STRUCT<type: STRING, cause: {_REF}, effect: {_REF}, confidence: STRUCT<reliability: STRING>>"
SCHEMA = f"schema STRING, relationships ARRAY<{RELATIONSHIP}>"


def read_structured(spark: SparkSession, path: str) -> DataFrame:
    """One row for each relationship: the inference's address, the position in its file, the relationship."""
    raw = spark.read.schema(SCHEMA).json(path, multiLine=True)
    return raw.select("schema", F.posexplode("relationships").alias("position", "relationship"))


def factor_id(ref: Column) -> Column:
    d = ref["descriptor"]
    return F.concat_ws("-", F.lit("Factor"), d["inputId"], d["frameIdx"].cast("string"), d["entryIdx"].cast("string"))


def worksheet_id(ref: Column) -> Column:
    d = ref["descriptor"]
    return F.concat_ws("-", F.lit("Worksheet"), d["inputId"], d["frameIdx"].cast("string"))


def causal_relations(df: DataFrame, key: str, relationship: str) -> DataFrame:
    """(relation, kind, cause, cause_sheet, effect, effect_sheet, reliability); reliability is low unless stated."""
    r = F.col(relationship)
    return df.where(r.isNotNull()).select(
        F.concat(F.lit("Relationship-"), F.col(key).cast("string")).alias("relation"), r["type"].alias("kind"),
        factor_id(r["cause"]).alias("cause"), worksheet_id(r["cause"]).alias("cause_sheet"),
        factor_id(r["effect"]).alias("effect"), worksheet_id(r["effect"]).alias("effect_sheet"),
        F.coalesce(r["confidence"]["reliability"], F.lit("low")).alias("reliability"),
    )


def relation_triples(relations: DataFrame) -> DataFrame:
    """(s, p, o) of causal relations."""
    po = [F.struct(F.lit(p).alias("p"), F.col(c).alias("o")) for p, c in (("type", "kind"), ("has_cause", "cause"), ("has_effect", "effect"), ("reliability", "reliability"))]
    return relations.select(F.col("relation").alias("s"), F.inline(F.array(*po))).where("o IS NOT NULL")
