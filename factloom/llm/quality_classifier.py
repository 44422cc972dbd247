"""Quality classifier: histogram gradient-boosted trees over document statistics, scored by vectorised traversal."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from factloom.llm import stats, trees
from factloom.llm.quality_rules import training_rows
from factloom.llm.runtime import ensure_importable

THRESHOLD = 0.7


def fit(docs: DataFrame, labels: DataFrame, limit: int = 8000, **columns) -> trees.Trees:
    """Trees for ``quality`` from the statistics of at most ``limit`` labelled rows that are not held out."""
    x, y = training_rows(docs, labels, limit, **columns)
    return trees.fit(x, y, trees=80, depth=5, rate=0.12)


def score(docs: DataFrame, model: trees.Trees, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """docs with score double (0 to 1) and predicted int (1 if score >= threshold), from the text alone.

    Null and empty texts are scored by the statistics of an empty text. Columns of these names are replaced.
    """
    spark = docs.sparkSession
    ensure_importable(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(text: pa.Array) -> pa.Array:
        return pa.array(shared.value.probability(stats.measure(text)[1]))

    out = docs.drop("score", "predicted").withColumn("score", scored(F.col(f"`{text_col}`")))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
