"""Quality rules: base rules on counts, then gradient-boosted trees with monotonic constraints over document statistics."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from factloom.llm import stats, trees
from factloom.llm.language_id import held_out
from factloom.llm.runtime import ensure_importable, free

#: More of these can only lower the verdict.
LOWERS = ("symbols", "bang", "pipe", "bracket", "dup_lines", "repeat_words", "same_word_runs", "caps_words")
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: Documents below this probability of being good go; junk lies far below, so a lower bound spares clean ones.
VERDICT = 0.3


def training_rows(docs: DataFrame, labels: DataFrame, limit: int, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> tuple[np.ndarray, np.ndarray]:
    """Statistics and labels of at most ``limit`` labelled ids: those with the least hash. Held-out ids are left out.

    Only the statistics of the sample come to the driver. A label that an id has twice counts once, the smaller one; of the
    texts that an id has, the one with the least hash.
    """
    ensure_importable(docs.sparkSession)
    marked = labels.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{label_col}`").alias("_y"))
    marked = marked.where(~held_out("_id") & F.col("_y").isNotNull() & F.col("_id").isNotNull())
    # Only keys that may be among the first are ranked, so the ranking sees a few rows for each row of the sample.
    key = F.xxhash64(F.lit(9), "_id")
    share = min(1.0, (3 * limit + 1000) / max(marked.agg(F.approx_count_distinct("_id")).first()[0], 1))
    near = marked.where(key <= min(int(-(2**63) + share * 2**64), 2**63 - 1))
    picked = near.groupBy("_id").agg(F.min("_y").alias("_y")).orderBy(key, "_id").limit(limit)

    @F.arrow_udf("array<float>")
    def features(text: pa.Array) -> pa.Array:
        _, x = stats.measure(text)
        return pa.ListArray.from_arrays(np.arange(0, x.size + 1, len(stats.FEATURES), dtype=np.int32), pa.array(x.ravel()))

    joined = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_t")).join(F.broadcast(picked), "_id")  # at most ``limit`` rows
    least = F.min_by(F.struct("x"), F.coalesce(F.col("h"), F.lit(0)))
    rows = joined.select("_id", features("_t").alias("x"), F.xxhash64("_t").alias("h"), "_y").groupBy("_id", "_y").agg(least.alias("s")).select("_id", "s.x", "_y").toArrow()
    order = np.argsort(rows.column("_id").to_numpy(), kind="stable")
    x = np.array(rows.column("x").to_pylist(), np.float32).reshape(-1, len(stats.FEATURES))[order]
    return x, rows.column("_y").to_numpy().astype(float)[order]


def fit(docs: DataFrame, labels: DataFrame, limit: int = 6000, **columns) -> trees.Trees:
    """Trees that predict ``quality`` = 1 from the statistics of at most ``limit`` labelled rows."""
    x, y = training_rows(docs, labels, limit, **columns)
    return trees.fit(x, y, {stats.FEATURES.index(k): -1 for k in LOWERS})


def judge(docs: DataFrame, model: trees.Trees, text_col: str = "text", verdict: float = VERDICT) -> DataFrame:
    """docs with the counts of ``stats.BASE`` (long), base_failed boolean, score double and kept boolean.

    A null or empty text has zero words and fails the base rules. Without labelled rows of both classes the trees give one
    score for all: the share of ones, drawn towards one half. Columns of these names are replaced, all others stay.
    """
    spark = docs.sparkSession
    ensure_importable(spark)
    shared = spark.sparkContext.broadcast(model)
    fields = "".join(f"{k}:bigint," for k in stats.BASE)

    @F.arrow_udf(f"struct<{fields}score:double>")
    def judged(text: pa.Array) -> pa.Array:
        base, x = stats.measure(text)
        columns = [pa.array(base[:, k]) for k in range(base.shape[1])] + [pa.array(shared.value.probability(x))]
        return pa.StructArray.from_arrays(columns, [*stats.BASE, "score"])

    (own,) = free(docs, "_judged")
    added = {*stats.BASE, "base_failed", "score", "kept"}
    out = docs.withColumn(own, judged(F.col(f"`{text_col}`"))).select(*[F.col(f"`{c}`") for c in docs.columns if c not in added], f"{own}.*")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("score") >= verdict))
