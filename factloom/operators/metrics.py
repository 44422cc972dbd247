"""Evaluation of clusterings, labels and rankings. Counts of pairs come from group sizes, never from pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from factloom.functions.scores import f1


def _cells(df: DataFrame, gold: str, pred: str) -> DataFrame:
    return df.groupBy(gold, pred).agg(F.count("*").alias("n"))


def pairwise_f(df: DataFrame, gold: str, pred: str) -> DataFrame:
    """Precision, recall and F1 over unordered pairs of one cluster."""
    pairs = lambda n: F.sum(n * (n - 1) / 2)
    c = _cells(df, gold, pred)
    both = c.agg(pairs(F.col("n")).alias("b"))
    g = c.groupBy(gold).agg(F.sum("n").alias("n")).agg(pairs(F.col("n")).alias("g"))
    p = c.groupBy(pred).agg(F.sum("n").alias("n")).agg(pairs(F.col("n")).alias("p"))
    out = both.crossJoin(g).crossJoin(p)  # one row each
    return out.select(F.col("b").alias("_b"), (F.col("b") / F.col("p")).alias("precision"), (F.col("b") / F.col("g")).alias("recall")).select("precision", "recall", f1(F.col("precision"), F.col("recall")).alias("f1"))


def bcubed(df: DataFrame, gold: str, pred: str) -> DataFrame:
    """Mean precision and recall of members over their neighbours, that is, the other members of their cluster.

    Members of gold clusters of one are left out of the mean; a member alone in its predicted cluster has precision zero.
    """
    share = lambda size: F.sum(F.when(F.col(size) > 1, F.col("n") * (F.col("n") - 1) / (F.col(size) - 1)).otherwise(0.0)) / F.sum("n")
    c = _cells(df, gold, pred)
    c = c.withColumn("g", F.sum("n").over(W.partitionBy(gold))).withColumn("p", F.sum("n").over(W.partitionBy(pred))).where("g > 1")
    means = c.agg(share("p").alias("precision"), share("g").alias("recall"))
    return means.select("precision", "recall", f1(F.col("precision"), F.col("recall")).alias("f1"))


def nmi(df: DataFrame, gold: str, pred: str) -> DataFrame:
    """Mutual information over the mean of both entropies, base 2."""
    c = _cells(df, gold, pred)
    total = c.agg(F.sum("n").alias("t"))
    c = c.crossJoin(total).withColumn("g", F.sum("n").over(W.partitionBy(gold))).withColumn("p", F.sum("n").over(W.partitionBy(pred)))
    entropy = lambda k: -F.sum(F.col("n") / F.col("t") * F.log2(F.col(k) / F.col("t")))
    out = c.agg(F.sum(F.col("n") / F.col("t") * F.log2(F.col("t") * F.col("n") / (F.col("g") * F.col("p")))).alias("mi"), entropy("g").alias("hg"), entropy("p").alias("hp"))
    return out.select("mi", F.when(F.col("hg") + F.col("hp") == 0, 1.0).otherwise(2 * F.col("mi") / (F.col("hg") + F.col("hp"))).alias("nmi"))


def precision_at(df: DataFrame, order: list[Column], hit: Column, n: int) -> DataFrame:
    """Share of hits among the first n."""
    return df.orderBy(*order).limit(n).agg(F.avg(hit.cast("double")).alias("precision"))


def typing_scores(df: DataFrame, gold: str, pred: str) -> DataFrame:
    """Strict, macro and micro precision, recall and F1 of label sets (arrays). A row without predictions counts."""
    g, p = F.array_distinct(gold), F.array_distinct(pred)
    both, ng, np_ = F.size(F.array_intersect(gold, pred)), F.size(g), F.size(p)
    exact = ((both == ng) & (both == np_)).cast("double")
    ratio = lambda a, b: F.when(b == 0, 0.0).otherwise(a / b)
    s = df.agg(
        F.avg(exact).alias("strict"), F.avg(ratio(both, np_)).alias("macro_p"), F.avg(ratio(both, ng)).alias("macro_r"),
        F.coalesce(F.sum(both) / F.sum(np_), F.lit(0.0)).alias("micro_p"), F.coalesce(F.sum(both) / F.sum(ng), F.lit(0.0)).alias("micro_r"),
    )
    return s.select("*", f1(F.col("macro_p"), F.col("macro_r")).alias("macro_f1"), f1(F.col("micro_p"), F.col("micro_r")).alias("micro_f1"))


def rank_scores(df: DataFrame, coherence: str, novelty: str) -> DataFrame:
    """z(coherence) - z(novelty) over all rows, with population deviations; zero where a deviation is zero."""
    stats = df.agg(*[f(c).alias(f"_{n}_{c}") for c in (coherence, novelty) for n, f in (("m", F.avg), ("s", F.stddev_pop))])
    z = lambda c: F.when(F.col(f"_s_{c}") == 0, 0.0).otherwise((F.col(c) - F.col(f"_m_{c}")) / F.col(f"_s_{c}"))
    return df.crossJoin(F.broadcast(stats)).withColumn("rank_score", z(coherence) - z(novelty)).select(*df.columns, "rank_score")
