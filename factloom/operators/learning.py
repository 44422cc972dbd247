"""Pairs for metric learning, weighted similarity learnt by mini-batches, features."""

from __future__ import annotations


import numpy as np
from pyspark.sql import Column, DataFrame, functions as F


def pair_classes(df: DataFrame, group: str) -> DataFrame:
    """(intra, inter): numbers of unordered pairs within and across groups, from group sizes alone."""
    sizes = df.groupBy(group).agg(F.count("*").alias("n"))
    s = sizes.agg(F.sum("n").alias("t"), F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("intra"))
    return s.select(F.col("intra").cast("long").alias("intra"), (F.col("t") * (F.col("t") - 1) / 2 - F.col("intra")).cast("long").alias("inter"))


def sampled_pairs(df: DataFrame, item: str, group: str, partners: int, buckets: int = 64, key: Column | None = None) -> DataFrame:
    """(a, b, same): each item with ``partners`` others by a ring over a hashed order in salted buckets, so that pairs are as
    random as the hash and their number grows with the items, not with their square. Take a bucket for each million items.
    key: the hash, XXH64 of the item unless given."""
    from pyspark.sql import Window as W

    h = df.select(F.col(item).alias("a"), F.col(group).alias("g"), (F.xxhash64(F.lit(1), item) if key is None else key).alias("h"))
    w = W.partitionBy(F.pmod("h", F.lit(buckets))).orderBy("h", "a")
    leads = [F.struct(F.lead("a", k).over(w).alias("b"), F.lead("g", k).over(w).alias("gb")) for k in range(1, partners + 1)]
    return h.select("a", "g", F.array(*leads).alias("_o")).select("a", "g", F.explode("_o").alias("o")).where("o.b IS NOT NULL").select("a", F.col("o.b").alias("b"), (F.col("g") == F.col("o.gb")).alias("same"))


def feature_table(features: DataFrame, name: str) -> DataFrame:
    """Index of each feature, from 1 in the order of names; 0 is the bias. Feature names are few beside the data."""
    from factloom.operators.selection import numbered

    return numbered(features.select(name).distinct(), [name], "index").withColumn("index", F.col("index") + 1)


def fit_weights(x: np.ndarray, y: np.ndarray, rate: float = 0.5, epochs: int = 40, batch: int = 64, anneal: float = 0.95, seed: int = 0) -> np.ndarray:
    """Weights (first the bias) of a logistic model on pair features by mini-batches; weights of features stay positive or
    zero, and the rate falls by ``anneal`` each epoch."""
    rng = np.random.default_rng(seed)
    x = np.c_[np.ones(len(x)), x]
    w = np.zeros(x.shape[1])
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for lo in range(0, len(x), batch):
            b = order[lo : lo + batch]
            p = 1 / (1 + np.exp(-np.clip(x[b] @ w, -30, 30)))
            w -= rate * x[b].T @ (p - y[b]) / len(b)
            w[1:] = np.maximum(w[1:], 0)
        rate *= anneal
    return w


def weighted_score(features: list[Column], weights: np.ndarray) -> Column:
    out = F.lit(float(weights[0]))
    for f, w in zip(features, weights[1:]):
        out = out + f * float(w)
    return 1 / (1 + F.exp(-out))


def wu_palmer_pairs(pairs: DataFrame, closure: DataFrame, depth: DataFrame, a: str, b: str) -> DataFrame:
    """(a, b, similarity) by the deepest common ancestor. closure: (child, ancestor, distance) with each node its own
    ancestor at distance zero; depth: (node, depth) from the root."""
    x = closure.select(F.col("child").alias(a), "ancestor", F.col("distance").alias("_da"))
    y = closure.select(F.col("child").alias(b), "ancestor", F.col("distance").alias("_db"))
    both = pairs.join(x, a).join(y, [b, "ancestor"]).join(depth.select(F.col("node").alias("ancestor"), F.col("depth").alias("_d")), "ancestor")
    return both.groupBy(a, b).agg(F.max(2 * F.col("_d") / (F.col("_da") + F.col("_db") + 2 * F.col("_d"))).alias("similarity"))


def templates(tokens: DataFrame, doc: str, order: str, fields: dict[str, Column], offsets: list[tuple[tuple[str, int], ...]]) -> DataFrame:
    """(doc, order, feature): feature names like 'word[-1]|word[0]=a|b' for each template; one that leaves the sequence is skipped."""
    from pyspark.sql import Window as W

    w = W.partitionBy(doc).orderBy(order)
    t = tokens.select(doc, order, *[c.cast("string").alias(n) for n, c in fields.items()])
    out = []
    for template in offsets:
        parts = [F.lead(n, k).over(w) if k >= 0 else F.lag(n, -k).over(w) for n, k in template]
        ok = parts[0].isNotNull()
        for p in parts[1:]:
            ok = ok & p.isNotNull()
        name = "|".join(f"{n}[{k}]" for n, k in template)
        out.append(F.when(ok, F.concat(F.lit(f"{name}="), F.concat_ws("|", *parts))))
    return t.select(doc, order, F.array(*out).alias("_f")).select(doc, order, F.explode(F.array_compact("_f")).alias("feature"))


