"""Grounding of mentions to an ontology given as a table of paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from factloom.operators.selection import first_by, top_by


def back_off(df: DataFrame, item: str, path: str, mapping: DataFrame, key: str, sep: str = "/") -> DataFrame:
    """(item, key, depth): the deepest prefix of a path that the mapping has; items without one are left out."""
    parts = F.split(F.col(path), sep)
    prefixes = df.select(item, F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, F.lit(1), n), sep).alias(key)))).alias("_p"))
    hits = prefixes.select(item, "_p.*").join(mapping.select(key).distinct(), key)
    return first_by(hits, [item], [F.col("depth").desc()]).select(item, key, "depth")


def external_types(df: DataFrame, kind: str, mapping: DataFrame, flag: str) -> DataFrame:
    """External types of internal ones. mapping: internal, flag, external."""
    return df.join(mapping.where(F.col("flag") == flag).select(F.col("internal").alias(kind), "external"), kind)


def internal_types(df: DataFrame, kind: str, mapping: DataFrame, flag: str) -> DataFrame:
    return df.join(mapping.where(F.col("flag") == flag).select(F.col("external").alias(kind), "internal"), kind)


def ground(scores: DataFrame, mention: str, node: str, modes: list[str], entry_points: DataFrame | None = None, blacklist: DataFrame | None = None, threshold: float = 0.0, k: int = 1, decay: float = 0.9) -> DataFrame:
    """The k best nodes of each mention. scores: mention, node, mode, score. The modes are tried in order and each one that
    fails costs a factor; a node keeps its best score, held within 1. entry_points: (mention, prefix) of allowed subtrees."""
    order = F.array_position(F.array(*[F.lit(m) for m in modes]), F.col("mode"))
    s = scores.where(order > 0).withColumn("_w", F.least(F.col("score") * F.pow(F.lit(decay), order - 1), F.lit(1.0)))
    if entry_points is not None:
        s = s.join(entry_points, mention).where((F.col(node) == F.col("prefix")) | F.col(node).startswith(F.concat("prefix", F.lit("/")))).drop("prefix")
    if blacklist is not None:
        s = s.join(blacklist.select(mention, node), [mention, node], "left_anti")
    best = s.groupBy(mention, node).agg(F.max("_w").alias("score")).where(F.col("score") >= threshold)
    return top_by(best, [mention], [F.col("score").desc(), node], k)


def upsert(groundings: Column, kind: Column, score: Column) -> Column:
    """An array of (type, score) with the type's score replaced, or the pair at the end."""
    new = F.struct(kind.alias("type"), score.alias("score"))
    return F.when(F.exists(groundings, lambda g: g["type"] == kind), F.transform(groundings, lambda g: F.when(g["type"] == kind, new).otherwise(g))).otherwise(F.concat(groundings, F.array(new)))


def match(queries: DataFrame, corpus: DataFrame, k: int) -> DataFrame:
    """Corpus mentions by the product of type scores, best type for each, top k. Both: id, type, score (query/mention)."""
    hits = queries.select("query", "type", F.col("score").alias("_q")).join(corpus.select("mention", "type", F.col("score").alias("_c")), "type")
    best = hits.groupBy("query", "mention").agg(F.max(F.col("_q") * F.col("_c")).alias("score"))
    return top_by(best, ["query"], [F.col("score").desc(), "mention"], k)


def with_entities(hits: DataFrame, mention: str, entities: DataFrame, all_of: list[str], any_of: list[str]) -> DataFrame:
    """Hits whose mention has all names of one list and one of the other at least (an empty list asks for nothing)."""
    names = entities.groupBy(mention).agg(F.collect_set("name").alias("_n"))
    out = hits.join(names, mention)
    for name in all_of:
        out = out.where(F.array_contains("_n", name))
    if any_of:
        out = out.where(F.arrays_overlap("_n", F.array(*[F.lit(x) for x in any_of])))
    return out.drop("_n")
