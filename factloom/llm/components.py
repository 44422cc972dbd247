"""Connected components of an edge list that no machine needs to hold: alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from factloom.llm.runtime import cut


def _large(e: DataFrame) -> DataFrame:
    """Every neighbour above a node is tied to the node's smallest neighbour (itself included)."""
    both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(e: DataFrame) -> DataFrame:
    """A node and its neighbours below it are tied to the smallest of them; u > v holds in e."""
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    return e.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least)


def _state(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, a: str, b: str, rounds: int | None = None) -> DataFrame:
    """(node, component) for every node of ``edges`` that isn't the smallest of its component.

    The component is its smallest node. Self-links and repeated links are fine. Each round is cut by a reliable
    checkpoint, so a lost executor costs one round at most; the number of rounds is logarithmic in the longest path.
    With ``rounds`` it ends after so many: a component may then have several labels, but no label is in two components.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    if rounds is not None:
        for _ in range(rounds):
            e = _small(_large(e).distinct()).distinct()
        return cut(e.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("node"), F.col("v").alias("component")))
    e = cut(e)
    was = _state(e)
    while was[0]:
        e = cut(_small(_large(e).distinct()).distinct())
        now = _state(e)
        if now == was:
            break
        was = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("component"))


def first_members(tied: DataFrame, nodes: DataFrame) -> DataFrame:
    """(fp, first) for the fingerprints of ``tied`` (node, component): the least (node, fp) of the fingerprint's component.

    nodes: fp, node; the node is the smallest id that has the fingerprint.
    """
    grouped = tied.select(F.col("node").alias("fp"), "component").union(tied.select(F.col("component").alias("fp"), "component").distinct())
    grouped = grouped.join(nodes.select("fp", "node"), "fp")
    least = grouped.groupBy("component").agg(F.min(F.struct("node", "fp")).alias("first"))
    return grouped.join(least, "component").select("fp", "first")
