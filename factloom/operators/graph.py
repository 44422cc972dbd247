"""Basic graph patterns over triples (s, p, o): each pattern is a filter on p with s and o as variables or constants.

Variables start with '?'. Patterns are joined on shared variables, so the optimiser orders them as any other join; optional,
union and minus are left joins, unions and anti-joins of solutions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def pattern(triples: DataFrame, s: str, p: str, o: str) -> DataFrame:
    """Solutions of one pattern."""
    df = triples
    columns = {}
    for place, term in (("s", s), ("p", p), ("o", o)):
        if term.startswith("?"):
            if term[1:] in columns:
                df = df.where(F.col(columns[term[1:]]) == F.col(place))
            else:
                columns[term[1:]] = place
        else:
            df = df.where(F.col(place) == term)
    return df.select(*[F.col(place).alias(name) for name, place in columns.items()])


def join(a: DataFrame, b: DataFrame, how: str = "inner") -> DataFrame:
    shared = [c for c in a.columns if c in b.columns]
    if not shared:
        raise ValueError("patterns without a shared variable would give a product")
    return a.join(b, shared, how)


def bgp(triples: DataFrame, *patterns: tuple[str, str, str]) -> DataFrame:
    return reduce(join, [pattern(triples, *x) for x in patterns])


def optional(solutions: DataFrame, other: DataFrame) -> DataFrame:
    return join(solutions, other, "left")


def minus(solutions: DataFrame, other: DataFrame) -> DataFrame:
    return join(solutions, other, "left_anti")


def union(*solutions: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), solutions)


def values(solutions: DataFrame, variable: str, allowed: list[str]) -> DataFrame:
    return solutions.where(F.col(variable).isin(allowed))


def star_triples(df: DataFrame, kind: str, key: str, columns: dict[str, str]) -> DataFrame:
    """Triples of a table: a subject 'kind/key' for each row, its type, and a predicate for each column; nulls have none."""
    subject = F.concat(F.lit(f"{kind}/"), F.col(key).cast("string"))
    pairs = [F.struct(F.lit("type").alias("p"), F.lit(kind).alias("o"))]
    pairs += [F.struct(F.lit(p).alias("p"), F.expr(e).cast("string").alias("o")) for p, e in columns.items()]
    return df.select(subject.alias("s"), F.inline(F.array(*pairs))).where(F.col("o").isNotNull())


def closure(edges: DataFrame, child: str, parent: str, depth: int) -> DataFrame:
    """(child, ancestor, distance) up to a bounded depth; the shortest distance of each pair."""
    step = edges.select(F.col(child).alias("child"), F.col(parent).alias("ancestor"), F.lit(1).alias("distance")).distinct()
    out, last = step, step
    for d in range(2, depth + 1):
        up = edges.select(F.col(child).alias("ancestor"), F.col(parent).alias("_next"))
        last = last.join(up, "ancestor").select("child", F.col("_next").alias("ancestor"), F.lit(d).alias("distance")).distinct()
        out = out.union(last)
    return out.groupBy("child", "ancestor").agg(F.min("distance").alias("distance"))


def two_hops(seeds: DataFrame, edges: DataFrame, a: str, b: str) -> DataFrame:
    """Nodes within two undirected hops of the seeds, with the least number of hops."""
    both = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).union(edges.select(b, a)).distinct()
    zero = seeds.select(F.col(seeds.columns[0]).alias("node"), F.lit(0).alias("hops")).distinct()
    one = zero.join(both, zero.node == both.x).select(F.col("y").alias("node"), F.lit(1).alias("hops")).distinct()
    two = one.join(both, one.node == both.x).select(F.col("y").alias("node"), F.lit(2).alias("hops")).distinct()
    return zero.union(one).union(two).groupBy("node").agg(F.min("hops").alias("hops"))
