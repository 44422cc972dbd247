"""Conflicts between event candidates and the splitting of events whose unique role has several fillers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def shatter(arguments: DataFrame, event: list[str], role: str, filler: str, unique: str) -> DataFrame:
    """Arguments with a ``variant``: each distinct filler of the unique role makes one event with all other arguments.

    Equal fillers are consistent and stay together; an event with fewer than two of them is variant 1 alone.
    """
    target = F.col(role) == unique
    mine = arguments.where(target).withColumn("variant", F.dense_rank().over(W.partitionBy(*event).orderBy(filler)))
    n = mine.groupBy(*event).agg(F.max("variant").alias("_n"))
    rest = arguments.where(~F.coalesce(target, F.lit(False))).join(n, event, "left")
    rest = rest.withColumn("variant", F.explode(F.sequence(F.lit(1), F.coalesce("_n", F.lit(1))))).drop("_n")
    return mine.unionByName(rest)


def tag_conflict(a: Column, b: Column, one: str = "NN", other: str = "NNS") -> Column:
    """One candidate has the one tag and the other candidate the other."""
    has = F.array_contains
    return (has(a, one) & has(b, other)) | (has(a, other) & has(b, one))


def realis_conflict(a: Column, b: Column) -> Column:
    """Generic on one side, actual or other on the other."""
    specific = F.array(F.lit("ACTUAL"), F.lit("OTHER"))
    generic = lambda x, y: F.array_contains(x, "GENERIC") & F.arrays_overlap(y, specific)
    return generic(a, b) | generic(b, a)


def indicators(between: Column, lists: dict[str, list[str]]) -> Column:
    """A struct of booleans: does the text between two spans have a phrase of the list, as whole words."""
    any_of = lambda ps: between.rlike(r"(?i)(^|[^A-Za-z])(" + "|".join(ps) + r")([^A-Za-z]|$)")
    return F.struct(*[any_of(ps).alias(k) for k, ps in lists.items()])


def compatible_strings(a: Column, b: Column) -> Column:
    """Equal without case, or all words of the one are words of the other."""
    wa, wb = (F.array_distinct(F.split(F.lower(x), r"\s+")) for x in (a, b))
    return (F.size(F.array_except(wa, wb)) == 0) | (F.size(F.array_except(wb, wa)) == 0)


def argument_conflicts(pairs: DataFrame, arguments: DataFrame, inside: DataFrame, by_containment: tuple[str, ...] = ("time",), by_either: tuple[str, ...] = ("place", "origin", "destination"), at_most: DataFrame | None = None) -> DataFrame:
    """pairs (a, b of events) with ``conflict``: whether a role that both have lacks a pair of fillers that agree.

    arguments: event, role, value. inside: (value, outer), what lies in what; a value lies in itself. Fillers of a role of
    ``by_containment`` agree if one lies in the other, of ``by_either`` also if their strings are compatible, of all other roles if
    the strings are. at_most: (a, b, role, n); these pairs conflict in the role only with over n different fillers together.
    """
    x = arguments.select(F.col("event").alias("a"), "role", F.col("value").alias("va")).distinct()
    y = arguments.select(F.col("event").alias("b"), "role", F.col("value").alias("vb")).distinct()
    both = pairs.join(x, "a").join(y, ["b", "role"])
    holds = inside.select(F.col("value").alias("va"), F.col("outer").alias("vb"), F.lit(True).alias("held"))
    holds = holds.union(inside.select("outer", "value", F.lit(True))).distinct()
    both = both.join(holds, ["va", "vb"], "left")
    held, same = F.col("held").isNotNull() | (F.col("va") == F.col("vb")), compatible_strings(F.col("va"), F.col("vb"))
    ok = F.when(F.col("role").isin(*by_containment), held).when(F.col("role").isin(*by_either), held | same).otherwise(same)
    roles = both.groupBy("a", "b", "role").agg(F.bool_or(ok).alias("ok"), F.array_distinct(F.flatten(F.array(F.collect_set("va"), F.collect_set("vb")))).alias("all"))
    if at_most is not None:
        roles = roles.join(at_most, ["a", "b", "role"], "left").withColumn("ok", F.when(F.col("n").isNotNull(), F.size("all") <= F.col("n")).otherwise(F.col("ok")))
    bad = roles.groupBy("a", "b").agg(F.bool_or(~F.col("ok")).alias("conflict"))
    return pairs.join(bad, ["a", "b"], "left").withColumn("conflict", F.coalesce("conflict", F.lit(False)))
