"""Choosing and merging rows: first of an order, majority, dominance, precedence of sources, relational division."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from factloom.sources.checkpoints import cut


def first_by(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each key in an order that must be total. Spark prunes to one row for each key before the shuffle."""
    return df.withColumn("_r", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("_r = 1").drop("_r")


def top_by(df: DataFrame, keys: list[str], order: list[Column | str], k: int, rank: str = "rank") -> DataFrame:
    """The first k rows of each key, numbered from 1."""
    return df.withColumn(rank, F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col(rank) <= k)


def mode_by(df: DataFrame, keys: list[str], value: str, ties: list[Column | str] | None = None, count: str = "n") -> DataFrame:
    """The most frequent value of each key and its count; ties by ``ties``, else by the smaller value. Nulls don't count."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias(count))
    return first_by(counts, keys, [F.col(count).desc(), *(ties or [value])])


def majority(df: DataFrame, item: list[str], value: str, voter: str, share: float = 0.5) -> DataFrame:
    """Values that more than ``share`` of an item's different voters gave."""
    all_ = df.groupBy(*item).agg(F.countDistinct(voter).alias("n_voters"))
    votes = df.groupBy(*item, value).agg(F.countDistinct(voter).alias("n_votes"))
    return votes.join(all_, item).where(F.col("n_votes") > share * F.col("n_voters"))


def undominated(df: DataFrame, group: list[str], better: list[Column | str]) -> DataFrame:
    """Of rows that say the same, the one that says most: first in ``better`` within the group."""
    return first_by(df, group, better)


def prefer(current: DataFrame, cached: DataFrame, key: str) -> DataFrame:
    """Rows of the current run, and cached rows of keys that it lacks."""
    return current.unionByName(cached.join(current.select(key), key, "left_anti"))


def last_writer(parts: list[DataFrame], key: str) -> DataFrame:
    """Of rows of one key, that of the last part that has it."""
    all_ = None
    for k, part in enumerate(parts):
        part = part.withColumn("_part", F.lit(k))
        all_ = part if all_ is None else all_.unionByName(part)
    return first_by(all_, [key], [F.col("_part").desc()]).drop("_part")


def divide(have: DataFrame, owner: list[str], rules: DataFrame, rule: str, on: list[str]) -> DataFrame:
    """(owner, rule): owners that have every pair that the rule asks for."""
    need = rules.select(rule, *on).distinct()
    size = need.groupBy(rule).agg(F.count("*").alias("_need"))
    met = have.select(*owner, *on).distinct().join(need, on).groupBy(*owner, rule).agg(F.count("*").alias("_met"))
    return met.join(size, rule).where("_met = _need").select(*owner, rule)


def numbered(df: DataFrame, order: list[str], name: str = "index") -> DataFrame:
    """Rows numbered from 0 in an order, without a window over all rows: range partitions are numbered each for itself and
    shifted by the rows of those before. The order must be total for the numbers to be repeatable."""
    placed = cut(df.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()))
    sizes = placed.groupBy("_p").agg(F.count("*").alias("_n"))
    before = sizes.select("_p", (F.sum("_n").over(W.orderBy("_p")) - F.col("_n")).alias("_before"))  # a row for each partition
    local = F.row_number().over(W.partitionBy("_p").orderBy(*order))
    return placed.join(before, "_p").withColumn(name, local - 1 + F.col("_before")).drop("_p", "_before")


def balanced(df: DataFrame, order: list[str], parts: int, name: str = "part") -> DataFrame:
    """Contiguous parts in an order whose sizes differ by one at most (larger ones first), numbered from 0."""
    n = df.count()
    small, extra = divmod(n, parts)
    edge = extra * (small + 1)
    i = F.col("_i")
    part = F.when(i < edge, F.floor(i / (small + 1))).otherwise(extra + F.floor((i - edge) / max(small, 1)))
    return numbered(df, order, "_i").withColumn(name, part.cast("int")).drop("_i")
