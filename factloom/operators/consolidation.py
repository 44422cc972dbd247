"""Consolidation of event mentions: merging on anchors, propagation, calibration, constraints, coreference sieves."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from factloom.operators.selection import first_by

#: Fixed values of magnitude words.
MAGNITUDES = {"High": 1.0, "Medium": 0.5, "Low": 0.25}


def merge_anchor(df: DataFrame, anchor: list[str], generic: Column, member: str, kind: str) -> DataFrame:
    """One row for each anchor: its first member that is not generic, the number of members, the distinct types sorted."""
    master = F.min_by(member, F.struct(generic, F.col(member)))
    return df.groupBy(*anchor).agg(F.count("*").alias("n"), master.alias(member), F.array_sort(F.collect_set(kind)).alias("types"))


def drop_generic(types: Column, generic: str) -> Column:
    """The generic type goes if there is another."""
    return F.when(F.size(types) > 1, F.array_remove(types, generic)).otherwise(types)


def propagate(df: DataFrame, group: str, order: str, value: str, span: int, name: str) -> DataFrame:
    """Values of this row and of rows up to ``span`` before it: distinct, sorted."""
    w = W.partitionBy(group).orderBy(order).rangeBetween(-span, 0)
    return df.withColumn(name, F.array_sort(F.collect_set(value).over(w)))


def magnitude(word: Column, negative: Column) -> Column:
    """Magnitude of a property word (medium without one), negative for a negative polarity."""
    size = F.when(word == "High", MAGNITUDES["High"]).when(word == "Low", MAGNITUDES["Low"]).otherwise(MAGNITUDES["Medium"])
    return size * F.when(negative, -1.0).otherwise(1.0)


def keyword_weight(tokens: Column, weights: dict[str, float]) -> Column:
    """Product of the weights of all keywords among the tokens."""
    return reduce(lambda a, b: a * b, [F.when(F.array_contains(tokens, k), w).otherwise(1.0) for k, w in weights.items()], F.lit(1.0))


def allowed(df: DataFrame, rules: DataFrame, role: str, kind: str) -> DataFrame:
    """df with ok: the (role, kind) is listed, or the role has no rule at all."""
    listed = rules.select(role, kind).distinct().withColumn("_hit", F.lit(True))
    bounded = rules.select(role).distinct().withColumn("_bound", F.lit(True))
    return df.join(listed, [role, kind], "left").join(bounded, role, "left").withColumn("ok", F.col("_bound").isNull() | F.col("_hit").isNotNull()).drop("_hit", "_bound")


def nearest_in_time(left: DataFrame, right: DataFrame, key: str, member: str, at: str, limit: int) -> DataFrame:
    """(member, nearest_id, gap): the nearest row of the same key within ``limit``. A row meets three buckets of that width."""
    bucket = F.floor(F.col(at) / limit)
    a = left.select(key, member, F.col(at).alias("_a"), F.explode(F.array(bucket - 1, bucket, bucket + 1)).alias("_b"))
    b = right.select(key, F.col(member).alias("nearest_id"), F.col(at).alias("_t"), bucket.alias("_b"))
    pairs = a.join(b, [key, "_b"]).withColumn("gap", F.abs(F.col("_a") - F.col("_t"))).where(F.col("gap") <= limit)
    best = F.min(F.struct("gap", "nearest_id"))
    return pairs.groupBy(member).agg(best.alias("_m")).select(member, F.col("_m.nearest_id").alias("nearest_id"), F.col("_m.gap").alias("gap"))


def types_of_maximum(df: DataFrame, owner: list[str], kind: str, score: str) -> DataFrame:
    """Maximum score of each type of an owner."""
    return df.groupBy(*owner, kind).agg(F.max(score).alias(score))


def merge_arguments(df: DataFrame, owner: list[str], key: list[str], order: list[str]) -> DataFrame:
    """Arguments of all merged mentions; of those with one key the first."""
    return first_by(df, [*owner, *key], order)


def keyword_mentions(tokens: DataFrame, keywords: DataFrame, doc: str, pos: str, lemma: str, score: float = 0.7) -> DataFrame:
    """Mentions of keywords: two lemmas in a row first, then single ones that no bigram has taken. keywords: lemma, kind."""
    w = W.partitionBy(doc).orderBy(pos)
    t = tokens.withColumn("_two", F.concat_ws(" ", F.lag(lemma).over(w), F.col(lemma)))
    k = keywords.select(F.col("lemma").alias("_k"), "kind")
    two = t.join(k, t["_two"] == k["_k"]).select(doc, pos, "kind", F.lit(score).alias("score"), F.lit(True).alias("bigram"))
    one = t.join(k, t[lemma] == k["_k"]).select(doc, pos, "kind", F.lit(score).alias("score"), F.lit(False).alias("bigram"))
    one = one.join(two.select(doc, pos), [doc, pos], "left_anti")
    return two.unionByName(one).where("kind <> 'NO_EVENT'")


def sieve(rows: list[tuple], window: int) -> dict:
    """Event of each mention. rows: (sent, mention, kind, arg) in order.

    First sieve: mentions of one sentence that have the same type and no conflicting argument. Second sieve: events of later
    sentences, at most one for each sentence within ``window``, join the earliest event that they don't conflict with.
    """
    events: list[dict] = []
    for sent, mention, kind, arg in rows:
        for e in events:
            if e["first"] == sent and e["kind"] == kind and (arg is None or not e["args"] or arg in e["args"]):
                break
        else:
            e = {"first": sent, "kind": kind, "args": set(), "members": [], "into": None}
            events.append(e)
        e["members"].append(mention)
        if arg is not None:
            e["args"].add(arg)
    for k, focus in enumerate(events):
        if focus["into"] is not None:
            continue
        seen = {focus["first"]}
        for other in events[k + 1 :]:
            if other["first"] > focus["first"] + window:
                break
            if other["into"] is not None or other["first"] in seen or other["kind"] != focus["kind"]:
                continue
            if focus["args"] and other["args"] and not focus["args"] & other["args"]:
                continue
            seen.add(other["first"])
            other["into"] = k
            focus["args"] |= other["args"]
    return {m: (events[e["into"]] if e["into"] is not None else e)["members"][0] for e in events for m in e["members"]}


def coreference(df: DataFrame, window: int = 5) -> DataFrame:
    """(doc, mention, event): df has doc, sent, mention, kind, arg. The sieves are greedy in document order, so a document is
    one group; documents run in parallel."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["sent", "mention"])
        rows = [(s, m, k, None if pd.isna(a) else a) for s, m, k, a in zip(pdf["sent"], pdf["mention"], pdf["kind"], pdf["arg"])]
        got = sieve(rows, window)
        return pd.DataFrame({"doc": pdf["doc"], "mention": pdf["mention"], "event": pdf["mention"].map(got)})

    kind = dict(df.dtypes)
    return df.groupBy("doc").applyInPandas(run, f"doc {kind['doc']}, mention {kind['mention']}, event {kind['mention']}")
