"""Knowledge-base resolvers: filters, cascades, renames, confidences and fallbacks on event, relation and entity tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from factloom.functions.scores import tier
from factloom.operators.selection import first_by

#: Relation types and what they are called after renaming.
RELATION_NAMES = {
    "Cause-Effect": "cause", "Catalyst-Effect": "cause", "Precondition-Effect": "cause", "Mitigating-Factor-Effect": "mitigate",
    "Preventative-Effect": "mitigate", "Before-After": "before",
}
FLIPPING = ("Preventative-Effect", "Mitigating-Factor-Effect")
NEGATIONS = ("no", "not", "never", "without", "none", "nor", "cannot", "lack")


def cascade(parents: DataFrame, children: DataFrame, key: str, foreign: list[str]) -> DataFrame:
    """children all of whose references are among parents."""
    for f in foreign:
        children = children.join(parents.select(F.col(key).alias(f)), f, "left_semi")
    return children


def keep_events_with_good_mention(mentions: DataFrame, event: str, bad: Column) -> DataFrame:
    """Mentions of events of which one mention at least is not bad."""
    good = mentions.groupBy(event).agg(F.bool_or(~bad).alias("_ok")).where("_ok").select(event)
    return mentions.join(good, event, "left_semi")


def without_listed(df: DataFrame, listed: DataFrame, on: list[str]) -> DataFrame:
    return df.join(listed.select(*on).distinct(), on, "left_anti")


def event_polarity(trigger: Column, kind: Column) -> Column:
    """Negative for a trigger of several words with a negation in it, unless the type itself is a lack."""
    words = F.split(F.lower(trigger), " ")
    return F.when((F.size(words) > 1) & F.exists(words, lambda w: w.isin(list(NEGATIONS))) & ~F.lower(kind).rlike("shortage|insecurity"), "Negative").otherwise("Positive")


def good_entity_relations(df: DataFrame, left: str, right: str, left_code: str, right_code: str) -> DataFrame:
    """Relations of two different ends whose country codes, where both are known, differ."""
    same = (F.col(left) == F.col(right)) | (F.col(left_code) == F.col(right_code))
    return df.where(~F.coalesce(same, F.lit(False)))


def rename_relations(df: DataFrame, left: str, kind: str, right: str, order: list[Column | str], names: dict[str, str] = RELATION_NAMES) -> DataFrame:
    """Renamed types (others stay); of relations that are then the same, the first."""
    table = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    renamed = df.withColumn(kind, F.coalesce(F.element_at(table, F.col(kind)), F.col(kind)))
    return first_by(renamed, [left, kind, right], order)


def relation_confidence(df: DataFrame, left: str, kind: str, right: str, extracted: str) -> DataFrame:
    """The extraction's confidence, else that of the tier of the triple's count in the corpus."""
    counts = df.groupBy(kind, F.lower(left).alias("_l"), F.lower(right).alias("_r")).agg(F.count("*").alias("triple_count"))
    joined = df.withColumn("_l", F.lower(left)).withColumn("_r", F.lower(right)).join(counts, [kind, "_l", "_r"])
    return joined.withColumn("confidence", F.coalesce(F.col(extracted), tier(F.col("triple_count")))).drop("_l", "_r")


def priority_types(trigger_type: Column, phrase_type: Column, trigger: Column, phrase: Column, own: Column) -> Column:
    """The new type by (trigger, type), else (phrase, type), else trigger, else phrase, else the type it has."""
    return F.coalesce(trigger_type, phrase_type, trigger, phrase, own)


def flip_trend(sign: Column, relation: Column) -> Column:
    """Trend (-1, 0, 1) of an effect under its relation."""
    return F.when(relation.isin(*FLIPPING), -sign).when(relation == "Catalyst-Effect", F.greatest(F.abs(sign), F.lit(1)) * F.when(sign < 0, -1).otherwise(1)).otherwise(sign)


def group_type(df: DataFrame, group: str, kind: str) -> DataFrame:
    """Majority type of each group; ties: ORG first, then general types, then the smaller name."""
    counts = df.groupBy(group, kind).agg(F.count("*").alias("n"))
    return first_by(counts, [group], [F.col("n").desc(), (F.col(kind) == "ORG").desc(), F.col(kind).endswith(".General").desc(), F.col(kind)])


def first_known(*pairs: tuple[Column, str]) -> tuple[Column, Column]:
    """The first value that is not null, and the name of its method."""
    method = None
    for value, name in pairs:
        method = F.when(value.isNotNull(), name) if method is None else method.when(value.isNotNull(), name)
    return F.coalesce(*[v for v, _ in pairs]), method


def unify(df: DataFrame, by: Column, member: str, group: str = "group_key") -> DataFrame:
    """(group, n, first_member): members of one key, compared in lower case."""
    return df.groupBy(F.lower(by).alias(group)).agg(F.count("*").alias("n"), F.min(member).alias("first_member"))


def prune_paths(df: DataFrame, owner: list[str], path: str, sep: str = "/") -> DataFrame:
    """Of an owner's paths those that no longer path continues: an equi-join on all proper prefixes."""
    parts = F.split(F.col(path), sep)
    above = df.select(*owner, F.explode(F.when(F.size(parts) > 1, F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, F.lit(1), n), sep)))).alias(path))
    return df.join(above.distinct(), [*owner, path], "left_anti")


def covering(df: DataFrame, group: list[str], member: str, args: str) -> DataFrame:
    """(group, small, large): members of one group where large has all arguments of small and more. ``args``: array.

    Candidates share an argument, so the join is on (group, argument), counted up to the size of the smaller set.
    """
    sized = df.select(*group, member, F.array_distinct(args).alias("_a"))
    long = sized.select(*group, member, F.size("_a").alias("_n"), F.explode("_a").alias("_x"))
    a = long.select(*group, "_x", F.col(member).alias("small"), F.col("_n").alias("_ns"))
    b = long.select(*group, "_x", F.col(member).alias("large"), F.col("_n").alias("_nl"))
    pairs = a.join(b, [*group, "_x"]).where("_nl > _ns").groupBy(*group, "small", "large", "_ns").agg(F.count("*").alias("_m"))
    return pairs.where("_m = _ns").select(*group, "small", "large")
