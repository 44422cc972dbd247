"""Event mentions: arguments, types, factors, polarity and pruning. Array-valued columns are kept as arrays of structs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from factloom.operators.selection import first_by

#: Canonical roles of synonyms.
ROLES = {
    "agent": "has_actor", "actor": "has_actor", "giver": "has_actor", "recipient": "has_recipient", "patient": "has_patient", "victim": "has_patient",
    "place": "has_location", "location": "has_location", "time": "has_time", "artifact": "has_artifact", "instrument": "has_instrument", "origin": "has_origin",
    "destination": "has_destination", "theme": "has_theme", "property": "has_property",
}


def polarity_between(text: Column, negations: list[str]) -> Column:
    """NEGATIVE if a negation stands in the text between two mentions."""
    low = F.lower(text)
    hit = F.lit(False)
    for n in negations:
        hit = hit | low.contains(n)
    return F.when(hit, "NEGATIVE").otherwise("POSITIVE")


def first_contained(text: Column, phrases: list[str]) -> Column:
    """The first phrase of a list that a text contains."""
    return F.coalesce(*[F.when(F.lower(text).contains(p), p) for p in phrases])


def reattach(relations: DataFrame, survivors: DataFrame, ends: tuple[str, str], old: str, new: str) -> DataFrame:
    """Relations with both ends mapped to surviving mentions; those that lose an end or become reflexive go."""
    out = relations
    for e in ends:
        out = out.join(survivors.select(F.col(old).alias(e), F.col(new).alias(f"_{e}")), e).drop(e).withColumnRenamed(f"_{e}", e)
    return out.where(F.col(ends[0]) != F.col(ends[1]))


def prune_generic(mentions: DataFrame, relations: DataFrame, member: str, types: Column, generic: list[str], ends: tuple[str, str]) -> DataFrame:
    """Mentions with only generic types stay if a relation has them."""
    used = relations.select(F.col(ends[0]).alias(member)).union(relations.select(F.col(ends[1]).alias(member))).distinct().withColumn("_used", F.lit(True))
    only = F.forall(types, lambda t: t.isin(generic))
    return mentions.join(used, member, "left").where(~only | F.col("_used").isNotNull()).drop("_used")


def strip_trends(types: Column, trends: tuple[str, ...] = ("Increase", "Decrease")) -> Column:
    """Types without those that are trends alone."""
    return F.filter(types, lambda t: ~t.isin(*trends))


def keep_listed(types: Column, allowed: list[str], default: Column | None = None) -> Column:
    """Types of a whitelist; if none is left, the default."""
    kept = F.filter(types, lambda t: t.isin(allowed))
    return kept if default is None else F.when(F.size(kept) == 0, F.array(default)).otherwise(kept)


def with_primary(types: Column, primary: Column) -> Column:
    """(type, score) pairs in which the primary type is one, with score zero if it was missing."""
    pair = F.struct(primary.alias("type"), F.lit(0.0).alias("score"))
    return F.when(F.exists(types, lambda t: t["type"] == primary), types).otherwise(F.concat(types, F.array(pair)))


def generic_from_factors(types: Column, factors: Column, generic: str) -> Column:
    """A mention with factors and no type gets the generic type at the factors' highest relevance."""
    top = F.aggregate(factors, F.lit(0.0), lambda a, f: F.greatest(a, f["relevance"]))
    return F.when((F.size(types) == 0) & (F.size(factors) > 0), F.array(F.struct(F.lit(generic).alias("type"), top.alias("score")))).otherwise(types)


def flip_opposites(factors: Column, opposites: dict[str, str]) -> Column:
    """A factor that is the opposite of another becomes that one with negative magnitude, unless it is there already."""
    table = F.create_map(*[F.lit(x) for kv in opposites.items() for x in kv])
    present = F.transform(factors, lambda f: f["type"])

    def one(f: Column) -> Column:
        other = F.element_at(table, f["type"])
        return F.when(other.isNotNull() & ~F.array_contains(present, other), F.struct(other.alias("type"), (-f["magnitude"]).alias("magnitude"))).otherwise(f)

    return F.transform(factors, one)


def best_grounding(factor_scores: Column, type_scores: Column) -> Column:
    """The highest factor relevance, else the highest type score, else one."""
    return F.coalesce(F.array_max(factor_scores), F.array_max(type_scores), F.lit(1.0))


def canonical_roles(args: DataFrame, member: str, role: str, start: str, end: str) -> DataFrame:
    """Arguments under canonical roles; unknown roles go, and of those on one span with one role the first stays."""
    table = F.create_map(*[F.lit(x) for kv in ROLES.items() for x in kv])
    named = args.withColumn(role, F.element_at(table, F.lower(role))).where(F.col(role).isNotNull())
    return named.dropDuplicates([member, role, start, end])


def unknown(values: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Values that an ontology lacks; a pipeline may stop if there are any."""
    return values.select(key).distinct().join(known.select(key), key, "left_anti")


def drop_covered(args: DataFrame, owner: list[str], start: str, end: str, item: str) -> DataFrame:
    """Arguments that no other of the same owner covers. With ends as a running maximum over starts, one window suffices."""
    w = W.partitionBy(*owner).orderBy(F.col(start), F.col(end).desc(), item).rowsBetween(W.unboundedPreceding, -1)
    return args.withColumn("_m", F.max(end).over(w)).where(F.col("_m").isNull() | (F.col(end) > F.col("_m"))).drop("_m")


def bigrams(tokens: DataFrame, doc: str, order: str, token: str) -> DataFrame:
    w = W.partitionBy(doc).orderBy(order)
    return tokens.withColumn("bigram", F.concat_ws(" ", F.lag(token).over(w), F.col(token)))


def time_contains(outer: Column, inner: Column) -> Column:
    """Whether a partial date contains another: each part that the outer one states must be the same."""
    return inner.startswith(outer) & ((F.length(inner) == F.length(outer)) | (F.substring(inner, F.length(outer) + 1, F.lit(1)) == "-"))


def neighbours_by_tokens(events: DataFrame, candidates: DataFrame, sentence: list[str], at: str, position: str, limit: int, member: str, item: str) -> DataFrame:
    """The candidate nearest to each event in its sentence, at most ``limit`` tokens away, of an event without an argument."""
    pairs = events.join(candidates, sentence).withColumn("distance", F.abs(F.col(at) - F.col(position))).where(F.col("distance") <= limit)
    return first_by(pairs, [member], ["distance", item])


def frames_merged(frames: DataFrame, key: list[str], confidence: str, types: str, args: str) -> DataFrame:
    """Frames of one trigger: highest confidence, all types, all different arguments."""
    return frames.groupBy(*key).agg(
        F.max(confidence).alias(confidence), F.array_sort(F.array_distinct(F.flatten(F.collect_list(types)))).alias(types), F.array_sort(F.array_distinct(F.flatten(F.collect_list(args)))).alias(args)
    )


def unordered(a: Column, b: Column) -> Column:
    """A key that is the same for both orders of a pair."""
    return F.array_sort(F.array(a, b))


def ancestors(nodes: DataFrame, node: str, parent: str, label: str, depth: int) -> DataFrame:
    """(node, labels): labels of a node's ancestors, nearest first, up to a bounded depth."""
    up = nodes.select(F.col(node).alias("_n"), F.col(parent).alias("_p"), F.col(label).alias("_l"))
    frontier = nodes.select(F.col(node), F.col(parent).alias("_at"))
    out = None
    for d in range(1, depth + 1):
        step = frontier.join(up, F.col("_at") == F.col("_n")).select(node, F.lit(d).alias("_d"), "_l", "_p")
        part = step.select(node, "_d", "_l")
        out = part if out is None else out.union(part)
        frontier = step.select(node, F.col("_p").alias("_at"))
    ordered = F.array_sort(F.collect_list(F.struct("_d", "_l")))
    return out.groupBy(node).agg(F.transform(ordered, lambda s: s["_l"]).alias("labels"))


def convert(df: DataFrame, kind: str, role: str, types: DataFrame, roles: DataFrame) -> DataFrame:
    """Types and roles of a source in terms of the ontology, with the model whose table knows the type.

    types: model, source, target; roles: model, source, target. A type that two models know goes to the smaller model name;
    rows whose type no table knows go, and a role that the model's table lacks is null.
    """
    one = types.groupBy(F.col("source").alias(kind)).agg(F.min(F.struct("model", "target")).alias("_t"))
    named = df.join(one, kind).withColumn("model", F.col("_t.model")).withColumn(kind, F.col("_t.target")).drop("_t")
    table = roles.groupBy("model", F.col("source").alias(role)).agg(F.min("target").alias("_r"))
    return named.join(table, ["model", role], "left").withColumn(role, F.col("_r")).drop("_r")


def dump(mentions: DataFrame, columns: list[str], order: list[str | Column], sep: str = "\t") -> DataFrame:
    """One line of text for each mention: its columns with nulls as empty fields, in a total order by number."""
    from factloom.operators.selection import numbered

    line = F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    named = mentions.select(*[c if isinstance(c, Column) else F.col(c) for c in order], line.alias("line"))
    return numbered(named, named.columns[:-1], "n").select("n", "line")
