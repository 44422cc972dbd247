"""Rules over the event mentions of a sentence: types by entities, arguments by distance, properties and keywords.

Event mentions: sent, mention, kind (type), pos (token of the anchor). Entity mentions of a sentence: sent, entity, kind, start,
end (tokens). Arguments: mention, role, entity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from factloom.operators.selection import first_by

#: Entity types that say what an intervention provides.
PROVIDED = ("FOOD", "MONEY", "SEED", "HYGIENE_TOOL", "LIVESTOCK_FEED", "STATIONARY", "VETERINARY_SERVICE", "DELIVERY_KIT", "FARMING_TOOL", "FISHING_TOOL")
#: How near to the anchor an entity may be to count for it, in tokens.
NEAR = 5
#: Words that mention a price, as a property.
PRICE_WORDS = ("price", "prices", "cost", "costs")


def accept_types(events: DataFrame, entities: DataFrame, required: DataFrame) -> DataFrame:
    """Event mentions whose type asks for an entity type go if their sentence has none of it. required: kind, entity_kind."""
    have = entities.select("sent", F.col("kind").alias("entity_kind")).distinct()
    met = events.join(required, "kind").join(have, ["sent", "entity_kind"], "left_semi").select("mention", "kind")
    free = events.join(required.select("kind").distinct(), "kind", "left_anti")
    return free.unionByName(events.join(met.distinct(), ["mention", "kind"], "left_semi").select(*free.columns))


def distance(pos: Column, start: Column, end: Column) -> Column:
    return F.least(F.abs(pos - start), F.abs(pos - end))


def remap_types(events: DataFrame, entities: DataFrame, arguments: DataFrame, kind: str, role: str, mapping: DataFrame, near: int = NEAR) -> DataFrame:
    """(mention, kind, entity, replaces): types of event mentions after those of type ``kind`` were made more specific.

    mapping: entity_kind, new_kind. A mention of the type takes the new type of its nearest argument in ``role``, and also
    that of the nearest entity of its sentence within ``near`` tokens, which then replaces its arguments; with neither the
    mention goes. Others keep their type. Ties go to the entity that starts first, then to the smaller id.
    """
    general = events.where(F.col("kind") == kind).select("sent", "mention", "pos")
    known = entities.join(mapping.withColumnRenamed("entity_kind", "kind"), "kind")
    cand = general.join(known, "sent").withColumn("d", distance(F.col("pos"), F.col("start"), F.col("end")))
    of_role = arguments.where(F.col("role") == role).select("mention", "entity").distinct()
    order = ["d", "start", "entity"]
    by_argument = first_by(cand.join(of_role, ["mention", "entity"], "left_semi"), ["mention"], order).withColumn("replaces", F.lit(False))
    by_window = first_by(cand.where(F.col("d") <= near), ["mention"], order).withColumn("replaces", F.lit(True))
    new = by_argument.unionByName(by_window).select("mention", F.col("new_kind").alias("kind"), "entity", "replaces")
    # Both ways may give one type: then the entity of the window counts, as it replaces the arguments.
    new = first_by(new, ["mention", "kind"], [F.col("replaces").desc()])
    kept = events.where(F.col("kind") != kind).select("mention", "kind", F.lit(None).cast(new.schema["entity"].dataType).alias("entity"), F.lit(False).alias("replaces"))
    return kept.unionByName(new)


def add_arguments(events: DataFrame, values: DataFrame, arguments: DataFrame, roles: list[str], role: str, tokens: DataFrame, near: int = NEAR, barriers: tuple[str, ...] = (",", '"')) -> DataFrame:
    """New arguments (mention, role, entity): values at most ``near`` tokens from an event's anchor without a barrier between.

    Events that have an argument in one of ``roles`` get none. values: sent, entity, start, end. tokens: sent, pos, token.
    """
    open_ = events.join(arguments.where(F.col("role").isin(roles)).select("mention").distinct(), "mention", "left_anti")
    pairs = open_.select("sent", "mention", "pos").join(values.select("sent", "entity", "start", "end"), "sent")
    pairs = pairs.where(distance(F.col("pos"), F.col("start"), F.col("end")) <= near)
    stops = tokens.where(F.col("token").isin(*barriers)).groupBy("sent").agg(F.collect_set("pos").alias("stops"))
    lo = F.when(F.col("pos") >= F.col("end"), F.col("end")).otherwise(F.col("pos"))
    hi = F.when(F.col("pos") >= F.col("end"), F.col("pos")).otherwise(F.col("start"))
    clear = ~F.exists(F.coalesce("stops", F.array().cast("array<int>")), lambda p: (p >= F.col("lo")) & (p <= F.col("hi")))
    return pairs.join(stops, "sent", "left").withColumn("lo", lo).withColumn("hi", hi).where(clear).select("mention", F.lit(role).alias("role"), "entity")


def propagate_arguments(events: DataFrame, arguments: DataFrame, roles: list[str], window: int) -> DataFrame:
    """New arguments (mention, role, entity) for events without one in the role: that of the nearest earlier event of their
    document at most ``window`` sentences before that has exactly one. events: doc, sent_no, mention."""
    one = arguments.where(F.col("role").isin(roles)).groupBy("mention", "role").agg(F.count("*").alias("n"), F.min("entity").alias("entity")).where("n = 1").drop("n")
    given = events.select("doc", "sent_no", "mention").join(one, "mention").select("doc", "role", "entity", F.col("sent_no").alias("from_no"), F.col("mention").alias("source"))
    missing = events.select("doc", "sent_no", "mention").withColumn("role", F.explode(F.array(*[F.lit(r) for r in roles])))
    missing = missing.join(arguments.select("mention", "role").distinct(), ["mention", "role"], "left_anti")
    # Joined by the sentence that may have given it, so that a long document is no key of its own.
    back = missing.withColumn("from_no", F.explode(F.sequence(F.col("sent_no") - window, F.col("sent_no") - 1)))
    found = back.join(given, ["doc", "role", "from_no"])
    return first_by(found, ["mention", "role"], [F.col("from_no").desc(), "source"]).select("mention", "role", "entity")


def property_values(df: DataFrame, phrase: str, lexicon: list[tuple[str, str, list[str]]], wanted: list[str]) -> DataFrame:
    """df with a map ``properties``: the value of each wanted property whose words the phrase has; of several the last one listed."""
    words = F.split(F.lower(F.coalesce(F.col(phrase), F.lit(""))), r"[^\p{L}\p{N}]+")
    hits = {}
    for prop, value, listed in lexicon:
        if prop in wanted:
            here = F.arrays_overlap(words, F.array(*[F.lit(w) for w in listed]))
            hits[prop] = F.when(here, value).otherwise(hits.get(prop, F.lit(None).cast("string")))
    entries = F.array(*[F.struct(F.lit(p).alias("k"), v.alias("v")) for p, v in hits.items()])
    return df.withColumn("properties", F.map_from_entries(F.filter(entries, lambda e: e["v"].isNotNull())))


def keyword_frequency(df: DataFrame, text: str, keywords: list[str], sep: str = "\n") -> Column:
    """How many (sentence, keyword) pairs a text has; sentences are its lines, held against keywords with a space on either side."""
    lines = F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), sep), lambda s: F.trim(s) != "")
    each = F.transform(lines, lambda s: sum((F.concat(F.lit(" "), s, F.lit(" ")).contains(k.lower()).cast("long") for k in keywords), F.lit(0).cast("long")))
    return F.aggregate(each, F.lit(0).cast("long"), lambda a, x: a + x)


def keyword_types(tokens: DataFrame, rules: DataFrame) -> DataFrame:
    """(doc, kind): the types of the keywords that a document has. tokens: doc, token; rules: keyword, kind (several of each)."""
    return tokens.join(F.broadcast(rules.withColumnRenamed("keyword", "token")), "token").select("doc", "kind").distinct()


def keyword_events(tokens: DataFrame, rules: DataFrame) -> DataFrame:
    """(doc, pos, token, kind): an event mention for each token that a rule names. tokens: doc, pos, token; rules: keyword, kind."""
    return tokens.join(F.broadcast(rules.withColumnRenamed("keyword", "token")), "token").select("doc", "pos", "token", "kind")


def property_mentions(tokens: DataFrame, words: tuple[str, ...] = PRICE_WORDS, kind: str = "PRICE") -> DataFrame:
    """(doc, pos, token, kind): a value mention for each listed token that is no verb. tokens: doc, pos, token, verb."""
    return tokens.where(F.col("token").isin(*words) & ~F.col("verb")).select("doc", "pos", "token", F.lit(kind).alias("kind"))


def types_to_factors(df: DataFrame, types: str = "types", factors: str = "factors") -> DataFrame:
    """The types of event mentions replace their factors and are cleared."""
    return df.withColumn(factors, F.col(types)).withColumn(types, F.array().cast(df.schema[types].dataType))


def nearest_arguments(
    events: DataFrame, candidates: DataFrame, arguments: DataFrame, role: str, blocked: list[str], near: int, at: str = "pos", lone: bool = False, phrase: bool = False,
    allowed: DataFrame | None = None, unused: bool = False,
) -> DataFrame:
    """New arguments (mention, role, entity), one for an event at most: the candidate of its sentence nearest to token ``at``.

    Events that have an argument in one of the ``blocked`` roles get none, nor does a candidate farther than ``near`` tokens
    count. lone: the only candidate of a sentence counts at any distance. phrase: a candidate that overlaps the event's phrase
    (p0 to p1) goes first, of several the last one. allowed: (kind, entity_kind); an event whose kind is listed takes these
    alone. unused: a nearest candidate that is an argument of the event already gives none. Ties: the earlier candidate.
    """
    open_ = events.join(arguments.where(F.col("role").isin(blocked)).select("mention").distinct(), "mention", "left_anti")
    c = candidates.select("sent", "entity", F.col("kind").alias("entity_kind"), "start", "end")
    pairs = open_.join(c, "sent").withColumn("d", distance(F.col(at), F.col("start"), F.col("end")))
    if allowed is not None:
        listed = allowed.select("kind").distinct().withColumn("listed", F.lit(True))
        fits = allowed.select("kind", "entity_kind").distinct().withColumn("fits", F.lit(True))
        pairs = pairs.join(listed, "kind", "left").join(fits, ["kind", "entity_kind"], "left").where("listed IS NULL OR fits")
    overlap = F.lit(False)
    if phrase:
        overlap = ((F.col("p0") <= F.col("end")) & (F.col("end") <= F.col("p1"))) | ((F.col("start") <= F.col("p1")) & (F.col("p1") <= F.col("end")))
    pairs = pairs.withColumn("over", overlap)
    if lone:
        one = c.groupBy("sent").agg((F.count("*") == 1).alias("one"))
        pairs = pairs.join(one, "sent").where((F.col("d") <= near) | F.col("one") | F.col("over"))
    else:
        pairs = pairs.where((F.col("d") <= near) | F.col("over"))
    last = lambda x: F.when(F.col("over"), -F.col(x)).otherwise(F.col(x))
    best = first_by(pairs, ["mention"], [F.col("over").desc(), F.when(~F.col("over"), F.col("d")).asc_nulls_first(), last("start"), last("entity")])
    if unused:
        best = best.join(arguments.select("mention", "entity").distinct(), ["mention", "entity"], "left_anti")
    return best.select("mention", F.lit(role).alias("role"), "entity")


def actor_arguments(events: DataFrame, candidates: DataFrame, arguments: DataFrame, tokens: DataFrame, role: str = "has_actor") -> DataFrame:
    """New arguments (mention, role, entity) by what stands around the anchor of an event without one in the role.

    A candidate counts if it ends right before a noun anchor, if it stands in the anchor's noun chunk (c0 to c1), if 's
    stands after it and then the anchor, or if it stands after the word 'against' that follows the anchor.
    events: sent, mention, pos, noun, c0, c1. tokens: sent, pos, token.
    """
    open_ = events.join(arguments.where(F.col("role") == role).select("mention").distinct(), "mention", "left_anti")
    said = tokens.where(F.col("token").isin("'s", "against")).groupBy("sent").agg(
        F.collect_set(F.when(F.col("token") == "'s", F.col("pos"))).alias("own"), F.collect_set(F.when(F.col("token") == "against", F.col("pos"))).alias("against")
    )
    pairs = open_.join(candidates.select("sent", "entity", "start", "end"), "sent").join(said, "sent", "left")
    has = lambda c, p: F.coalesce(F.array_contains(F.col(c), p), F.lit(False))
    before = F.col("noun") & (F.col("end") == F.col("pos") - 1)
    chunk = (F.col("c0") <= F.col("start")) & (F.col("end") <= F.col("c1")) & ((F.col("end") < F.col("pos")) | (F.col("start") > F.col("pos")))
    owner = has("own", F.col("end") + 1) & (F.col("pos") == F.col("end") + 2)
    against = has("against", F.col("start") - 1) & (F.col("pos") == F.col("start") - 2)
    return pairs.where(before | chunk | owner | against).select("mention", F.lit(role).alias("role"), "entity").distinct()
