"""Triggers, phrases and trees. Trees are tables (node, parent); spans are closed and belong to a sentence given by keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from factloom.operators import graph, spans

#: A trigger has at most this many words, each of ASCII letters and dashes with at least two letters.
MAX_TRIGGER_WORDS = 5


def valid_trigger(text: Column) -> Column:
    words = F.split(text, " ")
    good = lambda w: w.rlike("^[A-Za-z-]*$") & (F.length(F.regexp_replace(w, "-", "")) >= 2)
    return (F.size(words) <= MAX_TRIGGER_WORDS) & F.forall(words, good)


def pos_triggers(words: DataFrame, word: str, tag: str, stop: list[str], nouns: list[str]) -> DataFrame:
    """Verbs, and those nouns that are listed, unless proper, stopped or no valid trigger."""
    w, t = F.lower(word), F.col(tag)
    listed = t.startswith("V") | (t.startswith("NN") & ~t.startswith("NNP") & w.isin(*nouns))
    return words.where(valid_trigger(F.col(word)) & ~w.isin(*stop) & listed)


def smallest_cover(anchors: DataFrame, nodes: DataFrame, keys: list[str], anchor: str, width: int, anchor_span: tuple[str, str], node_span: tuple[str, str], tie: list[str], max_ratio: float = 5) -> DataFrame:
    """Each anchor with the shortest node that covers it, if that is shorter than ``max_ratio`` anchors."""
    (a0, a1), (n0, n1) = anchor_span, node_span
    ratio = (F.col(n1) - F.col(n0) + 1) / (F.col(a1) - F.col(a0) + 1)
    pairs = spans.covering_sentence(anchors, nodes, keys, width, anchor_span, node_span).where(ratio < max_ratio)
    order = W.partitionBy(anchor).orderBy(ratio, *tie)
    return pairs.withColumn("_r", F.row_number().over(order)).where("_r = 1").drop("_r")


def between_blockers(tokens: DataFrame, keys: list[str], position: str, blocker: Column) -> DataFrame:
    """Each token with the widest run around it that has no blocker; a blocker is its own run."""
    w = W.partitionBy(*keys).orderBy(position)
    at = F.when(blocker, F.col(position))
    before = F.max(at).over(w.rowsBetween(W.unboundedPreceding, -1))
    after = F.min(at).over(w.rowsBetween(1, W.unboundedFollowing))
    whole = W.partitionBy(*keys)
    start = F.when(blocker, F.col(position)).otherwise(F.coalesce(before + 1, F.min(position).over(whole)))
    end = F.when(blocker, F.col(position)).otherwise(F.coalesce(after - 1, F.max(position).over(whole)))
    return tokens.withColumn("phrase_start", start).withColumn("phrase_end", end)


def canonical_mention(tokens: DataFrame, phrase: list[str], position: str, preposition: Column, light: Column, score: Column) -> DataFrame:
    """One token of each phrase: that before the last inner preposition unless light, else that of the best score."""
    whole = W.partitionBy(*phrase)
    first = F.min(position).over(whole)
    last = F.max(F.when(preposition & (F.col(position) > F.col("_first")), F.col(position))).over(whole)
    ranked = tokens.withColumn("_first", first).withColumn("_last", last)
    head = (F.col(position) == F.col("_last") - 1) & ~light
    order = whole.orderBy(F.coalesce(head, F.lit(False)).desc(), score.desc(), position)
    return ranked.withColumn("_r", F.row_number().over(order)).where("_r = 1").drop("_r", "_first", "_last")


def typed_by_neighbour(light: DataFrame, typed: DataFrame, keys: list[str], anchor: str, reach: int, at: tuple[str, str], tie: list[str]) -> DataFrame:
    """Light anchors with the nearest typed mention at most ``reach`` positions away."""
    a, b = at
    wide = light.withColumn("_lo", F.col(a) - reach).withColumn("_hi", F.col(a) + reach)
    point = typed.withColumn("_at", F.col(b))
    pairs = spans.overlap_join(wide, point, keys, 2 * reach + 1, ("_lo", "_hi"), (b, "_at"))
    return spans.nearest(pairs, [anchor], F.abs(F.col(a) - F.col(b)), reach, tie).drop("_lo", "_hi", "_at")


def typed_by_chain(light: DataFrame, typed: DataFrame, chain: str, best: list[Column]) -> DataFrame:
    """Light anchors with the best typed mention of the same entity chain; the best is chosen first, so no chain is paired."""
    order = W.partitionBy(chain).orderBy(*best)
    top = typed.withColumn("_r", F.row_number().over(order)).where("_r = 1").drop("_r")
    return light.join(top, chain)


def prune_near(mentions: DataFrame, matches: DataFrame, keys: list[str], width: int, context: int, mention: str, span: tuple[str, str], match_span: tuple[str, str]) -> DataFrame:
    """Mentions that touch no pattern match widened by ``context`` positions on both sides."""
    m0, m1 = match_span
    wide = matches.select(*keys, (F.col(m0) - context).alias("_m0"), (F.col(m1) + context).alias("_m1"))
    hit = spans.overlap_join(mentions.select(*keys, mention, *span), wide, keys, width, span, ("_m0", "_m1"))
    return mentions.join(hit.select(mention), mention, "left_anti")


def ancestors(nodes: DataFrame, node: str, parent: str, depth: int) -> DataFrame:
    """(child, ancestor, distance) up to ``depth``, each node being its own ancestor at distance 0."""
    own = nodes.select(F.col(node).alias("child"), F.col(node).alias("ancestor"), F.lit(0).alias("distance"))
    return own.union(graph.closure(nodes.where(F.col(parent).isNotNull()), node, parent, depth))


def expanded_anchor(nodes: DataFrame, node: str, parent: str, size: str, max_size: int, depth: int) -> DataFrame:
    """(node, expansion): the farthest ancestor all the way up to which no node has more than ``max_size`` tokens."""
    small = nodes.where(F.col(size) <= max_size)
    inner = small.join(small.select(F.col(node).alias(parent)), parent, "left_semi")
    own = small.select(F.col(node).alias("child"), F.col(node).alias("ancestor"), F.lit(0).alias("distance"))
    up = own.union(graph.closure(inner, node, parent, depth))
    return up.groupBy("child").agg(F.max_by("ancestor", "distance").alias("expansion")).withColumnRenamed("child", node)


def tree_paths(pairs: DataFrame, nodes: DataFrame, left: str, right: str, node: str, parent: str, depth: int) -> DataFrame:
    """Pairs with their lowest common ancestor and the steps up and down to it, at most ``depth`` each."""
    up = ancestors(nodes, node, parent, depth)
    a = up.select(F.col("child").alias(left), F.col("ancestor").alias("meet"), F.col("distance").alias("steps_up"))
    b = up.select(F.col("child").alias(right), F.col("ancestor").alias("meet"), F.col("distance").alias("steps_down"))
    best = F.min_by(F.struct("meet", "steps_up", "steps_down"), F.struct(F.col("steps_up") + F.col("steps_down"), "meet"))
    return pairs.join(a, left).join(b, [right, "meet"]).groupBy(left, right).agg(best.alias("_p")).select(left, right, "_p.*")


def role_arguments(args: DataFrame, role: str, kind: str, table: dict[tuple[str, str], str]) -> DataFrame:
    """Arguments whose proposition role and entity type are in the table, with the event role that it gives."""
    out = F.coalesce(*[F.when((F.col(role) == r) & (F.col(kind) == k), v) for (r, k), v in table.items()])
    return args.withColumn("event_role", out).where("event_role IS NOT NULL")
