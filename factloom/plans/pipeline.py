"""A knowledge base as named tables, and pipelines of resolvers read from a configuration."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession

from factloom.sources.checkpoints import cut

#: Tables of a knowledge base and the columns that every one of them has at least.
TABLES = {
    "documents": ("doc_id",), "sentences": ("doc_id", "sent"), "entities": ("entity_id",), "mentions": ("mention_id", "entity_id"), "events": ("event_id",),
    "event_mentions": ("mention_id", "event_id"), "event_arguments": ("mention_id", "role"), "groundings": ("mention_id", "type", "score"),
    "relations": ("relation_id", "left_id", "right_id", "type"), "relation_mentions": ("relation_id",), "event_groups": ("group_id", "event_id"),
}


@dataclass(frozen=True)
class KnowledgeBase:
    """Tables by name. Resolvers return a new one; the tables they don't touch are shared."""

    tables: dict[str, DataFrame] = field(default_factory=dict)

    def __post_init__(self):
        for name, df in self.tables.items():
            missing = set(TABLES.get(name, ())) - set(df.columns)
            if missing:
                raise ValueError(f"table {name} lacks {', '.join(sorted(missing))}")

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]

    def put(self, **tables: DataFrame) -> KnowledgeBase:
        return replace(self, tables=self.tables | tables)

    def consistent(self) -> KnowledgeBase:
        """Without rows that refer to rows which are gone: mentions of events, arguments and groundings of mentions, relations
        of events or entities, and groups of events."""
        t = dict(self.tables)

        def keep(child: str, key: str, parent: str, own: str):
            if child in t and parent in t:
                t[child] = t[child].join(t[parent].select(t[parent][own].alias(key)).distinct(), key, "left_semi")

        keep("event_mentions", "event_id", "events", "event_id")
        keep("event_arguments", "mention_id", "event_mentions", "mention_id")
        keep("groundings", "mention_id", "event_mentions", "mention_id")
        keep("event_groups", "event_id", "events", "event_id")
        if "relations" in t and "events" in t:
            ends = t["events"].select(t["events"].event_id.alias("_id"))
            if "entities" in t:
                ends = ends.union(t["entities"].select("entity_id"))
            ends = ends.distinct()
            for end in ("left_id", "right_id"):
                t["relations"] = t["relations"].join(ends, t["relations"][end] == ends["_id"], "left_semi")
        keep("relation_mentions", "relation_id", "relations", "relation_id")
        return replace(self, tables=t)


def strip_events(kb: KnowledgeBase) -> KnowledgeBase:
    """Without the event layer: events, their mentions, arguments, groundings, groups and relations are emptied."""
    layer = ("events", "event_mentions", "event_arguments", "groundings", "event_groups", "relations", "relation_mentions")
    return kb.put(**{name: df.limit(0) for name, df in kb.tables.items() if name in layer})


Resolver = Callable[..., KnowledgeBase]
RESOLVERS: dict[str, Resolver] = {}


def resolver(f: Resolver) -> Resolver:
    """Register a function (kb, **options) -> kb under its name."""
    RESOLVERS[f.__name__] = f
    return f


def from_config(text: str) -> list[tuple[str, dict]]:
    """Steps of a JSON configuration: {"resolvers": ["name", {"name": ..., "options": {...}}, ...]}, in order."""
    steps = []
    for step in json.loads(text)["resolvers"]:
        name, options = (step, {}) if isinstance(step, str) else (step["name"], step.get("options", {}))
        if name not in RESOLVERS:
            raise ValueError(f"unknown resolver {name}")
        steps.append((name, options))
    return steps


def run(kb: KnowledgeBase, steps: list[tuple[str, dict]], cut_every: int = 8) -> KnowledgeBase:
    """Apply the steps in order. Plans stay lazy; lineage is cut after every ``cut_every`` steps so that they don't grow long."""
    for k, (name, options) in enumerate(steps, 1):
        kb = RESOLVERS[name](kb, **options)
        if k % cut_every == 0 and k < len(steps):
            kb = replace(kb, tables={n: cut(df) for n, df in kb.tables.items()})
    return kb


@resolver
def do_nothing(kb: KnowledgeBase) -> KnowledgeBase:
    return kb


@resolver
def drop_triggers(kb: KnowledgeBase, triggers: list[str]) -> KnowledgeBase:
    """Events all of whose mentions have a listed trigger go, with all that refers to them."""
    from pyspark.sql import functions as F

    from factloom.functions.text import trigger_key
    from factloom.operators.resolvers import keep_events_with_good_mention

    good = keep_events_with_good_mention(kb["event_mentions"], "event_id", trigger_key(F.col("trigger")).isin([t.lower() for t in triggers]))
    return kb.put(events=kb["events"].join(good.select("event_id").distinct(), "event_id", "left_semi"), event_mentions=good).consistent()


@resolver
def rename_relations(kb: KnowledgeBase) -> KnowledgeBase:
    from factloom.operators import resolvers as R

    return kb.put(relations=R.rename_relations(kb["relations"], "left_id", "type", "right_id", ["relation_id"])).consistent()


@resolver
def drop_negative(kb: KnowledgeBase) -> KnowledgeBase:
    """Relations whose mentions are mostly negative go; ties by the smaller polarity."""
    from factloom.operators.selection import mode_by

    mode = mode_by(kb["relation_mentions"], ["relation_id"], "polarity").where("polarity = 'Negative'")
    return kb.put(relations=kb["relations"].join(mode.select("relation_id"), "relation_id", "left_anti")).consistent()


@resolver
def unify_events(kb: KnowledgeBase) -> KnowledgeBase:
    """Events with the same trigger, compared in lower case, form a group named by it."""
    from pyspark.sql import functions as F

    from factloom.functions.text import trigger_key

    groups = kb["event_mentions"].select(trigger_key(F.col("trigger")).alias("group_id"), "event_id").distinct()
    return kb.put(event_groups=groups)


@resolver
def best_type(kb: KnowledgeBase, threshold: float = 0.0) -> KnowledgeBase:
    """The best grounding of each mention at or above a threshold; ties by type."""
    from pyspark.sql import functions as F

    from factloom.operators.selection import first_by

    best = first_by(kb["groundings"].where(F.col("score") >= threshold), ["mention_id"], [F.col("score").desc(), "type"])
    return kb.put(groundings=best)


def load(spark: SparkSession, folder: str, names: list[str] | None = None) -> KnowledgeBase:
    """A knowledge base from the Parquet tables of a folder."""
    return KnowledgeBase({n: spark.read.parquet(f"{folder}/{n}") for n in names or TABLES})


def save(kb: KnowledgeBase, folder: str) -> None:
    for name, df in kb.tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
