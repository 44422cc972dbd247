"""Ontologies as a table of nodes, and linking of names and event mentions to it.

Nodes: path ('/a/b', the root '/'), name, parent, depth, exemplars (text, weight).
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from factloom.operators import vectors as V
from factloom.operators.selection import top_by

SCHEMA = "path string, name string, parent string, depth int, exemplars array<struct<text: string, weight: double>>"
#: Fixed value: what an exemplar of a node counts for the node above.
DECAY = 0.5


def _plain(name: str) -> str:
    """A name without the comment after it."""
    return name.split("#")[0].strip()


def nodes_of(tree: list[dict], decay: float = DECAY) -> list[tuple]:
    """Rows of SCHEMA. tree: [{root: [children]}], a child is {name: [children]} or a leaf {OntologyNode: _, name: _, examples: [_]}.

    A node has its own exemplars with weight 1 and those below it, ``decay`` for each level, the largest weight of a text.
    """
    out: list[tuple] = []

    def visit(name: str, children: list | None, above: str | None, depth: int, examples: list) -> dict[str, float]:
        path = "/" if above is None else above.rstrip("/") + "/" + name
        at = len(out)
        out.append(())
        weights = {_plain(x): 1.0 for x in examples if isinstance(x, str)}
        for child in children or []:
            leaf = "OntologyNode" in child
            for key, value in [(child["name"], None)] if leaf else child.items():
                for text, w in visit(_plain(key), value, path, depth + 1, child.get("examples", []) if leaf else []).items():
                    weights[text] = max(weights.get(text, 0.0), w * decay)
        out[at] = (path, name, above, depth, sorted(weights.items()))
        return weights

    (root, children), = tree[0].items()
    visit(_plain(root), children, None, 0, [])
    return out


def read_ontology(spark: SparkSession, path: str, decay: float = DECAY) -> DataFrame:
    """Nodes of an ontology file, JSON or YAML; the file is read by Spark and is as small as an ontology."""
    text = spark.read.text(path, wholetext=True).first()[0]
    try:
        tree = json.loads(text)
    except ValueError:
        import yaml

        tree = yaml.safe_load(text)
    return spark.createDataFrame(nodes_of(tree, decay), SCHEMA)


def nodes_by_name(nodes: DataFrame, name: str) -> DataFrame:
    return nodes.where(F.col("name") == name)


def path_nodes(df: DataFrame, path: str, sep: str = "/") -> DataFrame:
    """(path, name, parent, depth): all nodes of the paths of a table, the root left out."""
    parts = F.split(F.col(path), sep)
    prefix = lambda n: F.array_join(F.slice(parts, F.lit(1), n), sep)
    each = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.struct(prefix(n).alias("path"), F.get(parts, n - 1).alias("name"), prefix(n - 1).alias("parent"), n.alias("depth")))
    return df.select(F.inline(each)).distinct()


def link_names(names: DataFrame, concepts: DataFrame, k: int) -> DataFrame:
    """(name, path, score, rank): the concepts listed for a name, by the cosine of their vectors with the name's.

    names: name, vector; concepts: name, path, vector. A name without concepts has no row.
    """
    pairs = names.select("name", V.doubles("vector").alias("_a")).join(concepts.select("name", "path", V.doubles("vector").alias("_b")), "name")
    scored = pairs.select("name", "path", F.round(V.cosine(F.col("_a"), F.col("_b")), 6).alias("score"))
    return top_by(scored, ["name"], [F.col("score").desc(), "path"], k)


def ground_mentions(mentions: DataFrame, nodes: DataFrame, threshold: float, k: int, blacklist: DataFrame | None = None) -> DataFrame:
    """mentions (mention, vector) with ``groundings``: the k best nodes (node, vector) above a threshold as (type, score), best first.

    A mention without one keeps an empty list. blacklist: (mention, node) that may not be given.
    """
    # A mention may have any number of nodes on the blacklist, so all are ranked then.
    first = k if blacklist is None else nodes.count()
    near = V.nearest_centroids(mentions, "mention", "vector", nodes.select("node", V.doubles("vector").alias("centroid")), "node", first)
    if blacklist is not None:
        near = near.join(blacklist.select(F.col("mention").alias("item"), "node"), ["item", "node"], "left_anti")
    near = top_by(near.drop("rank").where(F.col("score") >= threshold), ["item"], [F.col("score").desc(), "node"], k)
    lists = near.groupBy(F.col("item").alias("mention")).agg(F.array_sort(F.collect_list(F.struct("rank", "node", "score"))).alias("_l"))
    types = F.transform("_l", lambda x: F.struct(x["node"].alias("type"), x["score"].alias("score")))
    kind = "array<struct<type: " + nodes.schema["node"].dataType.simpleString() + ", score: double>>"
    return mentions.join(lists, "mention", "left").withColumn("groundings", F.coalesce(types, F.array().cast(kind))).drop("_l")


def verify(triples: DataFrame, object_properties: DataFrame, datatype_properties: DataFrame, classes: DataFrame, domains: DataFrame, ranges: DataFrame, is_iri: Column) -> DataFrame:
    """(check, p, n): statements of a graph (s, p, o) that break its schema; checks without a finding have no row.

    object_properties, datatype_properties: p. classes: class. domains, ranges: (p, class), several classes are a union.
    A node without a type breaks no domain or range; one of its types must be allowed.
    """
    plain = triples.where("p != 'type'")
    types = triples.where("p = 'type'")
    parts = [
        plain.join(object_properties, "p", "left_semi").where(~is_iri).select(F.lit("object property with a literal").alias("check"), "p"),
        plain.join(datatype_properties, "p", "left_semi").where(is_iri).select(F.lit("datatype property with a node").alias("check"), "p"),
        types.join(classes.withColumnRenamed("class", "o"), "o", "left_anti").select(F.lit("undefined type").alias("check"), F.col("o").alias("p")),
    ]
    for name, side, rules in (("domain", "s", domains), ("range", "o", ranges)):
        typed = plain.join(rules.select("p").distinct(), "p", "left_semi").withColumn("node", F.col(side))
        kinds = types.select(F.col("s").alias("node"), F.col("o").alias("class"))
        some = typed.join(kinds.select("node").distinct(), "node", "left_semi")
        good = some.join(kinds, "node").join(rules, ["p", "class"], "left_semi").select("s", "p", "o").distinct()
        parts.append(some.select("s", "p", "o").distinct().join(good, ["s", "p", "o"], "left_anti").select(F.lit(f"{name} of another class").alias("check"), "p"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.groupBy("check", "p").agg(F.count("*").alias("n"))


def _near(a: Column, b: Column) -> Column:
    """Cosine, not below zero; zero where a vector is missing."""
    return F.when(a.isNull() | b.isNull(), 0.0).otherwise(F.greatest(V.cosine(a, b), F.lit(0.0)))


def similarity(mode: str) -> Column:
    """The score of a mention and a node by a mode, over columns with vectors (null: missing).

    text, participants, processes, properties, context: of the mention. node_name, node_exemplars (array of vectors),
    node_average, node_participants, node_processes, node_properties, node_context: of the node.
    """
    c = F.col
    if mode == "exemplars_max":
        return F.greatest(F.lit(0.0), F.coalesce(F.array_max(F.transform("node_exemplars", lambda x: V.cosine(c("text"), x))), F.lit(0.0)))
    if mode == "exemplars_average":
        return _near(c("text"), c("node_average"))
    if mode == "type_name":
        return _near(c("text"), c("node_name"))
    if mode == "keywords_average":
        kinds = ("participants", "processes", "properties")
        total = sum((_near(c(k), c(f"node_{k}")) for k in kinds), F.lit(0.0))
        given = sum((c(k).isNotNull().cast("int") for k in kinds), F.lit(0))
        return F.when(given == 0, 0.0).otherwise(total / given)
    if mode == "context_average":
        return _near(c("context"), c("node_context"))
    raise NotImplementedError(f"no similarity by {mode}")


#: The modes that have a definition.
MODES = ("exemplars_max", "exemplars_average", "type_name", "keywords_average", "context_average")


def best_by_mode(mentions: DataFrame, nodes: DataFrame, modes: tuple[str, ...] = MODES) -> DataFrame:
    """(mention, mode, node, score): each mention's best node by every mode; ties by the smaller node. nodes is an ontology's."""
    both = mentions.join(V.bounded(nodes))
    scores = F.array(*[F.struct(F.lit(m).alias("mode"), F.round(similarity(m), 6).alias("score")) for m in modes])
    s = both.select("mention", "node", F.inline(scores))
    return top_by(s, ["mention", "mode"], [F.col("score").desc(), "node"], 1).select("mention", "mode", "node", "score")
