"""Rules over event mentions, ontologies and linking, over stand-in tables.

A sentence is an order, its event mentions and entities are line items, and the token of a mention is its quantity.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from factloom.functions import text as X
from factloom.operators import event_rules as E, ontology as O, selection, vectors as V
from factloom.plans.registry import query
from factloom.sources.tables import table

_L = """WITH l AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice)::BIGINT AS i FROM lineitem),
    ev AS (SELECT l_orderkey AS sent, l_orderkey * 1000 + i AS mention, CASE WHEN l_returnflag = 'R' THEN 'Provide' WHEN l_returnflag = 'A' THEN 'Treat' ELSE 'Other' END AS kind, l_quantity::INTEGER AS pos, i FROM l),
    en AS (SELECT l_orderkey AS sent, l_orderkey * 1000 + i AS entity, ['FOOD', 'SEED', 'MONEY', 'PER'][l_suppkey % 4 + 1] AS kind, (l_tax * 100 + l_quantity)::INTEGER AS start, (l_tax * 100 + l_quantity)::INTEGER + 1 AS fin, i FROM l)"""


def _sentences(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Event mentions, entities, and arguments: each event has the entity of the line after it in role has_artifact."""
    from pyspark.sql import Window as W

    w = W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    l = table(spark, sf_dir, "lineitem").withColumn("i", F.row_number().over(w).cast("long"))
    own = (F.col("l_orderkey") * 1000 + F.col("i")).alias("x")
    kind = F.when(F.col("l_returnflag") == "R", "Provide").when(F.col("l_returnflag") == "A", "Treat").otherwise("Other")
    events = l.select(F.col("l_orderkey").alias("sent"), own.alias("mention"), kind.alias("kind"), F.round("l_quantity").cast("int").alias("pos"))
    start = F.round(F.col("l_tax") * 100 + F.col("l_quantity")).cast("int")
    entity_kind = F.get(F.array(*[F.lit(x) for x in ("FOOD", "SEED", "MONEY", "PER")]), (F.col("l_suppkey") % 4).cast("int"))
    entities = l.select(F.col("l_orderkey").alias("sent"), own.alias("entity"), entity_kind.alias("kind"), start.alias("start"), (start + 1).alias("end"))
    arguments = events.select(F.col("mention"), F.lit("has_artifact").alias("role"), (F.col("mention") + 1).alias("entity")).join(entities.select("entity"), "entity", "left_semi")
    return events, entities, arguments


@query(_L + " SELECT mention, kind FROM ev WHERE kind = 'Other' OR EXISTS (SELECT 1 FROM en WHERE en.sent = ev.sent AND en.kind = CASE ev.kind WHEN 'Provide' THEN 'FOOD' ELSE 'PER' END)")
def accepted_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event mentions whose sentence has an entity of the type that their own type asks for."""
    events, entities, _ = _sentences(spark, sf_dir)
    required = spark.createDataFrame([("Provide", "FOOD"), ("Treat", "PER")], "kind string, entity_kind string")
    return E.accept_types(events, entities, required).select("mention", "kind")


@query(_L + """, m AS (SELECT ev.mention, en.entity, en.kind AS ek, least(abs(pos - start), abs(pos - fin)) AS d, start, en.entity = ev.mention + 1 AS arg FROM ev JOIN en USING (sent) WHERE ev.kind = 'Provide' AND en.kind <> 'PER'),
    a AS (SELECT mention, ek, entity, false AS replaces FROM (SELECT *, row_number() OVER (PARTITION BY mention ORDER BY d, start, entity) AS r FROM m WHERE arg) WHERE r = 1),
    b AS (SELECT mention, ek, entity, true AS replaces FROM (SELECT *, row_number() OVER (PARTITION BY mention ORDER BY d, start, entity) AS r FROM m WHERE d <= 5) WHERE r = 1),
    n AS (SELECT mention, concat('Provide', upper(ek[1]), lower(ek[2:])) AS kind, entity, replaces FROM (SELECT * FROM a UNION ALL SELECT * FROM b))
    SELECT mention, kind, NULL::BIGINT AS entity, false AS replaces FROM ev WHERE kind <> 'Provide'
    UNION ALL SELECT mention, kind, entity, replaces FROM (SELECT *, row_number() OVER (PARTITION BY mention, kind ORDER BY replaces DESC) AS r FROM n) WHERE r = 1
""")
def remapped_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """General events made specific by the nearest argument and by the nearest entity within five tokens."""
    events, entities, arguments = _sentences(spark, sf_dir)
    mapping = spark.createDataFrame([("FOOD", "ProvideFood"), ("SEED", "ProvideSeed"), ("MONEY", "ProvideMoney")], "entity_kind string, new_kind string")
    return E.remap_types(events, entities, arguments, "Provide", "has_artifact", mapping)


@query(_L + """ SELECT ev.mention, 'has_time' AS role, en.entity FROM ev JOIN en USING (sent) WHERE en.kind = 'MONEY' AND ev.kind <> 'Other' AND least(abs(pos - start), abs(pos - fin)) <= 5
      AND NOT EXISTS (SELECT 1 FROM en x WHERE x.entity = ev.mention + 1)
      AND NOT EXISTS (SELECT 1 FROM en c WHERE c.sent = ev.sent AND c.kind = 'PER' AND c.start BETWEEN CASE WHEN pos >= en.fin THEN en.fin ELSE pos END AND CASE WHEN pos >= en.fin THEN pos ELSE en.start END)
""")
def inferred_arguments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values near an event that lacks such an argument, without a barrier between (entities PER stand for commas)."""
    events, entities, arguments = _sentences(spark, sf_dir)
    commas = entities.where("kind = 'PER'").select("sent", F.col("start").alias("pos"), F.lit(",").alias("token"))
    return E.add_arguments(events.where("kind != 'Other'"), entities.where("kind = 'MONEY'"), arguments, ["has_artifact"], "has_time", commas)


@query("""WITH e AS (SELECT o_custkey AS doc, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)::INTEGER AS sent_no, o_orderkey AS mention, o_orderstatus AS s, o_totalprice FROM orders),
    g AS (SELECT doc, sent_no, mention, (o_totalprice / 1000)::BIGINT AS entity FROM e WHERE s = 'F')
    SELECT mention, 'has_actor' AS role, entity FROM (SELECT e.mention, g.entity, row_number() OVER (PARTITION BY e.mention ORDER BY g.sent_no DESC, g.mention) AS r FROM e JOIN g ON e.doc = g.doc AND g.sent_no BETWEEN e.sent_no - 3 AND e.sent_no - 1 WHERE e.s <> 'F') WHERE r = 1""")
def propagated_arguments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actors taken from an event at most three sentences before; a customer's orders are the events of a document."""
    from pyspark.sql import Window as W

    o = table(spark, sf_dir, "orders").withColumn("sent_no", F.row_number().over(W.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")))
    events = o.select(F.col("o_custkey").alias("doc"), "sent_no", F.col("o_orderkey").alias("mention"))
    # The SQL's cast takes a half to the even neighbour, as rint does and round does not.
    actors = o.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("mention"), F.lit("has_actor").alias("role"), F.rint(F.col("o_totalprice") / 1000).cast("long").alias("entity"))
    return E.propagate_arguments(events, actors, ["has_actor"], 3)


@query("SELECT concat('entity-', c_custkey) AS entity_id, c_custkey AS mention_id, c_name AS canonical_name, c_mktsegment AS kind FROM customer")
def simple_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An entity for each mention."""
    c = table(spark, sf_dir, "customer")
    return c.select(F.concat(F.lit("entity-"), "c_custkey").alias("entity_id"), F.col("c_custkey").alias("mention_id"), F.col("c_name").alias("canonical_name"), F.col("c_mktsegment").alias("kind"))


@query("SELECT concat('event-', event_id) AS event_id, event_id AS mention_id, event_type AS kind FROM events")
def simple_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An event for each event mention."""
    e = table(spark, sf_dir, "events")
    return e.select(F.concat(F.lit("event-"), "event_id").alias("event_id"), F.col("event_id").alias("mention_id"), F.col("event_type").alias("kind"))


@query("SELECT 'documents' AS name, count(*) AS n FROM documents UNION ALL SELECT unnest(['event_arguments', 'event_mentions', 'events']), 0")
def stripped_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A knowledge base without its event layer: rows of each table."""
    from factloom.plans import pipeline as P

    e = table(spark, sf_dir, "events").select("event_id", F.col("event_id").alias("mention_id"), F.lit("actor").alias("role"))
    kb = P.KnowledgeBase({"documents": table(spark, sf_dir, "documents"), "events": e, "event_mentions": e, "event_arguments": e})
    out = P.strip_events(kb)
    counts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n") for name, df in out.tables.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).unionByName(counts[3])


_T = "SELECT doc_id, unnest(range(len(w))) AS pos, unnest(w) AS token FROM (SELECT doc_id, list_filter(string_split_regex(lower(text), '[^a-z0-9]+'), lambda x: x <> '') AS w FROM documents)"


def _tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.filter(X.tokens(F.col("text")), lambda t: t != "")
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc"), F.posexplode(words).alias("pos", "token"))


@query(f"SELECT doc_id AS doc, count(*) AS n, min(pos)::BIGINT AS first_pos FROM ({_T}) WHERE token IN ('the', 'und', 'inging') AND NOT ends_with(token, 'ing') GROUP BY 1")
def property_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Value mentions for listed tokens that are no verbs (tokens in -ing stand for verbs)."""
    t = _tokens(spark, sf_dir).withColumn("verb", F.col("token").endswith("ing"))
    return E.property_mentions(t, ("the", "und", "inging")).groupBy("doc").agg(F.count("*").alias("n"), F.min("pos").cast("long").alias("first_pos"))


@query(f"SELECT doc_id AS doc, kind, count(*) AS n FROM ({_T}) JOIN (SELECT unnest(['the', 'der', 'der', 'los']) AS token, unnest(['Aid', 'Aid', 'Relief', 'Relief']) AS kind) USING (token) GROUP BY ALL")
def keyword_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event mentions that rules of keywords add; a keyword may have several types."""
    rules = spark.createDataFrame([("the", "Aid"), ("der", "Aid"), ("der", "Relief"), ("los", "Relief")], "keyword string, kind string")
    return E.keyword_events(_tokens(spark, sf_dir), rules).groupBy("doc", "kind").agg(F.count("*").alias("n"))


@query(f"SELECT DISTINCT doc_id AS doc, kind FROM ({_T}) JOIN (SELECT unnest(['with', 'mit', 'avec']) AS token, unnest(['Joint', 'Joint', 'Together']) AS kind) USING (token)")
def keyword_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame([("with", "Joint"), ("mit", "Joint"), ("avec", "Together")], "keyword string, kind string")
    return E.keyword_types(_tokens(spark, sf_dir), rules)


@query("SELECT o_orderkey, 0 AS n_types, concat(o_orderstatus, ',', o_orderpriority) AS factors FROM orders")
def factors_from_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types replace the factors and are cleared."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.array("o_orderstatus", "o_orderpriority").alias("types"), F.array(F.lit("old")).alias("factors"))
    return E.types_to_factors(o).select("o_orderkey", F.size("types").alias("n_types"), F.array_join("factors", ",").alias("factors"))


@query("SELECT doc_id, CASE WHEN replace(source, 'src', '')::INTEGER % 3 = 0 THEN 'news' ELSE 'web' END AS source_type FROM documents WHERE source IS NOT NULL AND replace(source, 'src', '')::INTEGER % 3 < 2")
def document_source_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The type of a document's source from a table of sources; documents of unlisted sources have none."""
    sources = table(spark, sf_dir, "documents").select("source").distinct().withColumn("k", F.replace("source", F.lit("src"), F.lit("")).cast("int") % 3)
    kinds = sources.where("k < 2").select("source", F.when(F.col("k") == 0, "news").otherwise("web").alias("source_type"))
    return table(spark, sf_dir, "documents").select("doc_id", "source").join(kinds, "source").select("doc_id", "source_type")


_W = "string_split_regex(lower(text), '[^\\p{L}\\p{N}]+')"


@query(f"SELECT conv_id, turn, CASE WHEN list_has_any({_W}, ['les', 'los']) THEN 'Decrease' WHEN list_has_any({_W}, ['the', 'die']) THEN 'Increase' END AS trend FROM conversations")
def property_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The value of a property by the words of a lexicon; of several values the last one listed."""
    lexicon = [("Trend", "Increase", ["the", "die"]), ("Trend", "Decrease", ["les", "los"]), ("Size", "Big", ["of"])]
    c = E.property_values(table(spark, sf_dir, "conversations"), "text", lexicon, ["Trend"])
    return c.select("conv_id", "turn", F.element_at("properties", "Trend").alias("trend"))


@query("""SELECT doc_id, sum(contains(s, ' the ')::INTEGER + contains(s, 'tion')::INTEGER + contains(s, ' und ')::INTEGER)::BIGINT AS freq FROM
    (SELECT doc_id, concat(' ', unnest(string_split(lower(text), chr(10))), ' ') AS s FROM documents) WHERE trim(s) <> '' GROUP BY 1""")
def keyword_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a sentence and a keyword that it has, by document."""
    d = table(spark, sf_dir, "documents")
    return d.where(F.trim(F.replace("text", F.lit("\n"), F.lit(" "))) != "").select("doc_id", E.keyword_frequency(d, "text", [" the ", "tion", " und "]).alias("freq"))


@query("""WITH p AS (SELECT p_brand AS b, p_type AS t, p_name AS x FROM part), n AS (SELECT DISTINCT b AS path, b AS name, '' AS parent, 1 AS depth FROM p UNION SELECT DISTINCT concat(b, '/', t), t, b, 2 FROM p UNION SELECT DISTINCT concat(b, '/', t, '/', x), x, concat(b, '/', t), 3 FROM p)
    SELECT path, name, parent, depth FROM n""")
def ontology_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nodes of the class paths of a table."""
    return O.path_nodes(table(spark, sf_dir, "part").select(F.concat_ws("/", "p_brand", "p_type", "p_name").alias("path")), "path")


@query("SELECT DISTINCT concat(p_brand, '/', p_type) AS path, p_brand AS parent FROM part WHERE p_type = 'ECONOMY'")
def ontology_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of a name wherever they stand in the tree."""
    nodes = O.path_nodes(table(spark, sf_dir, "part").select(F.concat_ws("/", "p_brand", "p_type").alias("path")), "path")
    return O.nodes_by_name(nodes, "ECONOMY").select("path", "parent")


_E = "WITH e AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings)"
_C = ", c AS (SELECT label, list(m ORDER BY d) AS centroid FROM (SELECT label, d, avg(x) AS m FROM (SELECT label, unnest(v) AS x, unnest(range(1, 65)) AS d FROM e) GROUP BY ALL) GROUP BY label)"


@query(_E + _C + " SELECT label AS name, vec_id AS path, score, rank FROM (SELECT c.label, vec_id, round(list_cosine_similarity(v, centroid), 6) AS score, row_number() OVER (PARTITION BY c.label ORDER BY round(list_cosine_similarity(v, centroid), 6) DESC, vec_id)::INTEGER AS rank FROM e JOIN c USING (label)) WHERE rank <= 3")
def entity_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The concepts listed for a name, ranked by similarity with the name's average vector."""
    e = table(spark, sf_dir, "embeddings").select(F.col("label").alias("name"), F.col("vec_id").alias("path"), F.col("embedding").alias("vector"))
    return O.link_names(V.average(e, ["name"], "vector", name="vector"), e, 3)


@query(_E + _C + """, s AS (SELECT vec_id, c.label AS node, round(list_cosine_similarity(v, centroid), 6) AS score FROM e, c WHERE c.label <> vec_id % 7),
    r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, node) AS r FROM s WHERE score >= 0.3)
    SELECT e.vec_id AS mention, count(r.node)::INTEGER AS n, min(node) FILTER (r = 1) AS first_type, round(sum(score), 6) AS total FROM e LEFT JOIN (SELECT * FROM r WHERE r <= 2) r USING (vec_id) GROUP BY 1""")
def grounded_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event mentions with their two best nodes above a threshold; a node of a mention's blacklist is not given."""
    m = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("mention"), F.col("label"), F.col("embedding").alias("vector"))
    nodes = V.average(m, ["label"], "vector", name="vector").withColumnRenamed("label", "node")
    black = m.select("mention", (F.col("mention") % 7).cast("int").alias("node"))
    g = O.ground_mentions(m, nodes, 0.3, 2, black)
    total = F.when(F.size("groundings") > 0, F.round(F.aggregate("groundings", F.lit(0.0), lambda a, x: a + x["score"]), 6))
    return g.select("mention", F.size("groundings").alias("n"), F.get("groundings", F.lit(0))["type"].alias("first_type"), total.alias("total"))


@query(_E + """ SELECT query, item, score, rank FROM (SELECT a.vec_id AS query, b.vec_id AS item, round(list_cosine_similarity(a.v, b.v), 6) AS score, row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_cosine_similarity(a.v, b.v), 6) DESC, b.vec_id)::INTEGER AS rank
    FROM e a JOIN e b ON a.vec_id <> b.vec_id AND a.vec_id % 20 = 0 AND a.label = b.label) WHERE rank <= 3""")
def nearest_event_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every twentieth event mention the three most similar ones of its type."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label", V.unit(V.doubles("embedding")).alias("v"))
    q = e.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query"), "label", F.col("v").alias("q"))
    s = q.join(e, "label").where("query != vec_id").select("query", F.col("vec_id").alias("item"), F.round(V.dot(F.col("q"), F.col("v")), 6).alias("score"))
    return selection.top_by(s, ["query"], [F.col("score").desc(), "item"], 3)


@query("""WITH t AS (SELECT concat('supplier/', s_suppkey) AS s, 'type' AS p, 'supplier' AS o FROM supplier UNION ALL SELECT concat('nation/', n_nationkey), 'type', CASE WHEN n_nationkey < 20 THEN 'nation' ELSE 'realm' END FROM nation
      UNION ALL SELECT concat('supplier/', s_suppkey), 'located_in', CASE WHEN s_suppkey % 9 = 0 THEN 'nowhere' ELSE concat('nation/', s_nationkey) END FROM supplier
      UNION ALL SELECT concat('supplier/', s_suppkey), 'name', CASE WHEN s_suppkey % 11 = 0 THEN 'nation/1' ELSE s_name END FROM supplier)
    SELECT * FROM (SELECT 'object property with a literal' AS "check", 'located_in' AS p, count(*) AS n FROM t WHERE p = 'located_in' AND NOT contains(o, '/')
      UNION ALL SELECT 'datatype property with a node', 'name', count(*) FROM t WHERE p = 'name' AND contains(o, '/')
      UNION ALL SELECT 'undefined type', o, count(*) FROM t WHERE p = 'type' AND o = 'realm' GROUP BY o
      UNION ALL SELECT 'range of another class', 'located_in', count(*) FROM t JOIN (SELECT s AS node, o AS c FROM t WHERE p = 'type') k ON t.o = k.node WHERE p = 'located_in' AND c <> 'nation') WHERE n > 0""")
def graph_verification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statements that break the schema of the graph, counted by check and predicate."""
    s, n = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    node = F.concat(F.lit("supplier/"), "s_suppkey")
    t = s.select(node.alias("s"), F.lit("type").alias("p"), F.lit("supplier").alias("o"))
    t = t.union(n.select(F.concat(F.lit("nation/"), "n_nationkey"), F.lit("type"), F.when(F.col("n_nationkey") < 20, "nation").otherwise("realm")))
    t = t.union(s.select(node, F.lit("located_in"), F.when(F.col("s_suppkey") % 9 == 0, "nowhere").otherwise(F.concat(F.lit("nation/"), "s_nationkey"))))
    t = t.union(s.select(node, F.lit("name"), F.when(F.col("s_suppkey") % 11 == 0, "nation/1").otherwise(F.col("s_name"))))
    one = lambda *rows: spark.createDataFrame(rows, "p string, class string")
    classes = spark.createDataFrame([("supplier",), ("nation",)], "class string")
    return O.verify(t, one(("located_in", "")).select("p"), one(("name", "")).select("p"), classes, one(("located_in", "supplier"), ("name", "supplier"), ("name", "nation")), one(("located_in", "nation")), F.col("o").contains("/"))


def _phrases(events: DataFrame) -> DataFrame:
    return events.withColumn("p0", F.col("pos") - 1).withColumn("p1", F.col("pos") + 1)


_FREE = "NOT EXISTS (SELECT 1 FROM en x WHERE x.entity = ev.mention + 1)"


@query(_L + f""", c AS (SELECT ev.mention, en.entity, start, least(abs(pos - start), abs(pos - fin)) AS d, count(*) OVER (PARTITION BY ev.mention) AS n FROM ev JOIN en USING (sent) WHERE en.kind = 'SEED' AND {_FREE})
    SELECT mention, 'has_location' AS role, entity FROM (SELECT *, row_number() OVER (PARTITION BY mention ORDER BY d, start, entity) AS r FROM c WHERE d <= 10 OR n = 1) WHERE r = 1""")
def place_arguments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The only place of a sentence, or the nearest one within ten tokens."""
    events, entities, arguments = _sentences(spark, sf_dir)
    return E.nearest_arguments(events, entities.where("kind = 'SEED'"), arguments, "has_location", ["has_artifact"], 10, lone=True)


@query(_L + f""", c AS (SELECT ev.mention, en.entity, start, least(abs(pos + 1 - start), abs(pos + 1 - fin)) AS d, (pos - 1 <= fin AND fin <= pos + 1) OR (start <= pos + 1 AND pos + 1 <= fin) AS o FROM ev JOIN en USING (sent)
      WHERE (ev.kind = 'Other' OR ev.kind = 'Provide' AND en.kind IN ('FOOD', 'SEED') OR ev.kind = 'Treat' AND en.kind = 'PER') AND {_FREE})
    SELECT mention, 'has_theme' AS role, entity FROM (SELECT *, row_number() OVER (PARTITION BY mention ORDER BY o DESC, CASE WHEN o THEN 0 ELSE d END, CASE WHEN o THEN -start ELSE start END, CASE WHEN o THEN -entity ELSE entity END) AS r FROM c WHERE o OR d <= 4) WHERE r = 1""")
def theme_arguments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Themes of allowed types: one in the event's phrase, else the nearest within four tokens of its end."""
    events, entities, arguments = _sentences(spark, sf_dir)
    allowed = spark.createDataFrame([("Provide", "FOOD"), ("Provide", "SEED"), ("Treat", "PER")], "kind string, entity_kind string")
    return E.nearest_arguments(_phrases(events), entities, arguments, "has_theme", ["has_artifact"], 4, at="p1", phrase=True, allowed=allowed)


@query(_L + """, c AS (SELECT ev.mention, en.entity, start, least(abs(pos + 1 - start), abs(pos + 1 - fin)) AS d, (pos - 1 <= fin AND fin <= pos + 1) OR (start <= pos + 1 AND pos + 1 <= fin) AS o FROM ev JOIN en USING (sent) WHERE ev.kind = 'Other' AND en.kind = 'MONEY')
    SELECT mention, 'has_property' AS role, entity FROM (SELECT *, row_number() OVER (PARTITION BY mention ORDER BY o DESC, CASE WHEN o THEN 0 ELSE d END, CASE WHEN o THEN -start ELSE start END, CASE WHEN o THEN -entity ELSE entity END) AS r FROM c WHERE o OR d <= 3) WHERE r = 1""")
def property_arguments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values within three tokens of events of a process type."""
    events, entities, arguments = _sentences(spark, sf_dir)
    return E.nearest_arguments(_phrases(events).where("kind = 'Other'"), entities.where("kind = 'MONEY'"), arguments, "has_property", [], 3, at="p1", phrase=True)


@query(_L + """, c AS (SELECT ev.mention, en.entity, start, least(abs(pos - start), abs(pos - fin)) AS d FROM ev JOIN en USING (sent) WHERE en.kind IN ('FOOD', 'SEED'))
    SELECT mention, 'has_artifact' AS role, entity FROM (SELECT *, row_number() OVER (PARTITION BY mention ORDER BY d, start, entity) AS r FROM c WHERE d <= 5) WHERE r = 1 AND entity <> mention + 1""")
def artifact_arguments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest artifact within five tokens, unless it is an argument of the event already."""
    events, entities, arguments = _sentences(spark, sf_dir)
    return E.nearest_arguments(events, entities.where("kind IN ('FOOD', 'SEED')"), arguments, "has_artifact", [], 5, unused=True)


@query(_L + f""", c AS (SELECT ev.mention, en.entity, start, least(abs(pos - start), abs(pos - fin)) AS d FROM ev JOIN en USING (sent) WHERE en.kind = 'PER' AND {_FREE})
    SELECT mention, 'has_actor' AS role, entity FROM (SELECT *, row_number() OVER (PARTITION BY mention ORDER BY d, start, entity) AS r FROM c WHERE d <= 5) WHERE r = 1""")
def nearby_actors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest actor within five tokens of events without one."""
    events, entities, arguments = _sentences(spark, sf_dir)
    return E.nearest_arguments(events, entities.where("kind = 'PER'"), arguments, "has_actor", ["has_artifact"], 5)


@query(_L + """ SELECT DISTINCT ev.mention, 'has_actor' AS role, en.entity FROM ev JOIN en USING (sent) WHERE en.kind IN ('PER', 'MONEY') AND (ev.kind = 'Treat' AND en.fin = pos - 1 OR pos - 2 <= en.start AND en.fin <= pos + 2 AND (en.fin < pos OR en.start > pos)
      OR pos = en.fin + 2 AND EXISTS (SELECT 1 FROM en t WHERE t.sent = ev.sent AND t.kind = 'SEED' AND t.start = en.fin + 1) OR pos = en.start - 2 AND EXISTS (SELECT 1 FROM en t WHERE t.sent = ev.sent AND t.kind = 'FOOD' AND t.start = en.start - 1))""")
def actors_by_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actors by what stands around the anchor; SEED and FOOD entities stand for the tokens 's and against."""
    events, entities, _ = _sentences(spark, sf_dir)
    events = events.withColumn("noun", F.col("kind") == "Treat").withColumn("c0", F.col("pos") - 2).withColumn("c1", F.col("pos") + 2)
    tokens = entities.where("kind IN ('SEED', 'FOOD')").select("sent", F.col("start").alias("pos"), F.when(F.col("kind") == "SEED", "'s").otherwise("against").alias("token"))
    none = spark.createDataFrame([], "mention long, role string, entity long")
    return E.actor_arguments(events, entities.where("kind IN ('PER', 'MONEY')"), none, tokens)


_COS = "(CASE WHEN {ok} THEN greatest(list_cosine_similarity({a}, {b}), 0.0) ELSE 0.0 END)"


@query(_E + _C + f""", m AS (SELECT vec_id, v[1:16] AS text, v[17:32] AS pa, v[33:48] AS pr, v[49:64] AS po, v AS cx FROM e),
    n AS (SELECT label, centroid[1:16] AS nm, centroid[17:32] AS e2, list_transform(range(1, 17), lambda i: (centroid[i] + centroid[i + 16]) / 2) AS av, centroid[33:48] AS np, centroid[49:64] AS no, centroid AS nc FROM c),
    s AS (SELECT vec_id AS mention, label AS node, unnest(['exemplars_max', 'exemplars_average', 'type_name', 'keywords_average', 'context_average']) AS mode, unnest([
      greatest(0.0, list_cosine_similarity(text, nm), list_cosine_similarity(text, e2)), {_COS.format(ok="true", a="text", b="av")}, {_COS.format(ok="true", a="text", b="nm")},
      ({_COS.format(ok="vec_id % 3 <> 0", a="pa", b="e2")} + {_COS.format(ok="vec_id % 4 <> 0", a="pr", b="np")} + {_COS.format(ok="true", a="po", b="no")}) / ((vec_id % 3 <> 0)::INTEGER + (vec_id % 4 <> 0)::INTEGER + 1), {_COS.format(ok="vec_id % 5 <> 0", a="cx", b="nc")}]) AS score FROM m, n)
    SELECT mention, mode, node, score FROM (SELECT mention, mode, node, round(score, 6) AS score, row_number() OVER (PARTITION BY mention, mode ORDER BY round(score, 6) DESC, node) AS r FROM s) WHERE r = 1""")
def similarity_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best node of each mention by every similarity mode; parts of the vectors stand for names, participants and so on."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label", V.doubles("embedding").alias("v"))
    part = lambda c, k: F.slice(F.col(c), 16 * k + 1, 16)
    keep = lambda n, c: F.when(F.col("vec_id") % n != 0, c)
    m = e.select(F.col("vec_id").alias("mention"), part("v", 0).alias("text"), keep(3, part("v", 1)).alias("participants"), keep(4, part("v", 2)).alias("processes"), part("v", 3).alias("properties"), keep(5, F.col("v")).alias("context"))
    c = V.average(e, ["label"], "v", name="c")
    mean = F.zip_with(part("c", 0), part("c", 1), lambda a, b: (a + b) / 2)
    n = c.select(F.col("label").alias("node"), part("c", 0).alias("node_name"), F.array(part("c", 0), part("c", 1)).alias("node_exemplars"), mean.alias("node_average"), part("c", 1).alias("node_participants"), part("c", 2).alias("node_processes"), part("c", 3).alias("node_properties"), F.col("c").alias("node_context"))
    return O.best_by_mode(m, n)


@query("""WITH g AS (SELECT DISTINCT l_orderkey AS event, CASE l_returnflag WHEN 'A' THEN 'time' WHEN 'N' THEN 'place' ELSE 'agent' END AS role, l_suppkey % 10 AS v FROM lineitem), p AS (SELECT DISTINCT x.event AS a, y.event AS b FROM g x JOIN g y ON y.event = x.event + 1),
    j AS (SELECT x.event AS a, y.event AS b, x.role, bool_or(x.v = y.v OR x.role <> 'agent' AND abs(x.v - y.v) = 5) AS ok, count(DISTINCT x.v) + count(DISTINCT CASE WHEN y.v NOT IN (SELECT v FROM g z WHERE z.event = x.event AND z.role = x.role) THEN y.v END) AS n FROM g x JOIN g y ON y.event = x.event + 1 AND x.role = y.role GROUP BY ALL)
    SELECT p.a, p.b, coalesce(bool_or(NOT CASE WHEN p.a % 4 = 0 AND role = 'agent' THEN n <= 2 ELSE ok END), false) AS conflict FROM p LEFT JOIN j USING (a, b) GROUP BY ALL""")
def argument_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether an order's arguments conflict with those of the next one; some pairs may have two agents together."""
    from factloom.operators import coreference as C

    role = F.when(F.col("l_returnflag") == "A", "time").when(F.col("l_returnflag") == "N", "place").otherwise("agent")
    g = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("event"), role.alias("role"), F.concat(F.lit("v"), F.col("l_suppkey") % 10).alias("value")).distinct()
    events = g.select("event").distinct()
    pairs = events.select(F.col("event").alias("a"), (F.col("event") + 1).alias("b")).join(events.select(F.col("event").alias("b")), "b", "left_semi").select("a", "b")
    inside = spark.createDataFrame([(f"v{k + 5}", f"v{k}") for k in range(5)], "value string, outer string")
    two = pairs.where("a % 4 = 0").select("a", "b", F.lit("agent").alias("role"), F.lit(2).alias("n"))
    return C.argument_conflicts(pairs, g, inside, at_most=two)
