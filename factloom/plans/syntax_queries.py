"""Triggers, phrases, trees, coreference conflicts, structured inputs and their serialised forms. Lines of an order stand for tokens of a sentence."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from factloom.operators import coreference as C, regression, structured, syntax as S
from factloom.plans.registry import query
from factloom.sources import sinks
from factloom.sources.tables import table


@query("""
    WITH t AS (SELECT p_partkey AS id, p_name AS text FROM part UNION ALL SELECT s_suppkey + 1000000, s_name FROM supplier UNION ALL SELECT n_nationkey + 2000000, n_name FROM nation)
    SELECT id, len(string_split(text, ' ')) <= 5 AND len(list_filter(string_split(text, ' '), lambda x: NOT (regexp_full_match(x, '[A-Za-z-]*') AND length(replace(x, '-', '')) >= 2))) = 0 AS valid FROM t
""")
def valid_triggers(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").selectExpr("p_partkey AS id", "p_name AS text")
    s = table(spark, sf_dir, "supplier").selectExpr("s_suppkey + 1000000 AS id", "s_name AS text")
    n = table(spark, sf_dir, "nation").selectExpr("cast(n_nationkey + 2000000 AS bigint) AS id", "n_name AS text")
    return p.union(s).union(n).select("id", S.valid_trigger(F.col("text")).alias("valid"))


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus = 'F' OR (o_orderstatus = 'O' AND upper(o_orderpriority) LIKE '%URGENT%')")
def pos_triggers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statuses stand for tags, a constant word for the verb, the urgency for a listed noun."""
    tag = F.when(F.col("o_orderstatus") == "F", "VBD").when(F.col("o_orderstatus") == "O", "NN").otherwise("NNP")
    word = F.when(F.col("o_orderstatus") == "F", "moved").when(F.upper("o_orderpriority").contains("URGENT"), "attack").otherwise("table")
    o = table(spark, sf_dir, "orders").withColumn("tag", tag).withColumn("word", word)
    return S.pos_triggers(o, "word", "tag", ["said"], ["attack"]).select("o_orderkey", "o_orderpriority")


_SECOND = "(minute(ts) * 60 + second(ts))"


@query(f"""
    WITH a AS (SELECT event_id AS anchor, user_id, {_SECOND} AS a0, {_SECOND} + 99 AS a1 FROM events WHERE event_type = 'purchase'),
    n AS (SELECT event_id AS node, user_id, {_SECOND} - 300 AS n0, {_SECOND} - 300 + 200 + 200 * (event_id % 7) AS n1 FROM events WHERE event_type = 'view')
    SELECT anchor, node FROM (SELECT anchor, node, row_number() OVER (PARTITION BY anchor ORDER BY (n1 - n0 + 1) / (a1 - a0 + 1), node) AS r FROM a JOIN n USING (user_id) WHERE n0 <= a0 AND a1 <= n1 AND (n1 - n0 + 1) / (a1 - a0 + 1) < 5) WHERE r = 1
""")
def smallest_noun_phrase(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("at", F.expr(_SECOND))
    a = e.where("event_type = 'purchase'").selectExpr("event_id AS anchor", "user_id", "at AS a0", "at + 99 AS a1")
    n = e.where("event_type = 'view'").selectExpr("event_id AS node", "user_id", "at - 300 AS n0", "at - 300 + 200 + 200 * (event_id % 7) AS n1")
    return S.smallest_cover(a, n, ["user_id"], "anchor", 600, ("a0", "a1"), ("n0", "n1"), ["node"]).select("anchor", "node")


@query(f"""
    WITH e AS (SELECT event_id, user_id, event_type, {_SECOND} AS at FROM events),
    p AS (SELECT l.event_id AS light, t.event_id AS typed, t.event_type AS kind, abs(l.at - t.at) AS d FROM e l JOIN e t ON l.user_id = t.user_id WHERE l.event_type = 'view' AND t.event_type IN ('purchase', 'signup') AND abs(l.at - t.at) <= 600)
    SELECT light, typed, kind FROM (SELECT *, row_number() OVER (PARTITION BY light ORDER BY d, typed) AS r FROM p) WHERE r = 1
""")
def light_verb_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Light verbs take the type of the nearest typed mention within reach."""
    e = table(spark, sf_dir, "events").withColumn("at", F.expr(_SECOND))
    light = e.where("event_type = 'view'").selectExpr("event_id AS light", "user_id", "at AS l0")
    typed = e.where("event_type IN ('purchase', 'signup')").selectExpr("event_id AS typed", "user_id", "event_type AS kind", "at AS t0")
    return S.typed_by_neighbour(light, typed, ["user_id"], "light", 600, ("l0", "t0"), ["typed"]).select("light", "typed", "kind")


@query("""
    WITH t AS (SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS r FROM events WHERE event_type IN ('purchase', 'signup'))
    SELECT l.event_id AS light, t.event_id AS typed, t.event_type AS kind FROM events l JOIN t USING (user_id) WHERE t.r = 1 AND l.event_type = 'view'
""")
def light_anchor_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Light anchors take the best typed mention of their entity chain (a user)."""
    e = table(spark, sf_dir, "events")
    light = e.where("event_type = 'view'").selectExpr("event_id AS light", "user_id")
    typed = e.where("event_type IN ('purchase', 'signup')").selectExpr("event_id AS typed", "user_id", "event_type AS kind", "value")
    return S.typed_by_chain(light, typed, "user_id", [F.desc("value"), F.asc("typed")]).select("light", "typed", "kind")


@query("""
    WITH t AS (SELECT *, min(l_linenumber) OVER (PARTITION BY l_orderkey) AS f FROM lineitem), u AS (SELECT *, max(CASE WHEN l_returnflag = 'R' AND l_linenumber > f THEN l_linenumber END) OVER (PARTITION BY l_orderkey) AS p FROM t)
    SELECT l_orderkey, l_linenumber FROM (SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY CASE WHEN l_linenumber = p - 1 AND l_linestatus <> 'O' THEN 0 ELSE 1 END, l_quantity DESC, l_linenumber, l_partkey) AS r FROM u) WHERE r = 1
""")
def canonical_mention(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem")
    return S.canonical_mention(l, ["l_orderkey"], "l_linenumber", F.col("l_returnflag") == "R", F.col("l_linestatus") == "O", F.col("l_quantity")).select("l_orderkey", "l_linenumber")


@query("""
    SELECT l_orderkey, l_linenumber, CASE WHEN b THEN l_linenumber ELSE coalesce(max(CASE WHEN b THEN l_linenumber END) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1, min(l_linenumber) OVER (PARTITION BY l_orderkey)) END AS phrase_start,
      CASE WHEN b THEN l_linenumber ELSE coalesce(min(CASE WHEN b THEN l_linenumber END) OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) - 1, max(l_linenumber) OVER (PARTITION BY l_orderkey)) END AS phrase_end
    FROM (SELECT l_orderkey, l_linenumber, bool_or(l_returnflag = 'R') AS b FROM lineitem GROUP BY ALL) WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber)
""")
def anchor_context_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.bool_or(F.col("l_returnflag") == "R").alias("b"))
    return S.between_blockers(l, ["l_orderkey"], "l_linenumber", F.col("b")).drop("b")


@query(f"""
    WITH e AS (SELECT event_id, user_id, event_type, {_SECOND} AS at FROM events)
    SELECT event_id FROM e WHERE event_type <> 'purchase' AND NOT EXISTS (SELECT 1 FROM e m WHERE m.event_type = 'purchase' AND m.user_id = e.user_id AND m.at - 60 <= e.at + 10 AND e.at <= m.at + 5 + 60)
""")
def pattern_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mentions within 60 positions of a pattern match go."""
    e = table(spark, sf_dir, "events").withColumn("at", F.expr(_SECOND))
    mention = e.where("event_type <> 'purchase'").selectExpr("event_id", "user_id", "at AS s0", "at + 10 AS s1")
    match = e.where("event_type = 'purchase'").selectExpr("user_id", "at AS m0", "at + 5 AS m1")
    return S.prune_near(mention, match, ["user_id"], 120, 60, "event_id", ("s0", "s1"), ("m0", "m1")).select("event_id")


_UP = "SELECT event_id AS child, event_id // (1::BIGINT << k) AS ancestor, k AS steps FROM (SELECT event_id FROM events WHERE event_id > 0), (SELECT unnest(range(0, 5)) AS k) WHERE event_id // (1::BIGINT << k) > 0"


def _tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").where("event_id > 0").selectExpr("event_id AS node", "nullif(event_id div 2, 0) AS parent", "1 + event_id % 7 AS tokens")


@query(f"""
    WITH up AS ({_UP}), p AS (SELECT a.child AS l, b.child AS r, a.ancestor AS meet, a.steps AS steps_up, b.steps AS steps_down FROM up a JOIN up b ON b.child = a.child + 1 AND a.ancestor = b.ancestor)
    SELECT l, r, meet, steps_up, steps_down FROM (SELECT *, row_number() OVER (PARTITION BY l, r ORDER BY steps_up + steps_down, meet) AS k FROM p) WHERE k = 1
""")
def predicate_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths between neighbouring predicates over their lowest common ancestor."""
    t = _tree(spark, sf_dir)
    return S.tree_paths(t.selectExpr("node AS l", "node + 1 AS r"), t, "l", "r", "node", "parent", 4)


@query(f"""
    WITH up AS ({_UP}), k AS (SELECT event_id AS child, 1 + event_id % 7 AS tokens FROM events WHERE event_id > 0),
    bad AS (SELECT up.child, min(steps) AS b FROM up JOIN k ON up.ancestor = k.child WHERE tokens > 5 GROUP BY 1)
    SELECT up.child AS node, min_by(up.ancestor, -up.steps) AS expansion FROM up LEFT JOIN bad USING (child) WHERE b IS NULL OR up.steps < b GROUP BY 1
""")
def anchor_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.expanded_anchor(_tree(spark, sf_dir), "node", "parent", "tokens", 5, 4)


@query("SELECT event_id, CASE WHEN event_type = 'purchase' THEN 'has_actor' ELSE 'has_location' END AS event_role FROM events WHERE (event_type = 'purchase' AND user_id % 2 = 0) OR (event_type = 'view' AND user_id % 2 = 1)")
def generic_arguments(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("kind", F.when(F.col("user_id") % 2 == 0, "PER").otherwise("GPE"))
    return S.role_arguments(e, "event_type", "kind", {("purchase", "PER"): "has_actor", ("view", "GPE"): "has_location"}).select("event_id", "event_role")


@query("""
    WITH l AS (SELECT l_orderkey, l_linenumber, l_returnflag, l_suppkey % 5 AS filler FROM lineitem), m AS (SELECT *, dense_rank() OVER (PARTITION BY l_orderkey ORDER BY filler) AS variant FROM l WHERE l_returnflag = 'A'),
    n AS (SELECT l_orderkey, max(variant) AS n FROM m GROUP BY 1), r AS (SELECT l.l_orderkey, unnest(range(1, coalesce(n, 1) + 1)) AS variant FROM l LEFT JOIN n USING (l_orderkey) WHERE l_returnflag <> 'A')
    SELECT l_orderkey, variant, count(*) AS n_arguments FROM (SELECT l_orderkey, variant FROM m UNION ALL SELECT l_orderkey, variant FROM r) GROUP BY ALL
""")
def role_shatter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with several fillers of a unique role become one event for each."""
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", (F.col("l_suppkey") % 5).alias("filler"))
    return C.shatter(l, ["l_orderkey"], "l_returnflag", "filler", "A").groupBy("l_orderkey", "variant").agg(F.count("*").alias("n_arguments"))


@query("""
    WITH g AS (SELECT user_id, list(DISTINCT CASE event_type WHEN 'click' THEN 'NN' WHEN 'view' THEN 'NNS' ELSE 'VB' END) AS tags FROM events GROUP BY 1)
    SELECT a.user_id, (list_contains(a.tags, 'NN') AND list_contains(b.tags, 'NNS')) OR (list_contains(a.tags, 'NNS') AND list_contains(b.tags, 'NN')) AS conflict FROM g a JOIN g b ON b.user_id = a.user_id + 1
""")
def tag_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tag = F.when(F.col("event_type") == "click", "NN").when(F.col("event_type") == "view", "NNS").otherwise("VB")
    g = table(spark, sf_dir, "events").groupBy("user_id").agg(F.collect_set(tag).alias("tags"))
    b = g.select((F.col("user_id") - 1).alias("user_id"), F.col("tags").alias("other"))
    return g.join(b, "user_id").select("user_id", C.tag_conflict(F.col("tags"), F.col("other")).alias("conflict"))


@query("""
    SELECT doc_id, regexp_matches(text, '(^|[^A-Za-z])(because|due to)([^A-Za-z]|$)', 'i') AS causal, regexp_matches(text, '(^|[^A-Za-z])(after|before)([^A-Za-z]|$)', 'i') AS temporal, regexp_matches(text, '(^|[^A-Za-z])(not|no|never)([^A-Za-z]|$)', 'i') AS negative FROM documents
""")
def connective_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = {"causal": ["because", "due to"], "temporal": ["after", "before"], "negative": ["not", "no", "never"]}
    return table(spark, sf_dir, "documents").select("doc_id", C.indicators(F.col("text"), lists).alias("i")).select("doc_id", "i.*")


def _structured(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref = lambda k: F.struct(F.struct(F.concat(F.lit("file"), F.col(k).cast("string")).alias("inputId"), F.lit(1).alias("frameIdx"), (F.col("o_orderkey") % 3).cast("int").alias("entryIdx")).alias("descriptor"))
    sure = F.when(F.col("o_orderstatus") == "F", F.struct(F.lit("high").alias("reliability")))
    body = F.to_json(F.struct(F.lit("causes").alias("type"), ref("o_custkey").alias("cause"), ref("o_orderkey").alias("effect"), sure.alias("confidence")))
    back = table(spark, sf_dir, "orders").select("o_orderkey", F.from_json(body, structured.RELATIONSHIP).alias("r"))
    return structured.causal_relations(back, "o_orderkey", "r")


_STRUCTURED = "SELECT concat('Relationship-', o_orderkey) AS relation, concat('Factor-file', o_custkey, '-1-', o_orderkey % 3) AS cause, concat('Worksheet-file', o_custkey, '-1') AS cause_sheet, concat('Factor-file', o_orderkey, '-1-', o_orderkey % 3) AS effect, CASE o_orderstatus WHEN 'F' THEN 'high' ELSE 'low' END AS reliability FROM orders"


@query(_STRUCTURED)
def structured_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Causal relations between columns of files, from JSON."""
    return _structured(spark, sf_dir).drop("kind", "effect_sheet")


@query(f"WITH r AS ({_STRUCTURED}) SELECT p, count(*) AS n, min(o) AS first_o FROM (SELECT unnest(['type', 'has_cause', 'has_effect', 'reliability']) AS p, unnest(['causes', cause, effect, reliability]) AS o FROM r) GROUP BY p")
def structured_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structured.relation_triples(_structured(spark, sf_dir)).groupBy("p").agg(F.count("*").alias("n"), F.min("o").alias("first_o"))


@query("""
    SELECT s, p, o FROM (SELECT concat('event/', o_orderkey) AS s, unnest(['type', 'time']) AS p, unnest([o_orderstatus, strftime(o_orderdate, '%Y-%m-%d')]) AS o FROM orders
      UNION ALL SELECT concat('event/', o_orderkey), 'has_part', concat('part/', l_partkey) FROM orders JOIN lineitem ON l_orderkey = o_orderkey)
""")
def event_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    role = F.struct(F.lit("has_part").alias("role"), F.concat(F.lit("part/"), F.col("l_partkey").cast("string")).alias("filler"))
    args = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_list(role).alias("arguments"))
    o = table(spark, sf_dir, "orders").withColumn("time", F.date_format("o_orderdate", "yyyy-MM-dd")).join(args, "o_orderkey", "left")
    return sinks.event_triples(o, "o_orderkey", "o_orderstatus", "arguments", {"time": "time"})


@query("""
    WITH i AS (SELECT s_nationkey AS event, s_suppkey AS instance FROM supplier), r AS (SELECT n_nationkey AS id, CASE n_regionkey WHEN 0 THEN 'before' ELSE 'causes' END AS kind, n_nationkey AS l, (n_nationkey + 1) % 25 AS r, n_regionkey AS strength FROM nation)
    SELECT a.instance::VARCHAR AS s, 'precedes' AS p, b.instance::VARCHAR AS o FROM r JOIN i a ON a.event = r.l JOIN i b ON b.event = r.r WHERE kind = 'before'
    UNION ALL SELECT concat('assertion/', id), unnest(['type', 'left', 'right', 'confidence', 'strength']), unnest([kind, l::VARCHAR, r::VARCHAR, '0.00', strength::VARCHAR]) FROM r WHERE kind <> 'before'
""")
def causal_assertions(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = table(spark, sf_dir, "supplier").selectExpr("s_nationkey AS event", "s_suppkey AS instance")
    r = table(spark, sf_dir, "nation").selectExpr("n_nationkey AS id", "CASE n_regionkey WHEN 0 THEN 'before' ELSE 'causes' END AS kind", "n_nationkey AS l", "(n_nationkey + 1) % 25 AS r", "n_regionkey AS strength")
    return sinks.causal_assertions(r, i, "id", "kind", ("l", "r"), "event", "instance", "strength")


@query("SELECT o_orderkey, count(l_linenumber) AS n_frames FROM orders LEFT JOIN (SELECT * FROM lineitem WHERE l_returnflag <> 'R') ON l_orderkey = o_orderkey GROUP BY 1")
def unification_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames of each document as JSON without temporal relations; documents without frames have an empty list."""
    l = table(spark, sf_dir, "lineitem").where("l_returnflag <> 'R'").select(F.col("l_orderkey").alias("o_orderkey"), F.struct("l_linenumber", "l_returnflag").alias("frame"))
    j = sinks.frames_json(table(spark, sf_dir, "orders"), l, "o_orderkey", "frame")
    return j.select("o_orderkey", F.json_array_length("frames").cast("long").alias("n_frames"))


@query("SELECT CASE WHEN grouping(n_name) = 1 THEN 'all' ELSE n_name END AS place, CASE WHEN grouping(month) = 1 THEN 0 ELSE month END AS month, count(*) AS n FROM (SELECT n_name, month(o_orderdate) AS month FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey) GROUP BY GROUPING SETS ((n_name, month), (n_name), (month), ())")
def location_time_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by place and month with their totals."""
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.expr("c_custkey = o_custkey")).join(table(spark, sf_dir, "nation"), F.expr("n_nationkey = c_nationkey"))
    c = o.withColumn("month", F.month("o_orderdate").cast("long")).cube("n_name", "month").agg(F.count("*").alias("n"), F.grouping("n_name").alias("gp"), F.grouping("month").alias("gm"))
    return c.select(F.when(F.col("gp") == 1, "all").otherwise(F.col("n_name")).alias("place"), F.when(F.col("gm") == 1, F.lit(0)).otherwise(F.col("month")).cast("long").alias("month"), "n")


@query("WITH g AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z]+') AS w FROM documents), b AS (SELECT DISTINCT doc_id, concat(w[i], ' ', w[i + 1]) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM g)) SELECT x.doc_id, count(*) AS shared FROM b x JOIN b y ON y.doc_id = x.doc_id + 1 AND x.g = y.g GROUP BY 1")
def shared_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct word bigrams that each document shares with the next."""
    w = F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))
    d = table(spark, sf_dir, "documents").select("doc_id", w.alias("w"))
    grams = F.array_distinct(F.zip_with("w", F.slice("w", 2, F.greatest(F.size("w") - 1, F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b)))
    g = d.select("doc_id", F.filter(grams, lambda x: x.isNotNull()).alias("g"))
    nxt = g.select((F.col("doc_id") - 1).alias("doc_id"), F.col("g").alias("h"))
    return g.join(nxt, "doc_id").select("doc_id", F.size(F.array_intersect("g", "h")).cast("long").alias("shared")).where("shared > 0")


@query("SELECT round(regr_slope(l_extendedprice, l_quantity) * stddev_samp(l_quantity), 2) AS coefficient FROM lineitem")
def regression_coefficient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The coefficient of a normalised feature."""
    l = table(spark, sf_dir, "lineitem")
    model = regression.fit(l, ["l_quantity"], "l_extendedprice").stages[-1]
    return spark.createDataFrame([(round(float(model.coefficients[0]), 2),)], "coefficient DOUBLE")
