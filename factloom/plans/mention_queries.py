"""Event mentions: arguments, types, factors, relations between mentions. Events, orders and conversations stand for mentions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from factloom.functions import text as X
from factloom.operators import learning, mentions as M, resolvers as R, selection
from factloom.plans.registry import query
from factloom.sources.tables import table


@query("SELECT doc_id, CASE WHEN contains(lower(text), ' not ') OR contains(lower(text), 'without') THEN 'NEGATIVE' ELSE 'POSITIVE' END AS polarity, CASE WHEN contains(lower(text), 'because') THEN 'because' WHEN contains(lower(text), ' was ') THEN ' was ' WHEN contains(lower(text), ' the ') THEN ' the ' END AS connective FROM documents")
def eer_polarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polarity and connective of the text between two mentions."""
    t = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", M.polarity_between(t, [" not ", "without"]).alias("polarity"), M.first_contained(t, ["because", " was ", " the "]).alias("connective"))


@query("""
    WITH m AS (SELECT event_id, min(event_id) OVER (PARTITION BY user_id, date_trunc('hour', ts)) AS survivor FROM events WHERE value > 10)
    SELECT e.event_id AS relation, a.survivor AS l, b.survivor AS r FROM events e JOIN m a ON a.event_id = e.event_id JOIN m b ON b.event_id = e.event_id + 1 WHERE a.survivor <> b.survivor
""")
def eer_reattach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relations follow the mentions that survive a merge."""
    e = table(spark, sf_dir, "events")
    w = W.partitionBy("user_id", F.date_trunc("hour", F.col("ts").cast("timestamp")))
    m = e.where("value > 10").select("event_id", F.min("event_id").over(w).alias("survivor"))
    rel = e.select(F.col("event_id").alias("relation"), F.col("event_id").alias("l"), (F.col("event_id") + 1).alias("r"))
    return M.reattach(rel, m, ("l", "r"), "event_id", "survivor").select("relation", "l", "r")


@query("""
    WITH r AS (SELECT event_id AS l, event_id + 3 AS r FROM events WHERE event_type = 'purchase')
    SELECT event_id, event_type FROM events WHERE event_type <> 'view' OR event_id IN (SELECT l FROM r) OR event_id IN (SELECT r FROM r)
""")
def standalone_generic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generic mentions that no relation has go."""
    e = table(spark, sf_dir, "events")
    r = e.where("event_type = 'purchase'").select(F.col("event_id").alias("l"), (F.col("event_id") + 3).alias("r"))
    return M.prune_generic(e, r, "event_id", F.array("event_type"), ["view"], ("l", "r")).select("event_id", "event_type")


_TYPES = "WITH t AS (SELECT user_id, hour(ts) AS h, list_sort(list(DISTINCT CASE event_type WHEN 'click' THEN 'Increase' WHEN 'view' THEN 'Decrease' ELSE event_type END)) AS types FROM events GROUP BY ALL)"


def _types(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "click", "Increase").when(F.col("event_type") == "view", "Decrease").otherwise(F.col("event_type"))
    return table(spark, sf_dir, "events").groupBy("user_id", F.hour("ts").cast("long").alias("h")).agg(F.array_sort(F.collect_set(kind)).alias("types"))


@query(_TYPES + " SELECT user_id, h, array_to_string(list_filter(types, lambda x: x NOT IN ('Increase', 'Decrease')), ',') AS types FROM t WHERE len(list_filter(types, lambda x: x NOT IN ('Increase', 'Decrease'))) > 0")
def trend_dropper(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _types(spark, sf_dir).withColumn("types", M.strip_trends(F.col("types"))).where(F.size("types") > 0)
    return t.select("user_id", "h", F.array_join("types", ",").alias("types"))


@query(_TYPES + " SELECT user_id, h, CASE WHEN len(list_filter(types, lambda x: x IN ('purchase', 'signup'))) = 0 THEN 'default' ELSE array_to_string(list_filter(types, lambda x: x IN ('purchase', 'signup')), ',') END AS types FROM t")
def intervention_whitelist(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _types(spark, sf_dir)
    return t.select("user_id", "h", F.array_join(M.keep_listed(F.col("types"), ["purchase", "signup"], F.lit("default")), ",").alias("types"))


@query(_TYPES + " SELECT t AS missing FROM (SELECT DISTINCT unnest(types) AS t FROM t) WHERE t NOT IN ('Increase', 'purchase', 'signup')")
def ontology_constraint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types that the ontology lacks."""
    known = spark.createDataFrame([("Increase",), ("purchase",), ("signup",)], "missing string")
    return M.unknown(_types(spark, sf_dir).select(F.explode("types").alias("missing")), known, "missing")


@query("""
    SELECT o_orderkey, kind, round(score, 6) AS score FROM (SELECT o_orderkey, unnest(CASE WHEN o_orderstatus = 'F' THEN ['F', o_orderpriority] ELSE [o_orderstatus, o_orderpriority] END) AS kind, unnest([1.0, 0.0]::DOUBLE[]) AS score FROM orders)
""")
def primary_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The primary type is always among the types, with score zero if it was missing."""
    types = F.array(F.struct(F.col("o_orderstatus").alias("type"), F.lit(1.0).alias("score")))
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.inline(M.with_primary(types, F.col("o_orderpriority"))))
    return o.select("o_orderkey", F.col("type").alias("kind"), "score")


@query("SELECT event_id, CASE WHEN value > 50 THEN 'generic' ELSE event_type END AS kind, round(CASE WHEN value > 50 THEN value / 1000 ELSE 1.0 END, 6)::DOUBLE AS score FROM events")
def generic_from_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.array().cast("array<struct<type:string,score:double>>")
    types = F.when(F.col("value") > 50, none).otherwise(F.array(F.struct(F.col("event_type").alias("type"), F.lit(1.0).alias("score"))))
    e = table(spark, sf_dir, "events").withColumn("factors", F.array(F.struct((F.col("value") / 1000).alias("relevance")))).withColumn("types", types)
    out = e.select("event_id", F.inline(M.generic_from_factors(F.col("types"), F.col("factors"), "generic")))
    return out.select("event_id", F.col("type").alias("kind"), F.round("score", 6).alias("score"))


@query("SELECT event_id, CASE WHEN event_type = 'error' AND value <= 90 THEN 'success' ELSE event_type END AS kind, round(CASE WHEN event_type = 'error' AND value <= 90 THEN -value ELSE value END, 6) AS magnitude FROM events")
def opposite_flip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An opposite factor is turned around unless the positive one is there."""
    f = lambda t, m: F.struct(F.lit(t).alias("type") if isinstance(t, str) else t.alias("type"), m.alias("magnitude"))
    both = F.when(F.col("value") > 90, F.array(f(F.col("event_type"), F.col("value")), f("success", F.lit(1.0)))).otherwise(F.array(f(F.col("event_type"), F.col("value"))))
    e = table(spark, sf_dir, "events").select("event_id", both.alias("fs")).select("event_id", M.flip_opposites(F.col("fs"), {"error": "success"})[0].alias("f"))
    return e.select("event_id", F.col("f.type").alias("kind"), F.round("f.magnitude", 6).alias("magnitude"))


@query("SELECT event_id, round(coalesce(CASE WHEN event_type = 'view' THEN value END, CASE WHEN event_type = 'click' THEN value / 2 END, 1.0), 6) AS confidence FROM events")
def max_grounding_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.array().cast("array<double>")
    pick = lambda kind, v: F.when(F.col("event_type") == kind, F.array(v, v / 3)).otherwise(none)
    return table(spark, sf_dir, "events").select("event_id", F.round(M.best_grounding(pick("view", F.col("value")), pick("click", F.col("value") / 2)), 6).alias("confidence"))


@query("""
    SELECT l_orderkey, role, n FROM (SELECT l_orderkey, CASE l_returnflag WHEN 'A' THEN 'has_actor' WHEN 'R' THEN 'has_location' END AS role, count(DISTINCT l_linenumber) AS n FROM lineitem GROUP BY ALL) WHERE role IS NOT NULL
""")
def role_normalisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    role = F.when(F.col("l_returnflag") == "A", "Agent").when(F.col("l_returnflag") == "R", "Place").otherwise("Money")
    a = table(spark, sf_dir, "lineitem").select("l_orderkey", role.alias("role"), F.col("l_linenumber").alias("s"), F.col("l_linenumber").alias("e"))
    return M.canonical_roles(a, "l_orderkey", "role", "s", "e").groupBy("l_orderkey", "role").agg(F.count("*").alias("n"))


_COVER = "WITH s AS (SELECT event_id, user_id, floor(epoch(ts))::BIGINT AS a, floor(epoch(ts))::BIGINT + (value * 100)::BIGINT AS b FROM events)"


@query(_COVER + """
    SELECT event_id FROM s x WHERE NOT EXISTS (SELECT 1 FROM s y WHERE y.user_id = x.user_id AND y.event_id <> x.event_id AND y.a <= x.a AND y.b >= x.b AND (y.a < x.a OR y.b > x.b OR y.event_id < x.event_id))
""")
def overlapping_arguments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arguments that no other one covers."""
    at = F.unix_seconds(F.col("ts").cast("timestamp"))
    s = table(spark, sf_dir, "events").select("event_id", "user_id", at.alias("a"), (at + F.round(F.col("value") * 100).cast("long")).alias("b"))
    return M.drop_covered(s, ["user_id"], "a", "b", "event_id").select("event_id")


@query("""
    SELECT bigram, count(*) AS n FROM (SELECT concat(lag(role) OVER (PARTITION BY conv_id ORDER BY turn), ' ', role) AS bigram, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS p FROM conversations) WHERE p IS NOT NULL GROUP BY 1
""")
def lemma_bigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = M.bigrams(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role").where(F.contains("bigram", F.lit(" ")))
    return b.groupBy("bigram").agg(F.count("*").alias("n"))


@query("SELECT y AS outer_date, count(*) AS n FROM (SELECT strftime(o_orderdate, '%Y-%m') AS y FROM orders WHERE o_orderstatus = 'F') WHERE starts_with(y, '1995') GROUP BY 1")
def time_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.date_format("o_orderdate", "yyyy-MM").alias("outer_date"))
    return o.where(M.time_contains(F.lit("1995"), F.col("outer_date"))).groupBy("outer_date").agg(F.count("*").alias("n"))


@query("""
    SELECT conv_id, turn, other AS place_turn, gap FROM (SELECT u.conv_id, u.turn, a.turn AS other, abs(u.turn - a.turn) AS gap, row_number() OVER (PARTITION BY u.conv_id, u.turn ORDER BY abs(u.turn - a.turn), a.turn) AS r
      FROM conversations u JOIN conversations a ON u.conv_id = a.conv_id AND u.role = 'user' AND a.role = 'assistant' WHERE abs(u.turn - a.turn) <= 3) WHERE r = 1
""")
def nearest_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    u = c.where("role = 'user'").select("conv_id", "turn", F.concat_ws("-", "conv_id", "turn").alias("m"))
    a = c.where("role = 'assistant'").select("conv_id", F.col("turn").alias("place_turn"))
    out = M.neighbours_by_tokens(u, a, ["conv_id"], "turn", "place_turn", 3, "m", "place_turn")
    return out.select("conv_id", "turn", "place_turn", F.col("distance").alias("gap"))


@query("""
    SELECT user_id, h, round(max(value), 6) AS confidence, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS types, count(DISTINCT event_id % 7) AS n_args FROM (SELECT *, date_trunc('hour', ts) AS h FROM events) GROUP BY ALL
""")
def frame_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", F.date_trunc("hour", F.col("ts").cast("timestamp")).cast("timestamp_ntz").alias("h"), "value", F.array("event_type").alias("types"), F.array(F.col("event_id") % 7).alias("args"))
    out = M.frames_merged(e, ["user_id", "h"], "value", "types", "args")
    return out.select("user_id", "h", F.round("value", 6).alias("confidence"), F.array_join("types", ",").alias("types"), F.size("args").cast("long").alias("n_args"))


@query("SELECT least(l_partkey % 50, l_suppkey % 50) AS a, greatest(l_partkey % 50, l_suppkey % 50) AS b, count(*) AS n, round(avg(l_discount), 6) AS confidence FROM lineitem GROUP BY ALL")
def relation_frame_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relations of one unordered pair; their confidence is the mean of their mentions'."""
    p = M.unordered(F.col("l_partkey") % 50, F.col("l_suppkey") % 50)
    l = table(spark, sf_dir, "lineitem").groupBy(p.alias("p")).agg(F.count("*").alias("n"), F.round(F.avg("l_discount"), 6).alias("confidence"))
    return l.select(F.col("p")[0].alias("a"), F.col("p")[1].alias("b"), "n", "confidence")


@query("""
    WITH RECURSIVE t AS (SELECT p_partkey AS n, p_partkey // 3 AS p FROM part WHERE p_partkey > 0), a AS (SELECT n, p AS up, 1 AS d FROM t UNION ALL SELECT a.n, t.p, d + 1 FROM a JOIN t ON a.up = t.n WHERE d < 3)
    SELECT n, string_agg(concat('c', up), '>' ORDER BY d) AS path FROM a WHERE up > 0 GROUP BY n
""")
def modal_tree_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of a node's ancestors up to three levels."""
    t = table(spark, sf_dir, "part").where("p_partkey > 0").selectExpr("p_partkey AS n", "p_partkey div 3 AS p", "concat('c', p_partkey) AS l")
    return M.ancestors(t, "n", "p", "l", 3).select("n", F.array_join("labels", ">").alias("path"))


@query("SELECT a.event_id AS before_id, b.event_id AS after_id FROM events a JOIN events b ON a.user_id = b.user_id AND a.ts::DATE = b.ts::DATE AND a.event_type = 'signup' AND b.event_type IN ('purchase', 'error') AND a.ts < b.ts")
def before_after_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("d"), "event_id", "event_type", "ts")
    a = e.where("event_type = 'signup'").select("user_id", "d", F.col("event_id").alias("before_id"), F.col("ts").alias("t"))
    b = e.where("event_type IN ('purchase', 'error')").select("user_id", "d", F.col("event_id").alias("after_id"), "ts")
    return a.join(b, ["user_id", "d"]).where("t < ts").select("before_id", "after_id")


@query("SELECT l_orderkey, l_linenumber FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R') k WHERE k.l_partkey = l.l_partkey AND k.l_suppkey = l.l_suppkey)")
def known_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relations whose pair is not known yet."""
    l = table(spark, sf_dir, "lineitem")
    return R.without_listed(l, l.where("l_returnflag = 'R'"), ["l_partkey", "l_suppkey"]).select("l_orderkey", "l_linenumber")


@query("SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM (SELECT 'en' AS lang, 'idiot' AS phrase UNION ALL SELECT 'fr', 'de la' UNION ALL SELECT 'de', 'und die') b WHERE b.lang = d.lang AND contains(lower(d.text), b.phrase))")
def premod_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events go if their sentence has a bad phrase of their type."""
    bad = spark.createDataFrame([("en", "idiot"), ("fr", "de la"), ("de", "und die")], "lang string, phrase string")
    d = table(spark, sf_dir, "documents")
    hits = d.join(F.broadcast(bad), "lang").where(F.contains(F.lower("text"), F.col("phrase"))).select("doc_id").distinct()
    return d.select("doc_id").join(hits, "doc_id", "left_anti")


@query("SELECT c_custkey, coalesce(CASE WHEN n_regionkey = 1 THEN concat('https://en.wikipedia.org/wiki/', n_name) END, CASE WHEN n_regionkey = 2 THEN concat('geo:', n_nationkey) END) AS uri FROM customer JOIN nation ON c_nationkey = n_nationkey")
def external_uri(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A link of the actor, rewritten, else that of its place."""
    c = table(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "n_nationkey").join(table(spark, sf_dir, "nation"), "n_nationkey")
    link = F.regexp_replace(F.concat(F.lit("http://dbpedia.org/resource/"), "n_name"), "^http://dbpedia.org/resource/", "https://en.wikipedia.org/wiki/")
    return c.select("c_custkey", F.coalesce(F.when(F.col("n_regionkey") == 1, link), F.when(F.col("n_regionkey") == 2, F.concat(F.lit("geo:"), "n_nationkey"))).alias("uri"))


@query("SELECT o_custkey, o_orderpriority AS name, n FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, o_orderpriority) AS r FROM (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders WHERE o_orderstatus IN ('O', 'P') GROUP BY ALL)) WHERE r = 1")
def canonical_by_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").where("o_orderstatus IN ('O', 'P')").withColumnRenamed("o_orderpriority", "name")
    return selection.mode_by(o, ["o_custkey"], "name").select("o_custkey", "name", "n")


@query("SELECT event_id, try_cast(json_extract_string(props, '$.k') AS DOUBLE) AS value FROM events WHERE try_cast(json_extract_string(props, '$.k') AS DOUBLE) IS NOT NULL AND NOT isnan(try_cast(json_extract_string(props, '$.k') AS DOUBLE))")
def structured_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reported values that are numbers."""
    v = F.get_json_object("props", "$.k").try_cast("double")
    return table(spark, sf_dir, "events").select("event_id", v.alias("value")).where(F.col("value").isNotNull() & ~F.isnan("value"))


@query("""
    SELECT o_custkey, o_orderpriority AS kind, conf FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY conf DESC, o_orderpriority) AS r FROM (SELECT o_custkey, o_orderpriority, round(max(o_totalprice), 2) AS conf FROM orders GROUP BY ALL)) WHERE r = 1
""")
def best_entity_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").groupBy("o_custkey", F.col("o_orderpriority").alias("kind")).agg(F.round(F.max("o_totalprice"), 2).alias("conf"))
    return selection.first_by(o, ["o_custkey"], [F.col("conf").desc(), "kind"]).select("o_custkey", "kind", "conf")


@query("SELECT (sum(n * (n - 1)) / 2)::BIGINT AS intra, (sum(sum_n) - sum(n * (n - 1)) / 2)::BIGINT AS inter FROM (SELECT n, CASE WHEN r = 1 THEN t * (t - 1) / 2 ELSE 0 END AS sum_n FROM (SELECT n, sum(n) OVER () AS t, row_number() OVER (ORDER BY label) AS r FROM (SELECT label, count(*) AS n FROM embeddings GROUP BY 1)))")
def pair_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of pairs within and across clusters."""
    return learning.pair_classes(table(spark, sf_dir, "embeddings"), "label")


@query("""
    WITH h AS (SELECT vec_id AS a, label AS g, (vec_id * 2654435761) % 4294967291 AS h FROM embeddings),
    p AS (SELECT a, g, unnest([lead(a, 1) OVER w, lead(a, 2) OVER w, lead(a, 3) OVER w, lead(a, 4) OVER w, lead(a, 5) OVER w]) AS b,
      unnest([lead(g, 1) OVER w, lead(g, 2) OVER w, lead(g, 3) OVER w, lead(g, 4) OVER w, lead(g, 5) OVER w]) AS gb FROM h WINDOW w AS (PARTITION BY h % 64 ORDER BY h, a))
    SELECT a, b, g = gb AS same FROM p WHERE b IS NOT NULL
""")
def sampled_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs for metric learning, five for each item."""
    return learning.sampled_pairs(table(spark, sf_dir, "embeddings"), "vec_id", "label", 5, key=(F.col("vec_id") * 2654435761) % 4294967291)


@query("SELECT index, p_type AS name FROM (SELECT p_type, row_number() OVER (ORDER BY p_type) AS index FROM (SELECT DISTINCT p_type FROM part))")
def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return learning.feature_table(table(spark, sf_dir, "part").select(F.col("p_type").alias("name")), "name").select("index", "name")


@query("""
    SELECT feature, count(*) AS n FROM (
      SELECT concat('role[0]=', role) AS feature FROM conversations UNION ALL
      SELECT concat('role[-1]|role[0]=', p, '|', role) FROM (SELECT role, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS p FROM conversations) WHERE p IS NOT NULL) GROUP BY 1
""")
def feature_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = learning.templates(table(spark, sf_dir, "conversations"), "conv_id", "turn", {"role": F.col("role")}, [(("role", 0),), (("role", -1), ("role", 0))])
    return f.groupBy("feature").agg(F.count("*").alias("n"))


@query("""
    WITH RECURSIVE x AS (SELECT s_suppkey + 1 AS n FROM supplier), t AS (SELECT n, n // 2 AS p FROM x WHERE n > 1),
    c AS (SELECT n AS child, n AS ancestor, 0 AS d FROM x UNION ALL SELECT child, p, d + 1 FROM c JOIN t ON c.ancestor = t.n),
    h AS (SELECT n, (floor(log2(n)) + 1)::BIGINT AS depth FROM x)
    SELECT a.child AS a, b.child AS b, round(max(2.0 * depth / (a.d + b.d + 2 * depth)), 6) AS similarity FROM c a JOIN c b ON a.ancestor = b.ancestor AND b.child = a.child + 5 JOIN h ON h.n = a.ancestor GROUP BY ALL
""")
def wu_palmer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similarity in a class tree by the deepest common ancestor."""
    from factloom.operators import graph

    n = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") + 1).alias("id"))
    edges = n.where("id > 1").selectExpr("id AS n", "id div 2 AS p")
    levels = (n.agg(F.max("id")).first()[0] or 1).bit_length()
    own = n.select(F.col("id").alias("child"), F.col("id").alias("ancestor"), F.lit(0).alias("distance"))
    closed = graph.closure(edges, "n", "p", levels).union(own)
    depth = n.select(F.col("id").alias("node"), (F.floor(F.log2("id")) + 1).alias("depth"))
    pairs = n.select(F.col("id").alias("a"), (F.col("id") + 5).alias("b")).join(n.select(F.col("id").alias("b")), "b", "left_semi")
    return learning.wu_palmer_pairs(pairs, closed, depth, "a", "b").select("a", "b", F.round("similarity", 6).alias("similarity"))


@query("SELECT t AS word, count(*) AS n FROM (SELECT unnest(string_split_regex(lower(text), '[^a-z0-9]+')) AS t FROM documents) WHERE len(regexp_extract_all(t, '[a-z]')) >= 3 GROUP BY 1 HAVING count(*) >= 20")
def vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that are frequent and have three letters at least."""
    t = table(spark, sf_dir, "documents").select(F.explode(X.tokens(F.col("text"))).alias("word")).where(F.regexp_count("word", F.lit("[a-z]")) >= 3)
    return t.groupBy("word").agg(F.count("*").alias("n")).where("n >= 20")


@query("""
    SELECT event_id, CASE event_type WHEN 'purchase' THEN 'Transaction' WHEN 'click' THEN 'Contact' ELSE 'Failure' END AS kind, CASE WHEN event_type = 'error' THEN 'nn' ELSE 'kbp' END AS model,
      CASE WHEN event_type <> 'error' AND value > 50 THEN 'has_actor' WHEN event_type = 'error' AND value <= 50 THEN 'has_theme' END AS role FROM events WHERE event_type IN ('purchase', 'click', 'error')
""")
def type_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types and roles of two models in terms of one ontology; unknown types go."""
    types = spark.createDataFrame([("kbp", "purchase", "Transaction"), ("kbp", "click", "Contact"), ("nn", "click", "Other"), ("nn", "error", "Failure")], "model string, source string, target string")
    roles = spark.createDataFrame([("kbp", "big", "has_actor"), ("nn", "small", "has_theme")], "model string, source string, target string")
    e = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("kind"), F.when(F.col("value") > 50, "big").otherwise("small").alias("role"))
    return M.convert(e, "kind", "role", types, roles).select("event_id", "kind", "model", "role")


@query("SELECT row_number() OVER (ORDER BY o_orderstatus, o_totalprice DESC, o_orderkey) - 1 AS n, concat(o_orderkey, chr(9), o_orderstatus, chr(9), CASE WHEN o_orderpriority = '1-URGENT' THEN '' ELSE o_orderpriority END) AS line FROM orders")
def mention_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tab-separated lines in the order of relation and falling score."""
    o = table(spark, sf_dir, "orders").withColumn("p", F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderpriority")))
    o = o.withColumn("minus", -F.col("o_totalprice"))
    return M.dump(o, ["o_orderkey", "o_orderstatus", "p"], ["o_orderstatus", "minus", "o_orderkey"])


@query("SELECT code, count(*) AS n, count(DISTINCT user_id) AS n_actors FROM (SELECT user_id, substr(event_type, 1, 1) AS code FROM events) GROUP BY 1")
def event_code_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of top-level codes."""
    e = table(spark, sf_dir, "events").select("user_id", F.substring("event_type", 1, 1).alias("code"))
    return e.groupBy("code").agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("n_actors"))


@query("SELECT event_id FROM (SELECT event_id, row_number() OVER (ORDER BY (event_id * 2654435761) % 1000003, event_id) AS r FROM events) WHERE r <= 100")
def downsample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample of a stated size: the rows that come first in the order of an arithmetic hash."""
    e = table(spark, sf_dir, "events").select("event_id")
    return e.orderBy((F.col("event_id") * 2654435761) % 1000003, "event_id").limit(100)
