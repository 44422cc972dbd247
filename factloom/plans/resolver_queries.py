"""Knowledge-base resolvers and consolidation on the driver's tables: events, orders and line items stand for mentions and relations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from factloom.functions import scores, text as X
from factloom.operators import consolidation, graph, resolvers as R, selection
from factloom.plans.registry import query
from factloom.sources.tables import table


@query("""
    SELECT doc_id, n_words, CASE WHEN n_words > 1 AND len(list_filter(w, lambda x: x IN ('no', 'not', 'never', 'without', 'none', 'nor', 'cannot', 'lack'))) > 0
      AND NOT regexp_matches(lower(source), 'shortage|insecurity') THEN 'Negative' ELSE 'Positive' END AS polarity
    FROM (SELECT doc_id, source, string_split(lower(text), ' ') AS w, len(string_split(lower(text), ' '))::BIGINT AS n_words FROM documents)
""")
def polarity_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.size(F.split("text", " ")).cast("long").alias("n_words"), R.event_polarity(F.col("text"), F.col("source")).alias("polarity"))


@query("""
    WITH good AS (SELECT user_id FROM events GROUP BY user_id HAVING bool_or(NOT (event_type IN ('error', 'view') AND value < 60)))
    SELECT event_id, user_id, event_type FROM events WHERE user_id IN (SELECT user_id FROM good) AND NOT (event_type = 'error' AND value < 10)
""")
def precision_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events go if all their mentions are on a blacklist; then single bad mentions go."""
    e = table(spark, sf_dir, "events")
    bad = F.col("event_type").isin("error", "view") & (F.col("value") < 60)
    return R.keep_events_with_good_mention(e, "user_id", bad).where(~((F.col("event_type") == "error") & (F.col("value") < 10))).select("event_id", "user_id", "event_type")


@query("""
    SELECT o_custkey, rule FROM (
      SELECT o_custkey, rule, count(DISTINCT (o_orderstatus, o_orderpriority)) AS m, n FROM (SELECT DISTINCT o_custkey, o_orderstatus, o_orderpriority FROM orders)
      JOIN (SELECT 'r1' AS rule, 'F' AS s, '1-URGENT' AS p, 2 AS n UNION ALL SELECT 'r1', 'O', '2-HIGH', 2 UNION ALL SELECT 'r2', 'P', '1-URGENT', 1) ON o_orderstatus = s AND o_orderpriority = p
      GROUP BY o_custkey, rule, n) WHERE m = n
""")
def relational_division(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers whose orders have every (status, priority) pair of a rule."""
    rules = spark.createDataFrame([("r1", "F", "1-URGENT"), ("r1", "O", "2-HIGH"), ("r2", "P", "1-URGENT")], "rule string, o_orderstatus string, o_orderpriority string")
    return selection.divide(table(spark, sf_dir, "orders"), ["o_custkey"], rules, "rule", ["o_orderstatus", "o_orderpriority"])


_PAIRS = "SELECT DISTINCT s_suppkey, c_custkey, s_nationkey, c_nationkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey JOIN customer ON o_custkey = c_custkey"


def _supplier_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_suppkey").alias("s_suppkey"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    pairs = l.join(o, "o_orderkey").select("s_suppkey", "c_custkey").distinct()
    return pairs.join(table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey"), "s_suppkey").join(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), "c_custkey")


@query(f"SELECT s_suppkey, c_custkey FROM ({_PAIRS}) WHERE s_suppkey <> c_custkey AND s_nationkey <> c_nationkey")
def bad_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relations without those between equal ends or ends of one country."""
    return R.good_entity_relations(_supplier_customer(spark, sf_dir), "s_suppkey", "c_custkey", "s_nationkey", "c_nationkey").select("s_suppkey", "c_custkey")


_RELATIONS = """
    WITH r AS (SELECT event_id, user_id AS l, (event_id % 97)::BIGINT AS r, CASE event_type WHEN 'purchase' THEN 'Cause-Effect' WHEN 'view' THEN 'Catalyst-Effect'
      WHEN 'error' THEN 'Preventative-Effect' WHEN 'click' THEN 'Before-After' ELSE 'Other' END AS kind, value FROM events)
"""


def _relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("event_type")
    kind = F.when(t == "purchase", "Cause-Effect").when(t == "view", "Catalyst-Effect").when(t == "error", "Preventative-Effect").when(t == "click", "Before-After").otherwise("Other")
    return table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("l"), (F.col("event_id") % 97).alias("r"), kind.alias("kind"), "value")


@query(_RELATIONS + """
    SELECT l, kind, r, event_id FROM (SELECT *, row_number() OVER (PARTITION BY l, kind, r ORDER BY event_id) AS n FROM (
      SELECT l, r, event_id, CASE kind WHEN 'Cause-Effect' THEN 'cause' WHEN 'Catalyst-Effect' THEN 'cause' WHEN 'Preventative-Effect' THEN 'mitigate' WHEN 'Before-After' THEN 'before' ELSE kind END AS kind FROM r)) WHERE n = 1
""")
def relation_rename_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.rename_relations(_relations(spark, sf_dir), "l", "kind", "r", ["event_id"]).select("l", "kind", "r", "event_id")


@query("""
    SELECT l_partkey, l_suppkey, n, CASE WHEN n >= 10 THEN 0.7 WHEN n >= 5 THEN 0.5 WHEN n >= 2 THEN 0.3 WHEN n >= 1 THEN 0.2 ELSE 0.1 END::DOUBLE AS confidence
    FROM (SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY ALL)
""")
def confidence_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.count("*").alias("n"))
    return n.withColumn("confidence", scores.tier(F.col("n")))


@query(_RELATIONS + """
    , c AS (SELECT l, kind, r, count(*) AS n FROM r GROUP BY ALL)
    SELECT event_id, n AS triple_count, round(CASE WHEN value > 100 THEN 0.75 ELSE CASE WHEN n >= 10 THEN 0.7 WHEN n >= 5 THEN 0.5 WHEN n >= 2 THEN 0.3 ELSE 0.2 END END, 6)::DOUBLE AS confidence
    FROM r JOIN c USING (l, kind, r)
""")
def relation_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _relations(spark, sf_dir).withColumn("extracted", F.when(F.col("value") > 100, 0.75)).withColumn("l", F.col("l").cast("string")).withColumn("r", F.col("r").cast("string"))
    return R.relation_confidence(r, "l", "kind", "r", "extracted").select("event_id", "triple_count", "confidence")


@query("SELECT o_custkey, o_orderpriority, n FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, o_orderpriority) AS r FROM (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL)) WHERE r = 1")
def majority_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.mode_by(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderpriority").select("o_custkey", "o_orderpriority", "n")


@query("""
    SELECT o_custkey, kind, n FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, kind = 'ORG' DESC, ends_with(kind, '.General') DESC, kind) AS r
      FROM (SELECT o_custkey, kind, count(*) AS n FROM (SELECT o_custkey, CASE o_orderstatus WHEN 'F' THEN 'ORG' WHEN 'O' THEN 'PER.General' ELSE 'GPE' END AS kind FROM orders) GROUP BY ALL)) WHERE r = 1
""")
def group_entity_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("o_orderstatus") == "F", "ORG").when(F.col("o_orderstatus") == "O", "PER.General").otherwise("GPE")
    return R.group_type(table(spark, sf_dir, "orders").select("o_custkey", kind.alias("kind")), "o_custkey", "kind").select("o_custkey", "kind", "n")


@query("""
    SELECT l_partkey, n_name, n FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY n DESC, n_name) AS r FROM (
      SELECT l_partkey, n_name, count(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL)) WHERE r = 1
""")
def citizenship_majority(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem").select("l_partkey", F.col("l_suppkey").alias("s_suppkey")).join(table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("n_nationkey")), "s_suppkey")
    return selection.mode_by(l.join(table(spark, sf_dir, "nation"), "n_nationkey"), ["l_partkey"], "n_name").select("l_partkey", "n_name", "n")


@query("""
    SELECT p_partkey, coalesce(CASE WHEN p_brand = 'Brand#11' AND p_size > 25 THEN 'big-eleven' END, CASE WHEN p_size > 40 THEN 'big' END, CASE WHEN p_brand = 'Brand#11' THEN 'eleven' END, p_type) AS new_type FROM part
""")
def type_change_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, brand, size = table(spark, sf_dir, "part"), F.col("p_brand") == "Brand#11", F.col("p_size")
    return p.select("p_partkey", R.priority_types(F.when(brand & (size > 25), "big-eleven"), F.lit(None).cast("string"), F.when(size > 40, "big"), F.when(brand, "eleven"), F.col("p_type")).alias("new_type"))


@query(_RELATIONS + """
    , f AS (SELECT r, CASE WHEN kind = 'Preventative-Effect' THEN -s WHEN kind = 'Catalyst-Effect' THEN greatest(abs(s), 1) * CASE WHEN s < 0 THEN -1 ELSE 1 END ELSE s END AS trend
      FROM (SELECT *, CASE WHEN value < 20 THEN -1 WHEN value > 80 THEN 1 ELSE 0 END AS s FROM r))
    SELECT r, trend, n FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY n DESC, trend) AS k FROM (SELECT r, trend::INTEGER AS trend, count(*) AS n FROM f GROUP BY ALL)) WHERE k = 1
""")
def trend_flip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trends of effects under their relations, and the majority for each effect."""
    sign = F.when(F.col("value") < 20, -1).when(F.col("value") > 80, 1).otherwise(0)
    return selection.mode_by(_relations(spark, sf_dir).withColumn("trend", R.flip_trend(sign, F.col("kind")).cast("int")), ["r"], "trend").select("r", "trend", "n")


@query("""
    SELECT l_orderkey, l_linenumber FROM (SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY l_quantity DESC, l_extendedprice DESC, l_linenumber) AS r FROM lineitem) WHERE r = 1
""")
def redundant_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem")
    return selection.undominated(l, ["l_orderkey", "l_returnflag"], [F.col("l_quantity").desc(), F.col("l_extendedprice").desc(), "l_linenumber"]).select("l_orderkey", "l_linenumber")


@query("""
    WITH e AS (SELECT DISTINCT concat('s', l_suppkey) AS a, concat('o', l_orderkey) AS b FROM lineitem WHERE l_quantity > 49), b AS (SELECT a AS x, b AS y FROM e UNION SELECT b, a FROM e),
    one AS (SELECT y AS node FROM b WHERE x = 's1'), two AS (SELECT y AS node FROM b WHERE x IN (SELECT node FROM one))
    SELECT node, min(h)::INTEGER AS hops FROM (SELECT 's1' AS node, 0 AS h UNION ALL SELECT node, 1 FROM one UNION ALL SELECT node, 2 FROM two) GROUP BY node
""")
def two_hop_reachability(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "lineitem").where("l_quantity > 49").select(F.concat(F.lit("s"), "l_suppkey").alias("a"), F.concat(F.lit("o"), "l_orderkey").alias("b")).distinct()
    return graph.two_hops(spark.createDataFrame([("s1",)], "node string"), e, "a", "b")


@query("""
    SELECT o_orderkey, coalesce(CASE WHEN o_totalprice > 150000 THEN n_name END, CASE WHEN c_acctbal > 0 THEN c_mktsegment END, o_orderpriority) AS place,
      CASE WHEN o_totalprice > 150000 THEN 'argument' WHEN c_acctbal > 0 THEN 'sentence' ELSE 'document' END AS method
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
""")
def event_location_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey").join(table(spark, sf_dir, "customer"), "c_custkey").withColumnRenamed("c_nationkey", "n_nationkey").join(table(spark, sf_dir, "nation"), "n_nationkey")
    place, method = R.first_known((F.when(F.col("o_totalprice") > 150000, F.col("n_name")), "argument"), (F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")), "sentence"), (F.col("o_orderpriority"), "document"))
    return o.select("o_orderkey", place.alias("place"), method.alias("method"))


@query("SELECT lower(p_name) AS group_key, count(*) AS n, min(p_partkey) AS first_member FROM part GROUP BY 1")
def unify_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.unify(table(spark, sf_dir, "part"), F.col("p_name"), "p_partkey")


@query("""
    WITH p AS (SELECT DISTINCT p_brand, CASE p_partkey % 3 WHEN 0 THEN split_part(p_type, ' ', 1) WHEN 1 THEN concat(split_part(p_type, ' ', 1), '/', split_part(p_type, ' ', 2)) ELSE replace(p_type, ' ', '/') END AS path FROM part)
    SELECT p_brand, path FROM p a WHERE NOT EXISTS (SELECT 1 FROM p b WHERE b.p_brand = a.p_brand AND starts_with(b.path, a.path || '/'))
""")
def hierarchy_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the types on one path the most specific."""
    words = F.split("p_type", " ")
    path = F.when(F.col("p_partkey") % 3 == 0, words[0]).when((F.col("p_partkey") % 3 == 1), F.array_join(F.slice(F.concat(words, F.array(F.lit(""))), 1, 2), "/")).otherwise(F.array_join(words, "/"))
    return R.prune_paths(table(spark, sf_dir, "part").select("p_brand", path.alias("path")).distinct(), ["p_brand"], "path")


@query("""
    SELECT user_id, minute, event_id, n, types FROM (SELECT user_id, date_trunc('minute', ts) AS minute, count(*) AS n,
      arg_min(event_id, (event_type = 'view', event_id)) AS event_id, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS types FROM events GROUP BY 1, 2)
""")
def anchor_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mentions on one anchor become one: the first that is not generic is its master, types are joined."""
    e = table(spark, sf_dir, "events").withColumn("minute", F.date_trunc("minute", F.col("ts").cast("timestamp")).cast("timestamp_ntz"))
    out = consolidation.merge_anchor(e, ["user_id", "minute"], F.col("event_type") == "view", "event_id", "event_type")
    return out.select("user_id", "minute", "event_id", "n", F.array_join("types", ",").alias("types"))


@query("""
    WITH a AS (SELECT user_id, event_type, list(DISTINCT day(ts)) AS days FROM events GROUP BY ALL)
    SELECT x.user_id, x.event_type AS small, y.event_type AS large FROM a x JOIN a y ON x.user_id = y.user_id AND len(y.days) > len(x.days) AND list_has_all(y.days, x.days)
""")
def covering_arguments(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.collect_set(F.dayofmonth("ts")).alias("days"))
    return R.covering(a, ["user_id"], "event_type", "days")


@query("""
    SELECT conv_id, turn, role, array_to_string(list_sort(list_distinct(list(r) OVER (PARTITION BY conv_id ORDER BY turn RANGE BETWEEN 2 PRECEDING AND CURRENT ROW))), ',') AS heard
    FROM (SELECT conv_id, turn, role, concat(role, '-', length(text) % 3) AS r FROM conversations)
""")
def neighbour_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arguments of the two turns before are taken over."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.concat("role", F.lit("-"), (F.length("text") % 3).cast("string")).alias("r"))
    return consolidation.propagate(c, "conv_id", "turn", "r", 2, "heard").select("conv_id", "turn", "role", F.array_join("heard", ",").alias("heard"))


@query("""
    SELECT event_id, array_to_string(list_sort(list_transform(list_filter(t, lambda x: x <> 'view' OR len(t) = 1), lambda x: x)), ',') AS types FROM (
      SELECT min(event_id) AS event_id, list(DISTINCT event_type) AS t FROM events GROUP BY user_id, date_trunc('hour', ts))
""")
def aggregate_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types of merged mentions; the generic one goes if there is any other."""
    e = table(spark, sf_dir, "events").groupBy("user_id", F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("h")).agg(F.min("event_id").alias("event_id"), F.collect_set("event_type").alias("t"))
    return e.select("event_id", F.array_join(F.array_sort(consolidation.drop_generic(F.col("t"), "view")), ",").alias("types"))


@query("""
    SELECT l_orderkey, l_returnflag, l_linestatus, l_linenumber, round(c, 6) AS confidence FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_returnflag, l_linestatus ORDER BY floor(c * 1000) DESC, l_linenumber) AS r
      FROM (SELECT *, 1 - l_discount AS c FROM lineitem)) WHERE r = 1
""")
def eer_dedupe_conf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of relations of one (left, right, type) that of the highest confidence, compared to a thousandth."""
    l = table(spark, sf_dir, "lineitem").withColumn("c", 1 - F.col("l_discount"))
    best = selection.first_by(l, ["l_orderkey", "l_returnflag", "l_linestatus"], [F.floor(F.col("c") * 1000).desc(), "l_linenumber"])
    return best.select("l_orderkey", "l_returnflag", "l_linestatus", "l_linenumber", F.round("c", 6).alias("confidence"))


@query("SELECT event_id, round(CASE WHEN value > 80 THEN 1.0 WHEN value < 20 THEN 0.25 ELSE 0.5 END * CASE WHEN event_type = 'error' THEN -1 ELSE 1 END, 6)::DOUBLE AS magnitude FROM events")
def magnitude_flip(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select("event_id", consolidation.magnitude(F.when(F.col("value") > 80, "High").when(F.col("value") < 20, "Low"), F.col("event_type") == "error").alias("magnitude"))


@query("""
    SELECT doc_id, round(w, 6) AS weight FROM (SELECT doc_id, CASE WHEN list_contains(t, 'the') THEN 0.5 ELSE 1 END * CASE WHEN list_contains(t, 'was') THEN 0.8 ELSE 1 END * CASE WHEN list_contains(t, 'idiot') THEN 0.1 ELSE 1 END::DOUBLE AS w
      FROM (SELECT doc_id, string_split_regex(lower(text), '[^a-z0-9]+') AS t FROM documents))
""")
def keyword_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.round(consolidation.keyword_weight(X.tokens(F.col("text")), {"the": 0.5, "was": 0.8, "idiot": 0.1}), 6).alias("weight"))


@query("""
    SELECT event_id, value * CASE event_type WHEN 'purchase' THEN 1.0 WHEN 'click' THEN 0.75 ELSE 0.5 END::DOUBLE * CASE WHEN user_id % 2 = 0 THEN 1.0 ELSE 0.75 END::DOUBLE AS score FROM events
""")
def calibrate_args(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "purchase", "name").when(F.col("event_type") == "click", "desc").otherwise("other")
    # Unrounded: products of a double and quarters are the same doubles in any engine, rounded ones differ at ties.
    return table(spark, sf_dir, "events").select("event_id", scores.argument_score(F.col("value"), kind, F.col("user_id") % 2 == 0).alias("score"))


@query("SELECT event_id, nearest_id, gap FROM (SELECT a.event_id, b.event_id AS nearest_id, abs(floor(epoch(a.ts))::BIGINT - floor(epoch(b.ts))::BIGINT) AS gap, row_number() OVER (PARTITION BY a.event_id ORDER BY abs(floor(epoch(a.ts))::BIGINT - floor(epoch(b.ts))::BIGINT), b.event_id) AS r FROM events a JOIN events b ON a.user_id = b.user_id AND a.event_type = 'purchase' AND b.event_type = 'view' WHERE abs(floor(epoch(a.ts))::BIGINT - floor(epoch(b.ts))::BIGINT) <= 3600) WHERE r = 1")
def nearest_argument(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest candidate within a distance, joined by buckets of that distance."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.unix_seconds(F.col("ts").cast("timestamp")).alias("t"))
    out = consolidation.nearest_in_time(e.where("event_type = 'purchase'"), e.where("event_type = 'view'"), "user_id", "event_id", "t", 3600)
    return out.select("event_id", "nearest_id", "gap")


@query("SELECT o_custkey, n, o_orderkey FROM (SELECT o_custkey, count(*) AS n, min(o_orderkey) AS o_orderkey FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) WHERE n = 1")
def single_time_argument(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Owners with exactly one candidate."""
    return table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").groupBy("o_custkey").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("o_orderkey")).where("n = 1")


@query("SELECT role, kind, n, ok FROM (SELECT event_type AS role, CASE WHEN value > 50 THEN 'big' ELSE 'small' END AS kind, count(*) AS n FROM events GROUP BY ALL) JOIN (SELECT event_type AS role, event_type IN ('purchase', 'click') AS bounded FROM events GROUP BY ALL) USING (role), LATERAL (SELECT NOT bounded OR kind = 'big' AS ok)")
def constraint_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A role without constraints allows every kind; one with constraints those listed."""
    e = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("role"), F.when(F.col("value") > 50, "big").otherwise("small").alias("kind")).agg(F.count("*").alias("n"))
    rules = spark.createDataFrame([("purchase", "big"), ("click", "big")], "role string, kind string")
    return consolidation.allowed(e, rules, "role", "kind").select("role", "kind", "n", "ok")


@query("SELECT conv_id, (sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END))::BIGINT AS forward, (sum(CASE WHEN role <> 'user' THEN 1 ELSE 0 END))::BIGINT AS reverse FROM conversations GROUP BY 1 HAVING sum(CASE WHEN role <> 'user' THEN 1 ELSE 0 END) <= sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END)")
def reverse_order_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = F.sum((F.col("role") == "user").cast("long")).alias("forward")
    r = F.sum((F.col("role") != "user").cast("long")).alias("reverse")
    return table(spark, sf_dir, "conversations").groupBy("conv_id").agg(f, r).where("reverse <= forward")


@query("SELECT event_id, direction FROM (SELECT min(event_id) AS event_id, min(d) AS direction, count(DISTINCT d) AS n FROM (SELECT *, CASE WHEN value > 80 THEN 'Increase' WHEN value < 20 THEN 'Decrease' END AS d FROM events) GROUP BY user_id, date_trunc('hour', ts)) WHERE n = 1")
def event_direction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose mentions agree on one direction."""
    d = F.when(F.col("value") > 80, "Increase").when(F.col("value") < 20, "Decrease")
    e = table(spark, sf_dir, "events").groupBy("user_id", F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("h")).agg(F.min("event_id").alias("event_id"), F.collect_set(d).alias("ds"))
    return e.where(F.size("ds") == 1).select("event_id", F.col("ds")[0].alias("direction"))


@query()
def event_coreference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sieves over a user's events in order; held against a plain version in the tests."""
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("doc"), (F.col("event_id") / 10).cast("long").alias("sent"), F.col("event_id").alias("mention"), F.col("event_type").alias("kind"), F.get_json_object("props", "$.k").alias("arg"))
    return consolidation.coreference(e, window=5)
