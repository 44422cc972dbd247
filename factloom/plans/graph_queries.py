"""Graph patterns over the star schema as triples, and actor aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from factloom.functions import scores
from factloom.operators import graph as G, selection
from factloom.plans.registry import query
from factloom.sources.tables import table

#: Table, kind of its rows, key, and its predicates as SQL expressions.
STAR = {
    "region": ("region", "r_regionkey", {"name": "r_name"}),
    "nation": ("nation", "n_nationkey", {"name": "n_name", "part_of": "concat('region/', n_regionkey)"}),
    "customer": ("customer", "c_custkey", {"name": "c_name", "located_in": "concat('nation/', c_nationkey)", "sector": "c_mktsegment"}),
    "supplier": ("supplier", "s_suppkey", {"name": "s_name", "located_in": "concat('nation/', s_nationkey)"}),
    "orders": ("order", "o_orderkey", {"actor": "concat('customer/', o_custkey)", "status": "o_orderstatus", "priority": "o_orderpriority"}),
}


def triples(spark: SparkSession, sf_dir: str, *tables: str) -> DataFrame:
    out = None
    for t in tables:
        kind, key, columns = STAR[t]
        part = G.star_triples(table(spark, sf_dir, t), kind, key, columns)
        out = part if out is None else out.union(part)
    return out


@query("""
    SELECT concat('order/', o_orderkey) AS e, n_name AS country, CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END AS priority
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE regexp_matches(n_name, '[05]$') AND o_orderstatus IN ('P', 'F')
""")
def graph_events_of_actors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type pattern, filter by regular expression, VALUES list, OPTIONAL."""
    t = triples(spark, sf_dir, "orders", "customer", "nation")
    s = G.bgp(t, ("?e", "actor", "?a"), ("?a", "located_in", "?n"), ("?n", "name", "?country"), ("?e", "status", "?st"))
    s = G.values(s.where(F.col("country").rlike("[05]$")), "st", ["P", "F"])
    p = G.bgp(t, ("?e", "status", "P"), ("?e", "priority", "?priority"))
    return G.optional(s, p).select("e", "country", "priority")


@query("SELECT DISTINCT n_name AS country, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey WHERE starts_with(n_name, 'NATION_1') OR starts_with(r_name, 'A')")
def graph_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = triples(spark, sf_dir, "nation", "region")
    s = G.bgp(t, ("?n", "type", "nation"), ("?n", "part_of", "?r"), ("?n", "name", "?country"), ("?r", "name", "?region"))
    return s.where(F.col("country").startswith("NATION_1") | F.col("region").startswith("A")).select("country", "region").distinct()


@query("""
    SELECT a, 'customer' AS kind, n_name AS country FROM (SELECT concat('customer/', c_custkey) AS a, c_nationkey AS k FROM customer WHERE c_mktsegment = 'BUILDING') JOIN nation ON k = n_nationkey
    UNION ALL SELECT concat('supplier/', s_suppkey), 'supplier', n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey
""")
def graph_union_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = triples(spark, sf_dir, "customer", "supplier", "nation")
    at = G.bgp(t, ("?a", "located_in", "?n"), ("?n", "name", "?country"))
    c = G.join(G.bgp(t, ("?a", "sector", "BUILDING")), at).withColumn("kind", F.lit("customer"))
    s = G.join(G.bgp(t, ("?a", "type", "supplier")), at).withColumn("kind", F.lit("supplier"))
    return G.union(c, s).select("a", "kind", "country")


@query("SELECT concat('customer/', c_custkey) AS a FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def graph_minus(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = triples(spark, sf_dir, "customer", "orders")
    return G.minus(G.pattern(t, "?a", "type", "customer"), G.bgp(t, ("?e", "actor", "?a"), ("?e", "status", "P")).select("a").distinct())


@query("""
    SELECT concat('customer/', c_custkey) AS a, concat('supplier/', s_suppkey) AS b FROM customer JOIN supplier ON c_nationkey = s_nationkey WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')
""")
def graph_partners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two actors tied by one place, NOT IN on a literal."""
    t = triples(spark, sf_dir, "customer", "supplier")
    a = G.bgp(t, ("?a", "type", "customer"), ("?a", "located_in", "?n"), ("?a", "sector", "?sec")).where(~F.col("sec").isin("BUILDING", "MACHINERY"))
    return G.join(a, G.bgp(t, ("?b", "type", "supplier"), ("?b", "located_in", "?n"))).select("a", "b")


_NEXT = "WITH n AS (SELECT o_custkey, o_orderkey, lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS nx FROM orders)"


@query(_NEXT + " SELECT a.o_orderkey AS e0, b.o_orderkey AS e1, c.o_orderkey AS e2, c.nx AS e3 FROM n a LEFT JOIN n b ON a.nx = b.o_orderkey LEFT JOIN n c ON b.nx = c.o_orderkey")
def graph_causal_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A chain of three steps by nested OPTIONALs."""
    from pyspark.sql import Window as W

    w = W.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    n = table(spark, sf_dir, "orders").select("o_orderkey", F.lead("o_orderkey").over(w).alias("nx")).where("nx IS NOT NULL")
    t = n.select(F.col("o_orderkey").alias("s"), F.lit("causes").alias("p"), F.col("nx").alias("o"))
    out = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("e0"))
    for k in range(3):
        out = G.optional(out, G.pattern(t, f"?e{k}", "causes", f"?e{k + 1}"))
    return out.select("e0", "e1", "e2", "e3")


@query("""
    WITH RECURSIVE x AS (SELECT c_custkey AS n, c_custkey // 2 AS p FROM customer WHERE c_custkey > 1),
    c AS (SELECT n AS child, p AS ancestor, 1 AS distance FROM x UNION ALL SELECT child, p, distance + 1 FROM c JOIN x ON c.ancestor = x.n WHERE distance < 8)
    SELECT child, ancestor, min(distance)::INTEGER AS distance FROM c GROUP BY ALL
""")
def superclass_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transitive closure of a tree to a bounded depth: a customer's parent has half its key."""
    e = table(spark, sf_dir, "customer").where("c_custkey > 1").selectExpr("c_custkey AS n", "c_custkey div 2 AS p")
    return G.closure(e, "n", "p", 8)


@query("""
    WITH f AS (SELECT DISTINCT o_custkey AS a, l_suppkey AS b FROM orders JOIN lineitem ON l_orderkey = o_orderkey), w AS (SELECT l_suppkey AS b, count(*) AS importance FROM lineitem GROUP BY 1)
    SELECT a, b, importance, rank FROM (SELECT a, b, importance, row_number() OVER (PARTITION BY a ORDER BY importance DESC, b)::INTEGER AS rank FROM f JOIN w USING (b)) WHERE rank <= 10
""")
def actor_related_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most important related actors of each actor."""
    l = table(spark, sf_dir, "lineitem")
    f = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("a"), "o_orderkey").join(l.select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_suppkey").alias("b")), "o_orderkey").select("a", "b").distinct()
    w = l.groupBy(F.col("l_suppkey").alias("b")).agg(F.count("*").alias("importance"))
    return selection.top_by(f.join(w, "b"), ["a"], [F.col("importance").desc(), "b"], 10).select("a", "b", "importance", "rank")


@query("""
    WITH k AS (SELECT l_partkey AS a, l_suppkey AS b, count(*) AS n FROM lineitem GROUP BY ALL), d AS (SELECT p_partkey AS a, (p_partkey % 7 + 1)::BIGINT AS b FROM part WHERE p_size = 1)
    SELECT a, b, 1.0::DOUBLE AS score FROM d UNION ALL
    SELECT a, b, greatest(0.95 * least(n / 40, 1), 0.5)::DOUBLE FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY n DESC, b) AS r FROM k WHERE n > 1 AND a NOT IN (SELECT a FROM d)) WHERE r = 1
""")
def actor_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relations of a data base score one; of the others the first of each actor, scored by its count."""
    d = table(spark, sf_dir, "part").where("p_size = 1").select(F.col("p_partkey").alias("a"), (F.col("p_partkey") % 7 + 1).cast("long").alias("b"))
    k = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("a"), F.col("l_suppkey").alias("b")).agg(F.count("*").alias("n")).where("n > 1").join(d.select("a"), "a", "left_anti")
    best = selection.first_by(k, ["a"], [F.col("n").desc(), "b"])
    return d.withColumn("score", F.lit(1.0)).unionByName(best.select("a", "b", scores.actor_score(F.col("n")).alias("score")))


@query("SELECT a, b, sum(n)::BIGINT AS n FROM (SELECT o_custkey AS a, o_orderpriority AS b, count(*) AS n FROM orders GROUP BY ALL UNION ALL SELECT c_custkey, c_mktsegment, 1 FROM customer) GROUP BY ALL")
def sum_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("a"), F.col("o_orderpriority").alias("b")).agg(F.count("*").alias("n"))
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("a"), F.col("c_mktsegment").alias("b"), F.lit(1).cast("long").alias("n"))
    return o.unionByName(c).groupBy("a", "b").agg(F.sum("n").alias("n"))


@query("""
    SELECT s_suppkey AS a FROM supplier WHERE s_acctbal > 0 INTERSECT (SELECT l_suppkey FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size > 45 UNION SELECT s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey = 1)
""")
def actor_affiliations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actors of a sector among those tied by facts or by links."""
    s = table(spark, sf_dir, "supplier")
    facts = table(spark, sf_dir, "lineitem").select("l_suppkey", F.col("l_partkey").alias("p_partkey")).join(table(spark, sf_dir, "part").where("p_size > 45").select("p_partkey"), "p_partkey", "left_semi").select(F.col("l_suppkey").alias("a"))
    links = s.join(table(spark, sf_dir, "nation").where("n_regionkey = 1").select(F.col("n_nationkey").alias("s_nationkey")), "s_nationkey", "left_semi").select(F.col("s_suppkey").alias("a"))
    return s.where("s_acctbal > 0").select(F.col("s_suppkey").alias("a")).intersect(facts.union(links))


@query("""
    SELECT p_brand AS arg, p_partkey AS place FROM (SELECT p_brand, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS r FROM part WHERE p_brand IN (SELECT p_brand FROM part GROUP BY 1 HAVING count(*) >= 10)) WHERE r = 1
""")
def geoname_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each frequent argument string the place of that name with the most inhabitants."""
    p = table(spark, sf_dir, "part")
    often = p.groupBy("p_brand").agg(F.count("*").alias("n")).where("n >= 10").select("p_brand")
    best = selection.first_by(p.join(often, "p_brand", "left_semi"), ["p_brand"], [F.col("p_retailprice").desc(), "p_partkey"])
    return best.select(F.col("p_brand").alias("arg"), F.col("p_partkey").alias("place"))
