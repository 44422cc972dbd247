"""Concept discovery, retrieval, corpus statistics and batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from factloom.functions import text as X
from factloom.operators import graph as G, grounding, selection, vectors as V
from factloom.plans.graph_queries import triples
from factloom.plans.registry import query
from factloom.sources.tables import table

_E = "WITH e AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings)"


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", V.doubles("embedding").alias("v"))


@query(_E + """ , c AS (SELECT label AS node, list(m ORDER BY d) AS v FROM (SELECT label, d, avg(x) AS m FROM (SELECT label, unnest(v) AS x, unnest(range(1, 65)) AS d FROM e) GROUP BY ALL) GROUP BY label)
    SELECT label, round(avg(best), 5) AS novelty FROM (SELECT e.vec_id, e.label, max(round(list_cosine_similarity(e.v, c.v), 6)) AS best FROM e, c WHERE e.label <> c.node GROUP BY ALL) GROUP BY 1""")
def novelty_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Highest similarity of each member to any node of an ontology (the centroids of the other clusters), averaged by cluster."""
    e = _vectors(spark, sf_dir)
    nodes = V.average(e, ["label"], "v").withColumnRenamed("label", "node")
    near = V.nearest_centroids(e, "vec_id", "v", nodes, "node", 2).withColumnRenamed("item", "vec_id").join(e.select("vec_id", "label"), "vec_id")
    best = near.where("node <> label").groupBy("vec_id", "label").agg(F.max("score").alias("best"))
    return best.groupBy("label").agg(F.round(F.avg("best"), 5).alias("novelty"))


@query(_E + """
    SELECT item, label, score FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, label) AS r FROM (
      SELECT e.vec_id AS item, s.label, round(avg(list_cosine_similarity(e.v, s.v)), 6) AS score FROM e JOIN e s ON s.vec_id <> e.vec_id GROUP BY ALL)) WHERE r = 1
""")
def seed_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seed set (all members of a label) with the highest mean similarity to an item, the item itself left out."""
    best = V.best_seed_set(_vectors(spark, sf_dir), "vec_id", "label", "v")
    return best.select("item", "label", "score")


@query("SELECT doc_id FROM (SELECT doc_id, list_filter(string_split_regex(lower(text), '[^a-z0-9]+'), lambda x: x <> '') AS w FROM documents WHERE lang = 'en') WHERE NOT len(list_filter(w, lambda x: x IN ('the', 'of', 'and'))) > 0.25 * len(w) AND NOT len(list_filter(w, lambda x: length(x) <= 3)) > 0.5 * len(w)")
def example_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Examples without too many listed or short words."""
    d = table(spark, sf_dir, "documents").where("lang = 'en'")
    return d.where(~X.is_bad_example(F.col("text"), ["the", "of", "and"]) & ~X.is_short_worded(F.col("text"), 3, 0.5)).select("doc_id")


@query("SELECT p_brand, p_type FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p_type) AS r FROM (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY ALL)) WHERE r <= 3 EXCEPT SELECT p_brand, p_type FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p_type) AS r FROM (SELECT p_brand, p_type, sum(p_size) AS n FROM part GROUP BY ALL)) WHERE r <= 3")
def top3_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels among the first three of one run and not of the other."""
    p = table(spark, sf_dir, "part").groupBy("p_brand", "p_type").agg(F.count("*").alias("n"), F.sum("p_size").alias("m"))
    top = lambda c: selection.top_by(p, ["p_brand"], [F.col(c).desc(), "p_type"], 3).select("p_brand", "p_type")
    return top("n").exceptAll(top("m"))


@query("SELECT t AS threshold, round(avg(quality) FILTER (n_chars >= t * 500), 6) AS precision, count(*) FILTER (n_chars >= t * 500) AS n FROM (SELECT quality::DOUBLE AS quality, n_chars FROM labels JOIN documents USING (doc_id)), (SELECT unnest(range(0, 8)) AS t) GROUP BY 1")
def threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Precision of what lies above each threshold, from a histogram by threshold."""
    d = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id")
    bins = d.groupBy(F.least(F.floor(F.col("n_chars") / 500), F.lit(7)).alias("bin")).agg(F.sum("quality").alias("s"), F.count("*").alias("n"))
    steps = F.explode(F.sequence(F.lit(0).cast("long"), F.col("bin")))
    out = bins.select(steps.alias("threshold"), "s", "n").groupBy("threshold").agg(F.round(F.sum("s") / F.sum("n"), 6).alias("precision"), F.sum("n").alias("n"))
    return out


@query("""
    SELECT m AS mention, score, rank FROM (SELECT m, score, row_number() OVER (ORDER BY score DESC, m)::INTEGER AS rank FROM (
      SELECT event_id AS m, max(q * round(value / 200, 6)) AS score FROM events JOIN (SELECT 'purchase' AS event_type, 0.5::DOUBLE AS q UNION ALL SELECT 'error', 0.9) USING (event_type) GROUP BY 1)) WHERE rank <= 20
""")
def grounding_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mentions by the product of the query's and their own type scores."""
    q = spark.createDataFrame([("q", "purchase", 0.5), ("q", "error", 0.9)], "query string, type string, score double")
    c = table(spark, sf_dir, "events").select(F.col("event_id").alias("mention"), F.col("event_type").alias("type"), F.round(F.col("value") / 200, 6).alias("score"))
    return grounding.match(q, c, 20).select("mention", "score", "rank")


@query("SELECT o_custkey FROM orders GROUP BY 1 HAVING bool_or(o_orderpriority = '1-URGENT') AND bool_or(o_orderstatus = 'P')")
def entity_and_or(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits with all names of one list and one of the other."""
    o = table(spark, sf_dir, "orders")
    names = o.select("o_custkey", F.col("o_orderpriority").alias("name")).union(o.select("o_custkey", "o_orderstatus"))
    return grounding.with_entities(o.select("o_custkey").distinct(), "o_custkey", names, ["1-URGENT"], ["P"]).select("o_custkey")


@query("SELECT event_type, user_id, round(max(value), 6) AS score, count(*) AS n FROM events GROUP BY ALL")
def corpus_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type, mention and score, the index that retrieval reads."""
    return table(spark, sf_dir, "events").groupBy("event_type", "user_id").agg(F.round(F.max("value"), 6).alias("score"), F.count("*").alias("n"))


@query("SELECT batch, count(*) AS n, sum(n_chars)::BIGINT AS n_chars FROM (SELECT n_chars, ((row_number() OVER (ORDER BY n_chars DESC, doc_id) - 1) % 8)::INTEGER AS batch FROM documents) GROUP BY 1")
def long_first_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents dealt into batches, the longest first."""
    d = table(spark, sf_dir, "documents").select((-F.col("n_chars")).alias("k"), "doc_id", "n_chars")
    d = selection.numbered(d, ["k", "doc_id"], "i")
    return d.groupBy((F.col("i") % 8).cast("int").alias("batch")).agg(F.count("*").alias("n"), F.sum("n_chars").alias("n_chars"))


@query("SELECT user_id, count(*) FILTER (event_type = 'purchase') AS n_ended FROM events GROUP BY 1 HAVING count(*) FILTER (event_type = 'signup') > count(*) FILTER (event_type = 'purchase')")
def failed_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes with more starts than ends."""
    n = lambda kind: F.count_if(F.col("event_type") == kind)
    e = table(spark, sf_dir, "events").groupBy("user_id").agg(n("signup").alias("s"), n("purchase").alias("n_ended"))
    return e.where("s > n_ended").select("user_id", "n_ended")


@query("SELECT year(o_orderdate)::INTEGER AS year, month(o_orderdate)::INTEGER AS month, count(DISTINCT o_custkey) AS n_docs, count(*) AS n FROM orders GROUP BY 1, 2")
def corpus_size_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
    return o.agg(F.countDistinct("o_custkey").alias("n_docs"), F.count("*").alias("n"))


@query("SELECT l_returnflag AS kind, l_linestatus AS role, count(*) AS n, count(DISTINCT l_suppkey) AS n_types FROM lineitem GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_returnflag), ())")
def event_argument_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mentions in all, by type, and by type and role."""
    l = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("kind"), F.col("l_linestatus").alias("role"), "l_suppkey")
    return l.rollup("kind", "role").agg(F.count("*").alias("n"), F.countDistinct("l_suppkey").alias("n_types"))


@query("SELECT kind, text, n, last_grounding FROM (SELECT l_returnflag AS kind, l_linestatus AS text, count(*) AS n, arg_max(l_suppkey, (l_shipdate, l_orderkey, l_linenumber)) AS last_grounding FROM lineitem GROUP BY ALL)")
def merge_frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts summed; the last part's grounding wins."""
    l = table(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("kind"), F.col("l_linestatus").alias("text"))
    return l.agg(F.count("*").alias("n"), F.max_by("l_suppkey", F.struct("l_shipdate", "l_orderkey", "l_linenumber")).alias("last_grounding"))


@query("SELECT o_orderkey, CASE WHEN y > 68 THEN 1900 + y ELSE 2000 + y END AS year FROM (SELECT o_orderkey, strftime(o_orderdate, '%y')::INTEGER AS y FROM orders)")
def market_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-digit years with a pivot."""
    y = F.substring(F.date_format("o_orderdate", "MM/dd/yy"), -2, 2).cast("int")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.when(y > 68, 1900 + y).otherwise(2000 + y).alias("year"))


@query("SELECT CASE WHEN (doc_id * 2654435761) % 1000 < 200 THEN 'test' ELSE 'train' END AS part, lang, count(*) AS n FROM documents GROUP BY ALL")
def train_test_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A split by an arithmetic hash of the id, the same on every run."""
    part = F.when((F.col("doc_id") * 2654435761) % 1000 < 200, "test").otherwise("train")
    return table(spark, sf_dir, "documents").groupBy(part.alias("part"), "lang").agg(F.count("*").alias("n"))


@query("SELECT left_word, word, count(*) AS n FROM (SELECT role AS word, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS left_word FROM conversations) WHERE left_word IS NOT NULL GROUP BY ALL")
def context_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = W.partitionBy("conv_id").orderBy("turn")
    c = table(spark, sf_dir, "conversations").select(F.lag("role").over(w).alias("left_word"), F.col("role").alias("word"))
    return c.where("left_word IS NOT NULL").groupBy("left_word", "word").agg(F.count("*").alias("n"))


@query("""
    WITH s AS (SELECT o_custkey % 40 AS a, list(DISTINCT o_orderpriority) AS ss FROM orders GROUP BY 1)
    SELECT x.a, y.a AS b, len(list_intersect(x.ss, y.ss)) AS overlap FROM s x JOIN s y ON x.a < y.a AND len(list_intersect(x.ss, y.ss)) > 0
""")
def sector_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shared sectors of two actors, joined on the sector and counted."""
    s = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 40).alias("a"), "o_orderpriority").distinct()
    pairs = s.join(s.withColumnRenamed("a", "b"), "o_orderpriority").where("a < b")
    return pairs.groupBy("a", "b").agg(F.count("*").alias("overlap"))


@query("""
    SELECT concat('order/', o_orderkey) AS e, CASE WHEN c_mktsegment = 'BUILDING' THEN 'sector' ELSE 'place' END AS via FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING' AND o_orderstatus IN ('F', 'P')
    UNION ALL SELECT concat('order/', o_orderkey), 'place' FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = 0 AND o_orderstatus IN ('F', 'P')
""")
def graph_actor_caused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of actors of a sector, or of actors of a place, with a VALUES list."""
    t = triples(spark, sf_dir, "orders", "customer", "nation")
    ev = G.values(G.bgp(t, ("?e", "actor", "?a"), ("?e", "status", "?st")), "st", ["F", "P"])
    one = G.join(ev, G.bgp(t, ("?a", "sector", "BUILDING"))).withColumn("via", F.lit("sector"))
    two = G.join(ev, G.bgp(t, ("?a", "located_in", "?n"), ("?n", "part_of", "region/0"))).withColumn("via", F.lit("place"))
    return G.union(one, two).select("e", "via")


@query("""
    SELECT concat('supplier/', s_suppkey) AS a FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey <> 1
      AND s_nationkey NOT IN (SELECT c_nationkey FROM customer WHERE c_mktsegment = 'MACHINERY' AND c_custkey % 9 = 0)
""")
def graph_foreign_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An inequality on a component, and a MINUS."""
    t = triples(spark, sf_dir, "supplier", "nation")
    s = G.bgp(t, ("?a", "type", "supplier"), ("?a", "located_in", "?n"), ("?n", "part_of", "?r")).where("r <> 'region/1'")
    c = triples(spark, sf_dir, "customer").where("s rlike '^customer/'")
    bad = G.bgp(c, ("?c", "sector", "MACHINERY"), ("?c", "located_in", "?n")).where("cast(substring(c, 10) as long) % 9 = 0").select("n").distinct()
    return G.minus(s, bad).select("a")


@query("""
    SELECT concat('order/', o_orderkey) AS e, o_orderpriority AS p, n_name AS place FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey AND n_regionkey = 2 WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus = 'P'
""")
def graph_precipitated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two constant patterns united, with an OPTIONAL place."""
    t = triples(spark, sf_dir, "orders", "customer", "nation")
    ev = G.union(*[G.bgp(t, ("?e", "priority", p), ("?e", "status", "P"), ("?e", "actor", "?a")).withColumn("p", F.lit(p)) for p in ("1-URGENT", "2-HIGH")])
    place = G.bgp(t, ("?a", "located_in", "?n"), ("?n", "part_of", "region/2"), ("?n", "name", "?place")).select("a", "place")
    return G.optional(ev, place).select("e", "p", "place")


@query("SELECT source, count(*) AS n FROM documents WHERE regexp_matches(lower(source), 'src1|src3') GROUP BY 1")
def source_keyword_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.where(F.lower("source").contains("src1") | F.lower("source").contains("src3")).groupBy("source").agg(F.count("*").alias("n"))


@query("SELECT conv_id, role AS label FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS r FROM conversations) WHERE r = 1")
def first_annotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.min_by("role", "turn").alias("label"))
    return c.select("conv_id", "label")


@query("SELECT (sum(CASE WHEN p AND g THEN 1 ELSE 0 END))::BIGINT AS hits, round(avg(CASE WHEN p THEN CASE WHEN g THEN 1.0 ELSE 0.0 END END), 6) AS precision, round(avg(CASE WHEN g THEN CASE WHEN p THEN 1.0 ELSE 0.0 END END), 6) AS recall FROM (SELECT n_chars > 1000 AS p, quality = 1 AS g FROM documents JOIN labels USING (doc_id))")
def retrieval_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Precision and recall of a predicate against labels."""
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id").select((F.col("n_chars") > 1000).alias("p"), (F.col("quality") == 1).alias("g"))
    return d.agg(F.count_if(F.col("p") & F.col("g")).alias("hits"), F.round(F.avg(F.when(F.col("p"), F.col("g").cast("double"))), 6).alias("precision"), F.round(F.avg(F.when(F.col("g"), F.col("p").cast("double"))), 6).alias("recall"))
