"""Statistics, features, samples and exports that are projections or groupings of the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from factloom.operators import annotators, learning, selection, syntax, vectors
from factloom.plans.registry import query
from factloom.sources import sinks
from factloom.sources.tables import table


@query("SELECT event_type, user_id, n FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY n DESC, user_id) AS r FROM (SELECT event_type, user_id, count(*) AS n FROM events GROUP BY 1, 2)) WHERE r <= 10")
def entity_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten most frequent names of each type."""
    c = table(spark, sf_dir, "events").groupBy("event_type", "user_id").agg(F.count("*").alias("n"))
    return selection.top_by(c, ["event_type"], [F.desc("n"), F.asc("user_id")], 10).select("event_type", "user_id", "n")


@query("SELECT coalesce(l_returnflag, 'all') AS kind, coalesce(l_linestatus, 'all') AS status, count(*) AS n_mentions, count(DISTINCT l_orderkey) AS n_docs FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def statistics_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count("*").alias("n_mentions"), F.countDistinct("l_orderkey").alias("n_docs"))
    return l.select(F.coalesce("l_returnflag", F.lit("all")).alias("kind"), F.coalesce("l_linestatus", F.lit("all")).alias("status"), "n_mentions", "n_docs")


@query("SELECT concat_ws('|', l_returnflag, l_linestatus, l_linenumber) AS instance, count(*) AS n FROM lineitem GROUP BY 1")
def instance_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy(F.concat_ws("|", "l_returnflag", "l_linestatus", F.col("l_linenumber").cast("string")).alias("instance")).agg(F.count("*").alias("n"))


@query("""
    WITH up AS (SELECT event_id AS child, event_id // (1::BIGINT << k) AS ancestor, k FROM events, (SELECT unnest(range(0, 4)) AS k) WHERE event_id // (1::BIGINT << k) > 0),
    p AS (SELECT a.child, a.k AS u, b.k AS d, row_number() OVER (PARTITION BY a.child ORDER BY a.k + b.k, a.ancestor) AS r FROM up a JOIN up b ON b.child = a.child + 1 AND a.ancestor = b.ancestor)
    SELECT u AS hops_up, d AS hops_down, count(*) AS n FROM p WHERE r = 1 GROUP BY ALL
""")
def path_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often a path between neighbouring predicates has so many steps up and down."""
    t = table(spark, sf_dir, "events").where("event_id > 0").selectExpr("event_id AS node", "nullif(event_id div 2, 0) AS parent")
    p = syntax.tree_paths(t.selectExpr("node AS l", "node + 1 AS r"), t, "l", "r", "node", "parent", 3)
    return p.groupBy(F.col("steps_up").cast("long").alias("hops_up"), F.col("steps_down").cast("long").alias("hops_down")).agg(F.count("*").alias("n"))


@query("SELECT doc_id, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def predicted_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that a classifier called events stay."""
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return table(spark, sf_dir, "documents").join(good, "doc_id", "left_semi").select("doc_id", "n_chars")


@query("""
    WITH d AS (SELECT event_id, event_type, user_id, row_number() OVER (PARTITION BY event_type, user_id ORDER BY value DESC, event_id) AS r FROM events),
    k AS (SELECT * FROM d WHERE r <= 3), n AS (SELECT *, count(*) OVER (PARTITION BY event_type, user_id) AS c FROM k),
    s AS (SELECT event_id, event_type, user_id FROM n WHERE c >= 2),
    p AS (SELECT event_id AS a, lead(event_id) OVER (PARTITION BY event_type, user_id ORDER BY event_id) AS b, event_type FROM s)
    SELECT a, b, event_type FROM p WHERE b IS NOT NULL
""")
def three_phase_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs in three phases: at most three mentions of a trigger, triggers of enough mentions, pairs of neighbours."""
    g = ["event_type", "user_id"]
    k = selection.top_by(table(spark, sf_dir, "events"), g, [F.desc("value"), F.asc("event_id")], 3)
    s = k.withColumn("c", F.count("*").over(W.partitionBy(*g))).where("c >= 2")
    p = s.withColumn("b", F.lead("event_id").over(W.partitionBy(*g).orderBy("event_id")))
    return p.where("b IS NOT NULL").select(F.col("event_id").alias("a"), "b", "event_type")


@query("""
    WITH f AS (SELECT l_orderkey, unnest([concat('flag=', l_returnflag), concat('status=', l_linestatus), concat('line=', l_linenumber)]) AS feature FROM lineitem),
    i AS (SELECT feature, row_number() OVER (ORDER BY feature) AS idx FROM (SELECT DISTINCT feature FROM f)), c AS (SELECT l_orderkey, idx, count(*) AS n FROM f JOIN i USING (feature) GROUP BY ALL)
    SELECT l_orderkey, string_agg(concat(idx, ':', n), ' ' ORDER BY idx) AS vector FROM c GROUP BY 1
""")
def sparse_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of each order as index:count, by index."""
    named = [F.concat(F.lit(f"{k}="), F.col(c).cast("string")) for k, c in (("flag", "l_returnflag"), ("status", "l_linestatus"), ("line", "l_linenumber"))]
    f = table(spark, sf_dir, "lineitem").select("l_orderkey", F.explode(F.array(*named)).alias("feature"))
    c = f.groupBy("l_orderkey", "feature").agg(F.count("*").alias("n")).join(learning.feature_table(f, "feature"), "feature")
    entry = F.struct(F.col("index").cast("long").alias("i"), "n")
    parts = F.transform(F.array_sort(F.collect_list(entry)), lambda x: F.concat_ws(":", x["i"].cast("string"), x["n"].cast("string")))
    return c.groupBy("l_orderkey").agg(F.array_join(parts, " ").alias("vector"))


@query("SELECT vec_id // 5 AS span, round(avg(embedding[1]), 4) AS first_value, round(avg(embedding[64]), 4) AS last_value FROM embeddings GROUP BY 1")
def span_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean embedding of the tokens of each span."""
    e = table(spark, sf_dir, "embeddings").select(F.expr("vec_id div 5").alias("span"), "embedding")
    m = vectors.average(e, ["span"], "embedding")
    return m.select("span", F.round(F.col("centroid")[0], 4).alias("first_value"), F.round(F.col("centroid")[63], 4).alias("last_value"))


@query("SELECT a.vec_id AS a, b.vec_id AS b, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 4) AS similarity FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1")
def paragraph_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cosine of the paragraph vectors of given pairs."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", vectors.doubles("embedding").alias("v"))
    b = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("vec_id").alias("b"), F.col("v").alias("w"))
    return e.join(b, "vec_id").select(F.col("vec_id").alias("a"), "b", F.round(vectors.cosine(F.col("v"), F.col("w")), 4).alias("similarity"))


@query("""
    WITH w AS (SELECT vec_id // 4 AS event, vec_id, embedding::DOUBLE[] AS v FROM embeddings),
    p AS (SELECT x.event, x.vec_id AS l, y.vec_id AS r, round(list_cosine_similarity(x.v, y.v), 6) AS s FROM w x JOIN w y ON y.event = x.event + 1)
    SELECT event, l, r, round(s, 4) AS similarity FROM (SELECT *, row_number() OVER (PARTITION BY event ORDER BY s DESC, l, r) AS k FROM p) WHERE k = 1
""")
def best_word_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most similar words of the contexts of two events; a context has a fixed number of words."""
    w = table(spark, sf_dir, "embeddings").select(F.expr("vec_id div 4").alias("event"), F.col("vec_id").alias("l"), vectors.doubles("embedding").alias("v"))
    y = w.select((F.col("event") - 1).alias("event"), F.col("l").alias("r"), F.col("v").alias("u"))
    p = w.join(y, "event").select("event", "l", "r", F.round(vectors.cosine(F.col("v"), F.col("u")), 6).alias("s"))
    return selection.first_by(p, ["event"], [F.desc("s"), F.asc("l"), F.asc("r")]).select("event", "l", "r", F.round("s", 4).alias("similarity"))


@query("""
    WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z]+') AS w FROM documents), i AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS k FROM w)
    SELECT doc_id, 'Licence' AS event_type, k - 1 AS phrase_start, k + 1 AS phrase_end, k AS anchor FROM i WHERE w[k] = 'general' AND w[k + 1] = 'public' AND w[k + 2] = 'license'
    UNION ALL SELECT doc_id, 'Permit', k - 1, k, k - 1 FROM i WHERE w[k] = 'licensed' AND w[k + 1] = 'under'
""")
def intervention_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of key phrases, with the place of their anchor word."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0)).alias("words"))
    m = annotators.phrase_mentions(d, "words", [("Licence", "general <public> license"), ("Permit", "licensed under")])
    return m.drop("words").select("doc_id", "event_type", *[F.col(c).cast("long").alias(c) for c in ("phrase_start", "phrase_end", "anchor")])


@query("SELECT o_orderkey, count(l_orderkey) AS n_frames, min(l_shipdate)::DATE::VARCHAR AS first_time FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1")
def event_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames of each document as JSON, read back."""
    f = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.struct(F.date_format("l_shipdate", "yyyy-MM-dd").alias("time"), "l_linenumber", "l_returnflag").alias("frame"))
    j = sinks.frames_json(table(spark, sf_dir, "orders"), f, "o_orderkey", "frame")
    back = F.from_json("frames", "ARRAY<STRUCT<time: STRING>>")
    return j.select("o_orderkey", F.size(back).cast("long").alias("n_frames"), F.array_min(back["time"]).alias("first_time"))


@query("SELECT conv_id, count(*) AS n_tokens, count(*) FILTER (WHERE role = 'user') AS n_mentions FROM conversations GROUP BY 1")
def training_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns stand for tokens, those of the user for mentions; the JSON is read back."""
    c = table(spark, sf_dir, "conversations")
    m = c.where("role = 'user'").select("conv_id", F.struct("turn", F.lit("user").alias("label")).alias("mention"))
    j = sinks.training_json(c, m, ["conv_id"], "turn", "role", "mention")
    back = F.from_json("example", "tokens ARRAY<STRING>, mentions ARRAY<STRUCT<turn: BIGINT>>")
    return j.select("conv_id", F.size(back["tokens"]).cast("long").alias("n_tokens"), F.size(back["mentions"]).cast("long").alias("n_mentions"))
