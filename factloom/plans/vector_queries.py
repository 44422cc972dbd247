"""Vectors, clusters, metrics, grounding, scalar normalisers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from factloom.functions import money, scores, text as X, time as times
from factloom.operators import clustering, grounding, metrics, selection, vectors as V
from factloom.plans.registry import query
from factloom.sources.tables import table

_E = "WITH e AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings), u AS (SELECT *, sqrt(list_dot_product(v, v)) AS nrm FROM e)"


def _embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").withColumnRenamed("embedding", "v")


@query(_E + """
    SELECT query, item, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, item)::INTEGER AS rank FROM (
      SELECT a.vec_id AS query, b.vec_id AS item, round(list_dot_product(a.v, b.v) / (a.nrm * b.nrm), 6) AS score FROM u a JOIN u b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0)) WHERE rank <= 5
""")
def cosine_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five nearest neighbours of every twentieth vector among all vectors."""
    e = _embeddings(spark, sf_dir)
    return V.top_neighbours(e.where("vec_id % 20 = 0"), e, "vec_id", "vec_id", "v", 5).select("query", "item", "score", "rank")


@query(_E + "SELECT a.vec_id AS a, b.vec_id AS b, round(list_dot_product(a.v, b.v) / (a.nrm * b.nrm), 6) AS score FROM u a JOIN u b ON a.vec_id < b.vec_id WHERE round(list_dot_product(a.v, b.v) / (a.nrm * b.nrm), 6) >= 0.8")
def cosine_threshold_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.threshold_pairs(_embeddings(spark, sf_dir), "vec_id", "v", 0.8)


_C = ", c AS (SELECT label, list(m ORDER BY d) AS centroid FROM (SELECT label, d, avg(x) AS m FROM (SELECT label, unnest(v) AS x, unnest(range(1, 65)) AS d FROM e) GROUP BY ALL) GROUP BY label)"


@query(_E + _C + " SELECT label, unnest(range(1, 65)) AS dim, round(unnest(centroid), 6) AS value FROM c")
def centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = V.average(_embeddings(spark, sf_dir), ["label"], "v")
    return c.select("label", F.posexplode("centroid").alias("dim", "value")).select("label", (F.col("dim") + 1).cast("long").alias("dim"), F.round("value", 6).alias("value"))


@query(_E + """
    , s AS (SELECT a.label, a.vec_id AS item, round(avg(list_dot_product(a.v, b.v) / (a.nrm * b.nrm)), 6) AS mean_similarity FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id GROUP BY ALL)
    SELECT label, item, mean_similarity FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY mean_similarity DESC, item) AS r FROM s) WHERE r = 1
""")
def medoid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.medoids(_embeddings(spark, sf_dir), "label", "vec_id", "v")


@query(_E + "SELECT a.label, count(DISTINCT a.vec_id) AS n, round(sum(list_dot_product(a.v, b.v) / (a.nrm * b.nrm)) / (count(DISTINCT a.vec_id) * (count(DISTINCT a.vec_id) - 1)), 6) AS average FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id GROUP BY 1")
def group_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Average similarity of the pairs of each group, from the sum of unit vectors."""
    g = V.group_sums(_embeddings(spark, sf_dir), "label", "v")
    return g.select("label", "n", F.round(scores.group_similarity(F.col("total"), F.col("n")), 6).alias("average"))


_NEAR = _E + _C + """
    , k AS (SELECT vec_id AS item, e.label AS gold, c.label, round(list_cosine_similarity(v, centroid), 6) AS score FROM e, c),
    n AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, label)::INTEGER AS rank FROM k)
"""


def _near(spark: SparkSession, sf_dir: str, k: int) -> DataFrame:
    e = _embeddings(spark, sf_dir)
    return V.nearest_centroids(e, "vec_id", "v", V.average(e, ["label"], "v"), "label", k)


@query(_NEAR + "SELECT item, label, score, rank FROM n WHERE rank <= 3")
def nearest_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _near(spark, sf_dir, 3).select("item", "label", "score", "rank")


def _predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = _embeddings(spark, sf_dir).select(F.col("vec_id").alias("item"), F.col("label").alias("gold"))
    return _near(spark, sf_dir, 1).select("item", F.col("label").alias("pred")).join(gold, "item")


_CELLS = _NEAR + ", x AS (SELECT gold, label AS pred, count(*) AS n FROM n WHERE rank = 1 GROUP BY ALL)"


@query(_CELLS + """
    , p AS (SELECT (SELECT sum(n * (n - 1) / 2) FROM x) AS b, (SELECT sum(n * (n - 1) / 2) FROM (SELECT sum(n) AS n FROM x GROUP BY gold)) AS g, (SELECT sum(n * (n - 1) / 2) FROM (SELECT sum(n) AS n FROM x GROUP BY pred)) AS q)
    SELECT round(b / q, 6) AS precision, round(b / g, 6) AS recall, round(2 * (b / q) * (b / g) / (b / q + b / g), 6) AS f1 FROM p
""")
def pairwise_f(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = metrics.pairwise_f(_predicted(spark, sf_dir), "gold", "pred")
    return m.select(*[F.round(c, 6).alias(c) for c in m.columns])


@query(_CELLS + """
    , w AS (SELECT *, sum(n) OVER (PARTITION BY gold) AS g, sum(n) OVER (PARTITION BY pred) AS q FROM x), m AS (SELECT sum(CASE WHEN q > 1 THEN n * (n - 1) / (q - 1) ELSE 0 END) / sum(n) AS p, sum(n * (n - 1) / (g - 1)) / sum(n) AS r FROM w WHERE g > 1)
    SELECT round(p, 6) AS precision, round(r, 6) AS recall, round(2 * p * r / (p + r), 6) AS f1 FROM m
""")
def bcubed(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = metrics.bcubed(_predicted(spark, sf_dir), "gold", "pred")
    return m.select(*[F.round(c, 6).alias(c) for c in m.columns])


@query(_CELLS + """
    , w AS (SELECT *, sum(n) OVER () AS t, sum(n) OVER (PARTITION BY gold) AS g, sum(n) OVER (PARTITION BY pred) AS q FROM x)
    SELECT round(mi, 6) AS mi, round(2 * mi / (hg + hp), 6) AS nmi FROM (SELECT sum(n / t * log2(t * n / (g * q))) AS mi, -sum(n / t * log2(g / t)) AS hg, -sum(n / t * log2(q / t)) AS hp FROM w)
""")
def nmi(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = metrics.nmi(_predicted(spark, sf_dir), "gold", "pred")
    return m.select(*[F.round(c, 6).alias(c) for c in m.columns])


@query(_NEAR + "SELECT n AS top, round(avg(CASE WHEN hit <= n THEN 1.0 ELSE 0.0 END), 6) AS share FROM (SELECT item, rank AS hit FROM n WHERE label = gold), (SELECT unnest([1, 2, 3, 5]) AS n) GROUP BY 1")
def hit_at_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of vectors whose own label is among the nearest n centroids."""
    gold = _embeddings(spark, sf_dir).select(F.col("vec_id").alias("item"), "label")
    labels = table(spark, sf_dir, "embeddings").select("label").distinct().count()
    hits = _near(spark, sf_dir, labels).join(gold, ["item", "label"]).select("item", "rank", F.explode(F.array(*[F.lit(n) for n in (1, 2, 3, 5)])).alias("top"))
    return hits.groupBy("top").agg(F.round(F.avg((F.col("rank") <= F.col("top")).cast("double")), 6).alias("share"))


@query(_E + """
    , u2 AS (SELECT *, v[1:32] AS f1, v[33:64] AS f2 FROM e), q AS (SELECT * FROM u2 WHERE vec_id % 20 = 0),
    d AS (SELECT q.vec_id AS query, i.vec_id AS item, 1 - list_cosine_similarity(q.f1, i.f1) AS d1, (1 - list_cosine_similarity(q.f2, i.f2)) * 0.5 AS d2 FROM q, u2 i WHERE q.vec_id <> i.vec_id)
    SELECT query, item, round(d1 + d2, 6) AS distance FROM d WHERE d1 < 0.6 AND d2 < 0.6
""")
def weighted_multi_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items near a query in both halves of the vector, taken as two features."""
    e = _embeddings(spark, sf_dir).select("vec_id", *[F.slice("v", 32 * k + 1, 32).alias(f"h{k}") for k in (0, 1)])
    near = V.weighted_neighbours(e.where("vec_id % 20 = 0"), e, "vec_id", "vec_id", [("h0", 1.0), ("h1", 0.5)], 0.6)
    return near.select("query", "item", F.round("distance", 6).alias("distance"))


@query(_E + "SELECT band, value, count(*) AS n, min(vec_id) AS first_item FROM (SELECT vec_id, b AS band, array_to_string(list_transform(v[b * 8 + 1 : b * 8 + 8], lambda x: CASE WHEN x >= 0 THEN '1' ELSE '0' END), '') AS value FROM e, (SELECT unnest(range(0, 4))::INTEGER AS b)) GROUP BY ALL")
def sign_hash_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = V.sign_bands(_embeddings(spark, sf_dir), "vec_id", "v", 4, 8)
    return b.groupBy("band", "value").agg(F.count("*").alias("n"), F.min("item").alias("first_item"))


@query(_E + "SELECT a.vec_id, b.vec_id AS other, round(list_sum(list_transform(range(1, 65), lambda i: abs(a.v[i] - b.v[i]))), 6) AS distance FROM e a JOIN e b ON b.vec_id = a.vec_id + 1")
def manhattan_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _embeddings(spark, sf_dir).select("vec_id", V.doubles("v").alias("v"))
    nxt = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("vec_id").alias("other"), F.col("v").alias("w"))
    return e.join(nxt, "vec_id").select("vec_id", "other", F.round(V.manhattan(F.col("v"), F.col("w")), 6).alias("distance"))


@query("""
    WITH t AS (SELECT doc_id, term, count(*)::DOUBLE AS tf FROM (SELECT doc_id, unnest(string_split_regex(lower(text), '[^a-z0-9]+')) AS term FROM documents WHERE lang = 'en') WHERE length(term) > 9 GROUP BY ALL),
    b AS (SELECT term, sum(tf) AS tf FROM t GROUP BY 1), bn AS (SELECT sqrt(sum(tf * tf)) AS n FROM b), tn AS (SELECT doc_id, sqrt(sum(tf * tf)) AS n FROM t GROUP BY 1)
    SELECT doc_id, round(sum(t.tf * b.tf) / (min(tn.n) * min(bn.n)), 6) AS score FROM t JOIN b USING (term) JOIN tn USING (doc_id), bn GROUP BY doc_id
""")
def document_relevance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse cosine of each document against the whole corpus."""
    t = table(spark, sf_dir, "documents").where("lang = 'en'").select("doc_id", F.explode(X.tokens(F.col("text"))).alias("idx")).where("length(idx) > 9")
    t = t.groupBy("doc_id", "idx").agg(F.count("*").cast("double").alias("val"))
    b = t.groupBy("idx").agg(F.sum("val").alias("val")).withColumn("corpus", F.lit(0))
    return V.sparse_cosine(t, b, "doc_id", "corpus").select("doc_id", F.round("score", 6).alias("score"))


@query()
def hac_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Agglomerative clusters within each label; invariants are tested."""
    return clustering.hac_by_group(_embeddings(spark, sf_dir), "label", "vec_id", "v", 0.3)


@query()
def committees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clustering by committee within each label, with 50 nearest neighbours; held against a plain version in the tests."""
    return clustering.cbc_by_group(_embeddings(spark, sf_dir), "label", "vec_id", "v")


@query("""
    WITH c AS (SELECT user_id, count(*)::DOUBLE AS coherence, avg(value) AS novelty FROM events GROUP BY 1), m AS (SELECT avg(coherence) AS a, stddev_pop(coherence) AS b, avg(novelty) AS c, stddev_pop(novelty) AS d FROM c)
    SELECT user_id, round((coherence - a) / b - (novelty - c.c2) / d, 6) AS rank_score FROM (SELECT user_id, coherence, novelty, a, b, m.c AS c2, d FROM c, m) c
""")
def cluster_rank_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").cast("double").alias("coherence"), F.avg("value").alias("novelty"))
    return metrics.rank_scores(c, "coherence", "novelty").select("user_id", F.round("rank_score", 6).alias("rank_score"))


@query("SELECT round(avg(quality), 6) AS precision FROM (SELECT quality::DOUBLE AS quality FROM labels JOIN documents USING (doc_id) ORDER BY n_chars DESC, doc_id LIMIT 50)")
def precision_at_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of good documents among the fifty longest."""
    d = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id")
    return metrics.precision_at(d, [F.col("n_chars").desc(), F.col("doc_id")], F.col("quality") == 1, 50).select(F.round("precision", 6).alias("precision"))


@query(_NEAR + "SELECT item, label, least(round(score * CASE WHEN rank = 1 THEN 1 ELSE 0.9 END, 6), 1.0) AS score, rank FROM n WHERE rank <= 2 AND score * CASE WHEN rank = 1 THEN 1 ELSE 0.9 END >= 0.2")
def grounding_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best nodes of each mention above a threshold; a node that is not the first mode's is weighted down."""
    n = _near(spark, sf_dir, 2).withColumn("s", F.col("score") * F.when(F.col("rank") == 1, 1.0).otherwise(0.9)).where("s >= 0.2")
    return n.select("item", "label", scores.clamp(F.round("s", 6), -1.0).alias("score"), "rank")


@query("""
    WITH p AS (SELECT p_partkey, string_split(p_type, ' ') AS w FROM part), m AS (SELECT DISTINCT split_part(p_type, ' ', 1) AS path FROM part WHERE p_size > 10
      UNION SELECT DISTINCT concat(split_part(p_type, ' ', 1), '/', split_part(p_type, ' ', 2)) FROM part WHERE p_size > 45)
    SELECT p_partkey, path, depth FROM (SELECT p_partkey, m.path, n AS depth, row_number() OVER (PARTITION BY p_partkey ORDER BY n DESC) AS r
      FROM (SELECT p_partkey, n::INTEGER AS n, array_to_string(w[1:n], '/') AS path FROM p, (SELECT unnest([1, 2, 3]) AS n) WHERE n <= len(w)) x JOIN m ON m.path = x.path) WHERE r = 1
""")
def path_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deepest ancestor of a path that a mapping has."""
    p = table(spark, sf_dir, "part")
    mapped = p.where("p_size > 10").select(F.split("p_type", " ")[0].alias("path")).union(p.where("p_size > 45").select(F.array_join(F.slice(F.split("p_type", " "), 1, 2), "/"))).distinct()
    return grounding.back_off(p.select("p_partkey", F.replace("p_type", F.lit(" "), F.lit("/")).alias("full")), "p_partkey", "full", mapped, "path").select("p_partkey", "path", "depth")


@query("SELECT doc_id, regexp_replace(s, '(L)L*', 'L', 'g') AS shape FROM (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(w, '[A-Z]', 'U', 'g'), '[a-z]', 'L', 'g'), '[0-9]', 'D', 'g'), '[.,]', '.', 'g') AS s FROM (SELECT doc_id, string_split(text, ' ')[1] AS w FROM documents) WHERE regexp_full_match(w, '[A-Za-z0-9.,]+') AND NOT regexp_matches(w, '[A-Z]{2}|[0-9]{2}|[.,]{2}'))")
def token_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", F.split("text", " ")[0].alias("w")).where(r"w rlike '^[A-Za-z0-9.,]+$' AND NOT w rlike '[A-Z]{2}|[0-9]{2}|[.,]{2}'")
    return d.select("doc_id", X.short_shape(F.col("w")).alias("shape"))


_DATES = """
    WITH d AS (SELECT o_orderkey, o_orderdate::DATE AS d, year(o_orderdate) AS y, month(o_orderdate) AS m FROM orders),
    v AS (SELECT o_orderkey, o_orderkey % 5 AS form, date_trunc('year', d)::DATE AS y0, date_trunc('month', d)::DATE AS m0, date_trunc('quarter', d)::DATE AS q0, d, CASE WHEN m <= 6 THEN make_date(y, 1, 1) ELSE make_date(y, 7, 1) END AS h0 FROM d),
    s AS (SELECT o_orderkey, CASE form WHEN 0 THEN y0 WHEN 1 THEN m0 WHEN 2 THEN d WHEN 3 THEN q0 ELSE h0 END::TIMESTAMP AS a, form FROM v)
"""


@query(_DATES + "SELECT o_orderkey, a AS start_time, a + CASE form WHEN 0 THEN INTERVAL 1 YEAR WHEN 1 THEN INTERVAL 1 MONTH WHEN 2 THEN INTERVAL 1 DAY WHEN 3 THEN INTERVAL 3 MONTH ELSE INTERVAL 6 MONTH END - INTERVAL 1 SECOND AS end_time FROM s")
def time_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").withColumn("form", F.col("o_orderkey") % 5)
    d, y = F.col("o_orderdate"), F.date_format("o_orderdate", "yyyy")
    value = (
        F.when(F.col("form") == 0, y).when(F.col("form") == 1, F.date_format(d, "yyyy-MM")).when(F.col("form") == 2, F.date_format(d, "yyyy-MM-dd"))
        .when(F.col("form") == 3, F.concat(y, F.lit("-Q"), F.quarter(d).cast("string"))).otherwise(F.concat(y, F.lit("-H"), F.when(F.month(d) <= 6, "1").otherwise("2")))
    )
    n = o.select("o_orderkey", times.normalise(value).alias("i"))
    return n.select("o_orderkey", F.col("i.start").alias("start_time"), F.col("i.end").alias("end_time"))


@query("SELECT o_orderkey, 'USD' AS currency, o_totalprice::DECIMAL(20,2)::DOUBLE AS amount, CASE WHEN o_orderkey % 3 = 1 THEN NULL ELSE o_totalprice::DECIMAL(20,2)::DOUBLE END AS max_amount FROM orders")
def money_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    sum_ = F.format_number(F.col("o_totalprice").cast("decimal(20,2)"), 2)
    t = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("costs $"), sum_)).when(F.col("o_orderkey") % 3 == 1, F.concat(F.lit("more than $"), sum_, F.lit(" in all"))).otherwise(F.concat(F.lit("it took "), sum_, F.lit(" dollars")))
    m = o.select("o_orderkey", money.amount(t).alias("m"))
    return m.select("o_orderkey", F.col("m.currency").alias("currency"), F.col("m.amount").alias("amount"), F.col("m.max").alias("max_amount"))


@query("SELECT l_orderkey, l_linenumber, l_quantity AS low, l_quantity + 5 AS high, CASE WHEN l_linenumber % 2 = 0 THEN 'Increase' END AS trend, 'month' AS time_interval FROM lineitem")
def numeric_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem")
    t = F.concat(F.when(F.col("l_linenumber") % 2 == 0, "rose ").otherwise("was "), F.lit("between "), F.col("l_quantity").cast("int").cast("string"), F.lit(" and "), (F.col("l_quantity").cast("int") + 5).cast("string"), F.lit(" tons per month"))
    q = l.select("l_orderkey", "l_linenumber", money.quantity(t).alias("q"))
    return q.select("l_orderkey", "l_linenumber", F.col("q.min_val").alias("low"), F.col("q.max_val").alias("high"), F.col("q.trend").alias("trend"), F.col("q.time_interval").alias("time_interval"))
