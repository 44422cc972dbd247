"""Neighbour search, merges of similarities, retrieval segments and results, look-ups, features, monitoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from factloom.functions import text as X
from factloom.operators import search as S, selection, vectors as V
from factloom.plans.registry import query
from factloom.sources.tables import table
from factloom.streaming import minibatch

_E = "WITH e AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings)"


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").withColumnRenamed("embedding", "v")


@query()
def approximate_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest neighbours of every twentieth vector by cells of the space; all rows are indexed, recall is tested.

    These vectors are spread evenly, so four fifths of the cells are probed for a recall of 0.9; clustered ones need a tenth."""
    e = _vectors(spark, sf_dir)
    cells = max(4, int(e.count() ** 0.5 / 2))
    centres = S.fit_cells(e, "vec_id", "v", cells)
    return S.approximate_top(e.where("vec_id % 20 = 0"), e, "vec_id", "v", 10, centres, max(2, -(-cells * 4 // 5)))


@query(_E + """, f AS (SELECT vec_id, 'first' AS feature, v[1:32] AS h FROM e UNION ALL SELECT vec_id, 'second', v[33:64] FROM e)
    SELECT feature, query, item, score, rank FROM (SELECT a.feature, a.vec_id AS query, b.vec_id AS item, round(list_cosine_similarity(a.h, b.h), 6) AS score,
      row_number() OVER (PARTITION BY a.feature, a.vec_id ORDER BY round(list_cosine_similarity(a.h, b.h), 6) DESC, b.vec_id)::INTEGER AS rank FROM f a JOIN f b ON a.feature = b.feature AND a.vec_id <> b.vec_id AND a.vec_id % 20 = 0) WHERE rank <= 4""")
def feature_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest neighbours of every twentieth vector by each of two features."""
    e, out = _vectors(spark, sf_dir), None
    for k, name in enumerate(("first", "second")):
        half = e.select("vec_id", F.slice(V.doubles("v"), 32 * k + 1, 32).alias("h"))
        part = V.top_neighbours(half.where("vec_id % 20 = 0"), half, "vec_id", "vec_id", "h", 4).withColumn("feature", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out.select("feature", "query", "item", "score", "rank")


_P = _E + ", p AS (SELECT a.vec_id AS a, b.vec_id AS b, round(list_cosine_similarity(a.v, b.v), 6) AS score FROM e a JOIN e b ON a.vec_id < b.vec_id AND a.label = b.label AND a.vec_id % 20 = 0)"


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _vectors(spark, sf_dir).select("vec_id", "label", V.unit(V.doubles("v")).alias("v"))
    a = e.where("vec_id % 20 = 0").select(F.col("vec_id").alias("a"), "label", F.col("v").alias("va"))
    pairs = a.join(e.select(F.col("vec_id").alias("b"), "label", "v"), "label").where("a < b")
    return pairs.select("a", "b", F.round(V.dot(F.col("va"), F.col("v")), 6).alias("score"))


@query(_P + " SELECT form, count(*) AS n, round(sum(score), 3) AS total FROM p, (SELECT unnest(['tsv', 'json']) AS form) GROUP BY 1")
def similarity_dumps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs written in two forms and read back."""
    p, out = _pairs(spark, sf_dir), None
    for form in ("tsv", "json"):
        part = S.read_dump(S.dump_lines(p, form), form).agg(F.count("*").alias("n"), F.round(F.sum("score"), 3).alias("total")).withColumn("form", F.lit(form))
        out = part if out is None else out.unionByName(part)
    return out.select("form", "n", "total")


@query(_P + """, d AS (SELECT a, b, round(1 - score, 6) AS distance FROM p UNION ALL SELECT a, b, round(1.1 - score, 6) FROM p WHERE b % 2 = 0), m AS (SELECT a, b, min(distance) AS distance FROM d WHERE distance < 0.9 GROUP BY ALL)
    SELECT a, b, distance, rank FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY distance, b)::INTEGER AS rank FROM m) WHERE rank <= 5""")
def merged_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two partial tables of distances as one, the nearest five of each."""
    p = _pairs(spark, sf_dir)
    parts = [p.select("a", "b", F.round(1 - F.col("score"), 6).alias("distance")), p.where("b % 2 = 0").select("a", "b", F.round(1.1 - F.col("score"), 6).alias("distance"))]
    return S.merge_pairs(parts, 0.9, 5)


@query("""SELECT concat('r', r_regionkey) AS id, concat('{"id":"r', r_regionkey, '","children":[', coalesce(string_agg(concat('{"id":"n', n_nationkey, '","children":[]}'), ',' ORDER BY concat('n', n_nationkey)), ''), ']}') AS tree FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY r_regionkey""")
def merge_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges of a tree as nested JSON for each root."""
    n = table(spark, sf_dir, "nation").select(F.concat(F.lit("r"), "n_regionkey").alias("parent"), F.concat(F.lit("n"), "n_nationkey").alias("child"))
    return S.tree_json(n, 2)


@query("SELECT p_brand, pairs, pairs - same AS wrong FROM (SELECT p_brand, (sum(n) * (sum(n) - 1) / 2)::BIGINT AS pairs, ((sum(n * n) - sum(n)) / 2)::BIGINT AS same FROM (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY ALL) GROUP BY 1)")
def cluster_mistakes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a cluster (brand) and those of different labels (type)."""
    return S.cluster_mistakes(table(spark, sf_dir, "part"), "p_brand", "p_type")


@query("""WITH p AS (SELECT p_partkey AS a, p_brand, p_type, lead(p_partkey) OVER c AS cn, lead(p_type) OVER c AS ct, lead(p_partkey) OVER t AS tn, lead(p_brand) OVER t AS tb FROM part WINDOW c AS (PARTITION BY p_brand ORDER BY p_partkey), t AS (PARTITION BY p_type ORDER BY p_partkey))
    SELECT a, cn AS b, 'positive' AS mistake FROM p WHERE ct <> p_type UNION ALL SELECT a, tn, 'negative' FROM p WHERE tb <> p_brand""")
def sampled_mistakes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs that a clustering has wrong, one of each kind for an item at most."""
    return S.sampled_mistakes(table(spark, sf_dir, "part"), "p_partkey", "p_brand", "p_type")


@query(_E + """ SELECT a.vec_id, name AS metric, round(CASE name WHEN 'COSINE' THEN list_cosine_similarity(a.v, b.v) ELSE list_sum(list_transform(range(1, 65), lambda i: abs(a.v[i] - b.v[i]))) END, 5) AS value
    FROM e a JOIN e b ON b.vec_id = a.vec_id + 1, (SELECT unnest(['COSINE', 'MANHATTAN']) AS name)""")
def metric_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics chosen by name, for each vector and the next one."""
    e = _vectors(spark, sf_dir).select("vec_id", V.doubles("v").alias("v"))
    both = e.join(e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("v").alias("w")), "vec_id")
    parts = [F.struct(F.lit(n).alias("metric"), F.round(S.metric(n)(F.col("v"), F.col("w")), 5).alias("value")) for n in ("cosine".upper(), "MANHATTAN")]
    return both.select("vec_id", F.inline(F.array(*parts)))


@query("SELECT s_suppkey AS actor, n_name AS sector FROM supplier JOIN nation ON n_nationkey = s_nationkey UNION SELECT s_suppkey, r_name FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey")
def actor_sectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sectors of an actor, its own and the one above."""
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    s = table(spark, sf_dir, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    return s.select(F.col("s_suppkey").alias("actor"), F.explode(F.array_distinct(F.array("n_name", "r_name"))).alias("sector"))


@query("SELECT concat('line-', event_id % 50) AS name, event_id AS actor FROM events WHERE event_type = 'signup'")
def actors_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actors that have a name, for all asked names; several may share one."""
    e = table(spark, sf_dir, "events").where("event_type = 'signup'").select(F.concat(F.lit("line-"), F.col("event_id") % 50).alias("name"), F.col("event_id").alias("actor"))
    asked = e.select("name").distinct()
    return asked.join(e, "name")


@query(_E + " SELECT concat('w', vec_id) AS word, len(v)::INTEGER AS size, round(list_sum(list_transform(v, lambda x: round(x, 6))), 4) AS total FROM e")
def embedding_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors as lines of text, read back with a header and a broken line among them."""
    e = _vectors(spark, sf_dir)
    numbers = F.array_join(F.transform(V.doubles("v"), lambda x: F.round(x, 6).cast("string")), " ")
    lines = e.select(F.concat_ws(" ", F.concat(F.lit("w"), "vec_id"), numbers).alias("value"))
    lines = lines.union(spark.createDataFrame([("500 64",), ("broken 1.0 x",)], "value string"))
    return S.read_embeddings(lines).select("word", F.size("vector").alias("size"), F.round(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x), 4).alias("total"))


@query(_E + """ SELECT query, item, score, rank FROM (SELECT a.vec_id AS query, b.vec_id AS item, round(list_cosine_similarity(a.v, b.v), 6) AS score, row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_cosine_similarity(a.v, b.v), 6) DESC, b.vec_id)::INTEGER AS rank
    FROM e a JOIN e b ON a.label <> b.label AND a.vec_id % 20 = 0) WHERE rank <= 3""")
def similar_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is most similar to the asked words among words of other lemmas (labels)."""
    e = _vectors(spark, sf_dir)
    s = V.scored(e.where("vec_id % 20 = 0"), e, "vec_id", "vec_id", "v").withColumn("score", F.round("score", 6))
    kind = e.select("vec_id", "label")
    s = s.join(kind.select(F.col("vec_id").alias("query"), F.col("label").alias("lq")), "query").join(kind.select(F.col("vec_id").alias("item"), "label"), "item")
    return selection.top_by(s.where("lq != label").select("query", "item", "score"), ["query"], [F.col("score").desc(), "item"], 3)


@query("SELECT unnest(['items', 'k', 'maxRounds', 'similarity']) AS name, unnest([count(*)::VARCHAR, '50', ceil(log2(count(*)))::INTEGER::VARCHAR, 'COSINE']) AS value FROM embeddings")
def committee_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parameters for clustering by committee, from the number of items."""
    e = _vectors(spark, sf_dir)
    p = S.committee_parameters(e.count(), e.select("label").distinct().count())
    return spark.createDataFrame([(k, p[k]) for k in ("items", "k", "maxRounds", "similarity")], "name string, value string")


@query("""WITH t AS (SELECT unnest(string_split_regex(lower(text), '[^a-z0-9]+')) AS form FROM documents), f AS (SELECT form, count(*) AS n FROM t WHERE form <> '' GROUP BY 1),
    l AS (SELECT form, n, CASE WHEN length(form) > 6 AND regexp_matches(form, '(ing|tion|ed)$') THEN regexp_replace(form, '(ing|tion|ed)$', '') ELSE form END AS lemma FROM f)
    SELECT lemma, count(*) AS forms, sum(n)::BIGINT AS n FROM l GROUP BY 1 HAVING count(*) > 1""")
def lemma_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forms and occurrences of lemmas, by a table of forms; a form that the table lacks is its own lemma."""
    t = table(spark, sf_dir, "documents").select(F.explode(X.tokens(F.col("text"))).alias("form")).where("form != ''")
    counts = t.groupBy("form").agg(F.count("*").alias("n"))
    stem = F.regexp_replace("form", "(ing|tion|ed)$", "")
    lemmas = counts.where((F.length("form") > 6) & F.col("form").rlike("(ing|tion|ed)$")).select("form", stem.alias("lemma"))
    by = counts.join(lemmas, "form", "left").withColumn("lemma", F.coalesce("lemma", "form"))
    return by.groupBy("lemma").agg(F.count("*").alias("forms"), F.sum("n").alias("n")).where("forms > 1")


@query("""SELECT concat(event_id, '-', user_id, '-', t) AS segment, replace(t, '_', ' ') AS text FROM (SELECT event_id, user_id, regexp_replace(lower(concat(event_type, '_', regexp_replace(props, '[^A-Za-z0-9]', '', 'g'))), '_+$', '') AS t FROM events)""")
def retrieval_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A segment for each event mention, for the index of a retrieval engine."""
    e = table(spark, sf_dir, "events").withColumn("words", F.concat(F.initcap("event_type"), F.lit(" "), F.regexp_replace("props", " ", "")))
    return S.segments(e, "event_id", "user_id", "words")


@query("""SELECT query, segment, score, rank FROM (SELECT l_suppkey AS query, s AS segment, score, row_number() OVER (PARTITION BY l_suppkey ORDER BY score DESC, s)::INTEGER AS rank FROM (
    SELECT l_suppkey, l_orderkey * 10 + l_linenumber AS s, max(l_extendedprice) AS score FROM lineitem GROUP BY ALL)) WHERE rank <= 20""")
def retrieval_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best segments of each query from a list of results."""
    r = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("query"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("segment")).agg(F.max("l_extendedprice").alias("score"))
    return S.result_lists(r, 20)


@query("""WITH e AS (SELECT event_id, event_type, user_id % 5 AS place, ['even', 'odd'][user_id % 2 + 1] AS who, value > 50 AS big, ts FROM events)
    SELECT 1 AS id, event_id AS event FROM e WHERE event_type IN ('purchase', 'click') AND place IN (1, 2) UNION ALL SELECT 2, event_id FROM e WHERE who = 'odd' AND big UNION ALL SELECT 3, event_id FROM e WHERE event_type = 'error' AND ts >= TIMESTAMP '2024-01-05 00:00:00'""")
def factor_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that meet a nested query of causal factors."""
    from datetime import datetime

    rows = [((1, ["purchase", "click"], ["1", "2"], None, None, None),), ((2, None, [], ["odd", "big"], None, None),), ((3, ["error"], None, None, datetime(2024, 1, 5), None),)]
    factors = spark.createDataFrame(rows, f"factor {S.FACTOR}")
    e = table(spark, sf_dir, "events")
    who = F.when(F.col("user_id") % 2 == 0, "even").otherwise("odd")
    e = e.select(F.col("event_id").alias("event"), F.col("event_type").alias("type"), (F.col("user_id") % 5).cast("string").alias("place"), F.array_compact(F.array(who, F.when(F.col("value") > 50, "big"))).alias("participants"), F.col("ts").cast("timestamp").alias("at"))
    return S.match_factors(factors, e).select(F.col("id").cast("int").alias("id"), "event")


@query("""SELECT feature, value, count(*) AS n FROM (SELECT unnest(['type', 'type_prefix', 'magnitude', 'actor_group', 'hour']) AS feature,
    unnest([event_type, event_type[1:2], CASE WHEN value > 80 THEN 'high' WHEN value < 20 THEN 'low' END, (user_id % 10)::VARCHAR, hour(ts)::VARCHAR]) AS value FROM events) WHERE value IS NOT NULL GROUP BY ALL""")
def registered_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All registered features of event mentions, counted."""
    return S.features(table(spark, sf_dir, "events"), ["event_id"], list(S.FEATURES)).groupBy("feature", "value").agg(F.count("*").alias("n"))


@query("SELECT worker, count(*) AS n, sum(n_chars)::BIGINT AS chars FROM (SELECT n_chars, ((row_number() OVER (ORDER BY n_chars DESC, doc_id) - 1) % 8)::INTEGER AS worker FROM documents) GROUP BY 1")
def worker_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents dealt to eight workers, long ones first, each worker in turn."""
    d = table(spark, sf_dir, "documents").withColumn("minus", -F.col("n_chars"))
    dealt = selection.numbered(d.select("minus", "doc_id", "n_chars"), ["minus", "doc_id"], "i").withColumn("worker", (F.col("i") % 8).cast("int"))
    return dealt.groupBy("worker").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


@query("SELECT source, count(*) AS delivered, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY 1")
def delivered_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivered documents as a stream, polled until all are seen, counted by source."""
    d = minibatch.run_once(spark, f"{sf_dir}/documents.parquet", ["doc_id"])
    return d.groupBy("source").agg(F.count("*").alias("delivered"), F.sum("n_chars").alias("chars"))


_B = _E + ", b AS (SELECT vec_id, k AS band, array_to_string(list_transform(v[k * 8 + 1 : k * 8 + 8], lambda x: CASE WHEN x >= 0 THEN '1' ELSE '0' END), '') AS value FROM e, (SELECT unnest(range(0, 4))::INTEGER AS k))"


@query(_B + """, c AS (SELECT a.vec_id AS q, count(DISTINCT b.vec_id) AS n FROM b a JOIN b ON a.band = b.band AND a.value = b.value AND a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0 GROUP BY 1)
    SELECT count(*) AS queries, round(1 - sum(coalesce(n, 0)) / (count(*) * ((SELECT count(*) FROM e) - 1)), 6) AS savings FROM (SELECT vec_id FROM e WHERE vec_id % 20 = 0) LEFT JOIN c ON q = vec_id""")
def index_savings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of comparisons that an inverted index of sign bits saves, over every twentieth vector as a query."""
    return S.index_savings(_vectors(spark, sf_dir), F.col("vec_id") % 20 == 0, "vec_id", "v", 4, 8)
