"""Sources and documents: genre, clean-up, chunks, deduplication, caches, crawls, keyword candidates, span joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from factloom.functions import text as X
from factloom.operators import selection, spans
from factloom.plans.registry import query
from factloom.sources import documents as docs_source
from factloom.sources.tables import table


@query("SELECT doc_id, CASE WHEN text IS NULL THEN false WHEN source = 'src0' THEN false ELSE length(text) < 5000 END AS is_news FROM documents")
def doc_genre(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", X.genre_is_news(F.col("text"), F.col("source") == "src0", F.lit(None).cast("int"), 5000).alias("is_news"))


@query("""SELECT doc_id, regexp_replace(text, '[<>\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]', ' ', 'g') AS scrubbed, regexp_replace(text, '[\\r\\n\\t]', ' ', 'g') AS cleaned FROM documents""")
def doc_scrub(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", X.scrub(F.col("text")).alias("scrubbed"), X.clean(F.col("text")).alias("cleaned"))


@query("""SELECT doc_id, array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> ''), chr(10)) AS stripped FROM documents""")
def doc_strip_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", X.strip_lines(F.col("text")).alias("stripped"))


@query()
def doc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks that break after a sentence once the target length is passed; held against brute force in the tests."""
    return docs_source.chunks(table(spark, sf_dir, "documents"), 3000)


@query("""
    WITH n AS (SELECT doc_id, text, length(text) AS len, greatest(1, ceil(length(text) / 1000.0))::BIGINT AS k FROM documents WHERE text IS NOT NULL),
         t AS (SELECT *, ceil(len / k::DOUBLE)::BIGINT AS size FROM n),
         c AS (SELECT doc_id, unnest(range(0, k)) AS idx, size, len, k FROM t)
    SELECT doc_id, idx, least(len, (idx + 1) * size) - least(len, idx * size) AS n_chars, least(len, idx * size) AS char_offset, concat('doc_', doc_id, '_', idx) AS chunk_id FROM c
""")
def doc_chunks_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of equal length with ids and running offsets."""
    d = table(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", F.length("text").cast("long").alias("len"))
    d = d.withColumn("k", F.greatest(F.lit(1), F.ceil(F.col("len") / 1000.0)).cast("long"))
    d = d.withColumn("size", F.ceil(F.col("len") / F.col("k")).cast("long"))
    d = d.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("k") - 1)).alias("idx"))
    at = F.least("len", F.col("idx") * F.col("size"))
    return d.select("doc_id", "idx", (F.least("len", (F.col("idx") + 1) * F.col("size")) - at).alias("n_chars"), at.alias("char_offset"), F.concat(F.lit("doc_"), "doc_id", F.lit("_"), "idx").alias("chunk_id"))


@query("SELECT md5(text) AS text_md5, min(doc_id) AS doc_id, count(*) AS n_copies FROM documents GROUP BY 1")
def doc_dedup_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy(F.md5("text").alias("text_md5")).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n_copies"))


@query("SELECT doc_id, lang, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def cache_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "lang", "source").join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_anti")


@query("""
    SELECT doc_id, 'run' AS origin, quality AS value FROM labels WHERE quality = 1
    UNION ALL SELECT doc_id, 'cache', 0 FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)
""")
def cache_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id", F.lit("run").alias("origin"), F.col("quality").alias("value"))
    cache = table(spark, sf_dir, "documents").select("doc_id", F.lit("cache").alias("origin"), F.lit(0).alias("value"))
    return selection.prefer(run, cache, "doc_id")


@query("""
    SELECT user_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY pri DESC, ts DESC, event_id DESC) AS r
      FROM (SELECT *, CASE WHEN event_type IN ('purchase', 'signup') THEN 1 ELSE 0 END AS pri FROM events)) WHERE r = 1
""")
def last_writer_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("pri", F.when(F.col("event_type").isin("purchase", "signup"), 1).otherwise(0))
    return selection.first_by(e, ["user_id"], [F.col("pri").desc(), F.col("ts").desc(), F.col("event_id").desc()]).select("user_id", "event_type", "value")


@query("SELECT regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host, count(*) AS n_pages, min(page_id) AS first_page, sum(length(html))::BIGINT AS n_chars FROM pages GROUP BY 1")
def crawl_group_by_host(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages").select(F.regexp_extract("url", "^[a-z]+://([^/?#]+)", 1).alias("host"), "page_id", F.length("html").cast("long").alias("n"))
    return p.groupBy("host").agg(F.count("*").alias("n_pages"), F.min("page_id").alias("first_page"), F.sum("n").alias("n_chars"))


@query("SELECT page_id, concat(regexp_extract(url, '^[a-z]+://([^/?#]+)', 1), '_', page_id) AS doc_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, regexp_extract(html, 'lang=\"([a-z]+)\"', 1) AS lang FROM pages")
def html_title_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    host = F.regexp_extract("url", "^[a-z]+://([^/?#]+)", 1)
    return p.select("page_id", F.concat_ws("_", host, "page_id").alias("doc_id"), F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), F.regexp_extract("html", 'lang="([a-z]+)"', 1).alias("lang"))


@query("""
    SELECT doc_id, t AS trigger, count(*) AS n FROM (SELECT doc_id, unnest(string_split_regex(lower(text), '[^a-z0-9]+')) AS t FROM documents WHERE lang = 'en')
    WHERE length(t) >= 5 AND t NOT IN ('there', 'these', 'those', 'which') GROUP BY ALL
""")
def trigger_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate triggers of each document: long words that no filter list has."""
    d = table(spark, sf_dir, "documents").where("lang = 'en'")
    t = d.select("doc_id", F.explode(X.tokens(F.col("text"))).alias("trigger")).where((F.length("trigger") >= 5) & ~F.col("trigger").isin("there", "these", "those", "which"))
    return t.groupBy("doc_id", "trigger").agg(F.count("*").alias("n"))


_SPANS = """
    WITH s AS (SELECT event_id, user_id, floor(epoch(ts))::BIGINT AS a, floor(epoch(ts))::BIGINT + (value * 20)::BIGINT AS b, event_type FROM events)
"""


def _event_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    at = F.unix_seconds(F.col("ts").cast("timestamp"))
    return e.select("event_id", "user_id", "event_type", at.alias("a"), (at + F.round(F.col("value") * 20).cast("long")).alias("b"))


@query(_SPANS + """
    SELECT x.user_id, x.event_id, y.event_id AS other_id FROM s x JOIN s y ON x.user_id = y.user_id AND x.a <= y.b AND y.a <= x.b
    WHERE x.event_type = 'purchase' AND y.event_type = 'error'
""")
def span_overlap_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _event_spans(spark, sf_dir)
    x = s.where("event_type = 'purchase'").drop("event_type")
    y = s.where("event_type = 'error'").select("user_id", F.col("event_id").alias("other_id"), F.col("a").alias("c"), F.col("b").alias("d"))
    return spans.overlap_join(x, y, ["user_id"], 4000, ("a", "b"), ("c", "d")).select("user_id", "event_id", "other_id")


@query("""
    SELECT o_orderkey, l_linenumber FROM orders JOIN lineitem ON l_orderkey = o_orderkey
    WHERE o_orderdate <= l_shipdate AND l_shipdate <= o_orderdate + INTERVAL 30 DAY
""")
def span_containment_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, l = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    both = o.select("o_orderkey", "o_orderdate").join(l.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_shipdate"), "o_orderkey")
    end = F.col("o_orderdate") + F.expr("INTERVAL 30 DAY")
    return both.where(spans.contains(F.col("o_orderdate"), end, F.col("l_shipdate"), F.col("l_shipdate"))).select("o_orderkey", "l_linenumber")


@query(_SPANS + "SELECT x.event_id, y.event_id AS other_id FROM s x JOIN s y ON x.user_id = y.user_id AND x.a = y.a AND x.event_id < y.event_id")
def exact_span_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _event_spans(spark, sf_dir).select("event_id", "user_id", "a")
    return s.join(s.withColumnRenamed("event_id", "other_id"), ["user_id", "a"]).where("event_id < other_id").select("event_id", "other_id")


@query("""
    SELECT doc_id, sent, start_char, start_char + length(s) - 1 AS end_char, regexp_replace(s, '(?i)([a-z]+ion)', '[[\\1]]') AS marked
    FROM (SELECT doc_id, sent, s, coalesce(sum(length(s) + 1) OVER (PARTITION BY doc_id ORDER BY sent ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start_char
      FROM (SELECT doc_id, unnest(range(0, len(p))) AS sent, unnest(p) AS s FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents WHERE lang = 'en')))
""")
def sentence_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with their offsets, and the first word in -ion marked up."""
    d = table(spark, sf_dir, "documents").where("lang = 'en'")
    s = docs_source.sentences(d)
    end = F.col("start_char") + F.length("s") - 1
    return s.select("doc_id", "sent", "start_char", end.alias("end_char"), docs_source.mark_first(F.col("s"), "(?i)[a-z]+ion").alias("marked"))


@query("""
    SELECT part, count(*) AS n, min(doc_id) AS lo, max(doc_id) AS hi FROM (
      SELECT doc_id, CASE WHEN i < e * (s + 1) THEN i // (s + 1) ELSE e + (i - e * (s + 1)) // s END::INTEGER AS part
      FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i, count(*) OVER () // 7 AS s, count(*) OVER () % 7 AS e FROM documents)) GROUP BY part
""")
def balanced_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contiguous batches whose sizes differ by one at most."""
    parts = selection.balanced(table(spark, sf_dir, "documents").select("doc_id"), ["doc_id"], 7)
    return parts.groupBy("part").agg(F.count("*").alias("n"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))


@query("""
    SELECT s_suppkey, coalesce(link, longest) AS canonical_name FROM (
      SELECT s_suppkey, CASE WHEN s_acctbal > 5000 THEN s_name END AS link FROM supplier) JOIN (
      SELECT s_suppkey, p_name AS longest FROM (SELECT l_suppkey AS s_suppkey, p_name, row_number() OVER (PARTITION BY l_suppkey ORDER BY length(p_name) DESC, p_name) AS r
        FROM lineitem JOIN part ON l_partkey = p_partkey) WHERE r = 1) USING (s_suppkey)
""")
def canonical_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The linked name of an entity, else the longest name among its mentions."""
    mentions = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("s_suppkey"), F.col("l_partkey").alias("p_partkey")).join(table(spark, sf_dir, "part"), "p_partkey")
    longest = mentions.groupBy("s_suppkey").agg(F.min_by("p_name", F.struct(-F.length("p_name"), F.col("p_name"))).alias("longest"))
    s = table(spark, sf_dir, "supplier").select("s_suppkey", F.when(F.col("s_acctbal") > 5000, F.col("s_name")).alias("link"))
    return s.join(longest, "s_suppkey").select("s_suppkey", F.coalesce("link", "longest").alias("canonical_name"))
