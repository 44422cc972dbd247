"""Serialised forms and streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from factloom.operators import graph
from factloom.plans.graph_queries import triples
from factloom.plans.registry import query
from factloom.sources import sinks, sites
from factloom.sources.tables import table
from factloom.streaming import minibatch


@query("""
    SELECT p, count(*) AS n, min(s) AS first_s, max(o) AS last_o FROM (
      SELECT concat('nation/', n_nationkey) AS s, unnest(['type', 'name', 'part_of']) AS p, unnest(['nation', n_name, concat('region/', n_regionkey)]) AS o FROM nation
      UNION ALL SELECT concat('supplier/', s_suppkey), unnest(['type', 'name', 'located_in']), unnest(['supplier', s_name, concat('nation/', s_nationkey)]) FROM supplier) GROUP BY p
""")
def triples_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = triples(spark, sf_dir, "nation", "supplier")
    return t.groupBy("p").agg(F.count("*").alias("n"), F.min("s").alias("first_s"), F.max("o").alias("last_o"))


@query("SELECT p, count(*) AS n, min(line) AS first_line FROM (SELECT 'name' AS p, concat('<urn:nation/', n_nationkey, '> <urn:name> \"', n_name, '\" .') AS line FROM nation) GROUP BY p")
def ntriples_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = triples(spark, sf_dir, "nation").where("p = 'name'")
    return t.select("p", sinks.ntriples_line("urn:").alias("line")).groupBy("p").agg(F.count("*").alias("n"), F.min("line").alias("first_line"))


@query("SELECT doc_id, n_extractions, lo, hi FROM (SELECT l_orderkey AS doc_id, count(*) AS n_extractions, min(l_linenumber) AS lo, max(l_linenumber) AS hi FROM lineitem GROUP BY 1)")
def jsonld_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON-LD object for each document, read back and summed up."""
    l = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.struct("l_linenumber", "l_returnflag").alias("event"))
    j = sinks.jsonld(l, "doc_id", "event")
    back = j.select("doc_id", F.from_json("document", "extractions ARRAY<STRUCT<l_linenumber: INT, l_returnflag: STRING>>").alias("d"))
    n = F.col("d.extractions.l_linenumber")
    return back.select("doc_id", F.size("d.extractions").cast("long").alias("n_extractions"), F.array_min(n).alias("lo"), F.array_max(n).alias("hi"))


@query("SELECT concat(l_orderkey, '#', CASE l_returnflag WHEN 'A' THEN 'causation' WHEN 'N' THEN 'precondition' ELSE 'other' END, '#', l_suppkey) AS relation_id, count(*) AS n, min(l_linenumber) AS span_start, max(l_linenumber) AS span_end FROM lineitem GROUP BY 1")
def eer_tabular(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each relation with its covering span."""
    kind = F.when(F.col("l_returnflag") == "A", "causation").when(F.col("l_returnflag") == "N", "precondition").otherwise("other")
    l = table(spark, sf_dir, "lineitem").select(sinks.relation_id(F.col("l_orderkey"), kind, F.col("l_suppkey")).alias("relation_id"), "l_linenumber")
    return l.groupBy("relation_id").agg(F.count("*").alias("n"), F.min("l_linenumber").alias("span_start"), F.max("l_linenumber").alias("span_end"))


@query("SELECT concat('supplier/', s_suppkey) AS s FROM supplier WHERE s_nationkey % 2 = 1")
def domain_range_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Triples whose object is not of a class that the predicate allows."""
    t = triples(spark, sf_dir, "supplier", "nation")
    places = table(spark, sf_dir, "nation").where("n_nationkey % 2 = 0").select(F.concat(F.lit("nation/"), "n_nationkey").alias("o"))
    return graph.pattern(t, "?s", "located_in", "?o").join(places, "o", "left_anti").select("s")


@query("SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1 GROUP BY 1")
def message_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last message of each key counts; messages that were processed are skipped."""
    e = minibatch.pool(table(spark, sf_dir, "events"), ["user_id", "event_type"], ["ts", "event_id"], None)
    return e.groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1")
def stream_minibatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events read as a stream, in mini-batches, into an idempotent table; the result equals the batch result."""
    return minibatch.run_once(spark, f"{sf_dir}/events.parquet", ["event_id"]).groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("SELECT window_start, event_type, n FROM (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL)")
def stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly counts of a stream with a watermark, run until the input is used up."""
    return minibatch.window_counts(spark, f"{sf_dir}/events.parquet", "ts", "1 hour", ["event_type"])


@query("SELECT page_id, regexp_extract(url, '([^/?#.]+[.][^/?#.]+)(?:[/?#]|$)', 1) AS host, regexp_extract(html, '<h1>([^<&]*)</h1>', 1) AS title FROM pages WHERE regexp_matches(html, '<h1>[^<&]*[^<& ]</h1>') AND regexp_matches(url, '^[a-z]+://[^/?#]*example[.](com|org)([/?#]|$)') AND NOT regexp_matches(html, '<h1> |  [^>]*</h1>')")
def site_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of known sites by their rules; others are skipped."""
    known = {"example.com": sites.Site(), "example.org": sites.Site(body="article", skip=("nav", "footer", "div.ad"))}
    p = table(spark, sf_dir, "pages").where("html rlike '<h1>[^<&]*[^<& ]</h1>' AND NOT html rlike '<h1> |  [^>]*</h1>'")
    return sites.extract(p, known).select("page_id", "host", "title")
