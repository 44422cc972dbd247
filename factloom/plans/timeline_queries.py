"""Timelines: event counts in buckets of time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from factloom.operators import metrics, selection
from factloom.plans.registry import query
from factloom.sources.tables import table


@query("""
    SELECT event_type, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, count(*) AS n
    FROM events GROUP BY ALL
""")
def timeline_type_year_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("event_type", F.year("ts").alias("year"), F.month("ts").alias("month")).agg(F.count("*").alias("n"))


@query("""
    SELECT o_orderkey, l_linenumber FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE year(o_orderdate) >= 1995 AND year(o_orderdate) < 1998
      AND floor(epoch(l_shipdate))::BIGINT - floor(epoch(o_orderdate))::BIGINT BETWEEN 0 AND 31 * 86400 AND o_orderpriority <> '4-NOT SPECIFIED'
""")
def timeline_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a valid time in the years asked for, of at most 31 days, that are not generic."""
    o = table(spark, sf_dir, "orders").where("o_orderdate >= TIMESTAMP_NTZ'1995-01-01' AND o_orderdate < TIMESTAMP_NTZ'1998-01-01' AND o_orderpriority <> '4-NOT SPECIFIED'")
    both = o.select("o_orderkey", "o_orderdate").join(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_shipdate"), "o_orderkey")
    days = F.unix_seconds(F.col("l_shipdate").cast("timestamp")) - F.unix_seconds(F.col("o_orderdate").cast("timestamp"))
    return both.where(days.between(0, 31 * 86400)).select("o_orderkey", "l_linenumber")


@query("SELECT event_type, year, month, sum(n)::BIGINT AS n FROM (SELECT event_type, year(ts)::INTEGER AS year, month(ts)::INTEGER AS month, 1 AS n FROM events) GROUP BY CUBE (event_type, year, month)")
def timeline_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_type", F.year("ts").alias("year"), F.month("ts").alias("month"))
    return e.cube("event_type", "year", "month").agg(F.count("*").alias("n"))


@query("""
    SELECT day, event_type, n, rank FROM (SELECT *, row_number() OVER (PARTITION BY day ORDER BY n DESC, event_type)::INTEGER AS rank FROM (SELECT ts::DATE AS day, event_type, count(*) AS n FROM events GROUP BY ALL)) WHERE rank <= 3
""")
def daily_top_triggers(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count("*").alias("n"))
    return selection.top_by(n, ["day"], [F.col("n").desc(), "event_type"], 3).select("day", "event_type", "n", "rank")


@query("""
    WITH c AS (SELECT ts::DATE AS day, user_id % 10 AS label, count(*) AS n FROM events GROUP BY ALL), m AS (SELECT label, avg(embedding[1]::DOUBLE) AS a, avg(embedding[2]::DOUBLE) AS b FROM embeddings GROUP BY 1)
    SELECT day, round(sum(n * a), 6) AS d1, round(sum(n * b), 6) AS d2 FROM c JOIN m ON m.label = c.label GROUP BY 1
""")
def daily_embedding_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sum of the triggers' vectors by day, weighted by their counts (two dimensions shown)."""
    c = table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("day"), (F.col("user_id") % 10).cast("int").alias("label")).agg(F.count("*").alias("n"))
    v = F.col("embedding").cast("array<double>")
    m = table(spark, sf_dir, "embeddings").groupBy("label").agg(F.avg(v[0]).alias("a"), F.avg(v[1]).alias("b"))
    return c.join(m, "label").groupBy("day").agg(F.round(F.sum(F.col("n") * F.col("a")), 6).alias("d1"), F.round(F.sum(F.col("n") * F.col("b")), 6).alias("d2"))


@query("""
    SELECT o_orderstatus AS relation, count(*) AS n, count(*) FILTER (l AND r) AS both_ends, count(*) FILTER (l <> r) AS one_end, count(*) FILTER (NOT l AND NOT r) AS no_end
    FROM (SELECT o_orderstatus, o_totalprice > 150000 AS l, o_custkey % 3 = 0 AS r FROM orders) GROUP BY 1
""")
def grounded_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relations by how many of their ends are grounded."""
    l, r = F.col("o_totalprice") > 150000, F.col("o_custkey") % 3 == 0
    return table(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("relation")).agg(F.count("*").alias("n"), F.count_if(l & r).alias("both_ends"), F.count_if(l != r).alias("one_end"), F.count_if(~l & ~r).alias("no_end"))


@query("SELECT a.event_type AS l, b.event_type AS r, count(*) AS n, count(DISTINCT a.user_id) AS n_actors FROM events a JOIN events b ON a.user_id = b.user_id AND a.ts::DATE = b.ts::DATE AND a.event_id < b.event_id GROUP BY ALL")
def causal_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type pairs of an actor's events of one day."""
    e = table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("day"), "event_id", "event_type")
    b = e.select("user_id", "day", F.col("event_id").alias("other"), F.col("event_type").alias("r"))
    return e.join(b, ["user_id", "day"]).where("event_id < other").groupBy(F.col("event_type").alias("l"), "r").agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("n_actors"))


@query("""
    SELECT t AS threshold, count(*) FILTER (n >= t) AS n_sentences FROM (SELECT length(s) - length(replace(s, ' ', '')) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS s FROM documents)), (SELECT unnest(range(0, 100, 10)) AS t) GROUP BY 1
""")
def token_count_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each threshold the sentences that have so many tokens at least, from one histogram of ten-token bins."""
    s = table(spark, sf_dir, "documents").select(F.explode(F.split("text", "\n")).alias("s"))
    n = s.select((F.length("s") - F.length(F.replace("s", F.lit(" "), F.lit("")))).alias("n"))
    bins = n.groupBy(F.least(F.floor(F.col("n") / 10) * 10, F.lit(90)).alias("bin")).agg(F.count("*").alias("c"))
    steps = F.explode(F.sequence(F.lit(0).cast("long"), F.col("bin"), F.lit(10).cast("long")))
    return bins.select(steps.alias("threshold"), "c").groupBy("threshold").agg(F.sum("c").alias("n_sentences"))


@query("""
    SELECT item, label, n_votes, n_voters FROM (SELECT conv_id AS item, role AS label, count(DISTINCT turn) AS n_votes FROM conversations GROUP BY ALL) JOIN (SELECT conv_id AS item, count(DISTINCT turn) AS n_voters FROM conversations GROUP BY 1) USING (item) WHERE n_votes > 0.5 * n_voters
""")
def majority_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("item"), F.col("role").alias("label"), "turn")
    return selection.majority(c, ["item"], "label", "turn").select("item", "label", "n_votes", "n_voters")


@query("SELECT label, count(*) AS n FROM (SELECT doc_id, CASE WHEN quality = 0 AND toxic = 0 THEN 'NA' WHEN toxic = 1 THEN 'toxic' ELSE 'good' END AS label FROM labels) GROUP BY 1")
def all_negative_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when((F.col("quality") == 0) & (F.col("toxic") == 0), "NA").when(F.col("toxic") == 1, "toxic").otherwise("good")
    return table(spark, sf_dir, "labels").groupBy(label.alias("label")).agg(F.count("*").alias("n"))


@query("""
    WITH x AS (SELECT o_custkey, list(DISTINCT o_orderpriority) AS g, list(DISTINCT o_orderpriority) FILTER (o_orderstatus <> 'F') AS p FROM orders GROUP BY 1),
    y AS (SELECT len(g)::DOUBLE AS ng, coalesce(len(p), 0)::DOUBLE AS np, coalesce(len(list_intersect(g, p)), 0)::DOUBLE AS b FROM x)
    SELECT round(avg(CASE WHEN b = ng AND b = np THEN 1.0 ELSE 0.0 END), 6) AS strict, round(avg(CASE WHEN np = 0 THEN 0 ELSE b / np END), 6) AS macro_p, round(avg(b / ng), 6) AS macro_r, round(sum(b) / sum(np), 6) AS micro_p, round(sum(b) / sum(ng), 6) AS micro_r FROM y
""")
def typing_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_set("o_orderpriority").alias("g"), F.collect_set(F.when(F.col("o_orderstatus") != "F", F.col("o_orderpriority"))).alias("p"))
    m = metrics.typing_scores(o, "g", "p")
    return m.select(*[F.round(c, 6).alias(c) for c in ("strict", "macro_p", "macro_r", "micro_p", "micro_r")])


@query("SELECT round(avg(floor(epoch(l_shipdate)) - floor(epoch(o_orderdate))) / 86400, 4) AS mean_days, count(*) AS n FROM orders JOIN lineitem ON l_orderkey = o_orderkey")
def job_runtime_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = lambda c: F.unix_seconds(F.col(c).cast("timestamp"))
    both = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate"), "o_orderkey")
    return both.agg(F.round(F.avg(s("l_shipdate") - s("o_orderdate")) / 86400, 4).alias("mean_days"), F.count("*").alias("n"))


@query("SELECT trigger, types, n FROM (SELECT o_orderpriority AS trigger, array_to_string(list_sort(list(DISTINCT o_orderstatus)), '|') AS types, count(*) AS n FROM orders GROUP BY 1)")
def frequent_triggers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("trigger")).agg(F.array_join(F.array_sort(F.collect_set("o_orderstatus")), "|").alias("types"), F.count("*").alias("n"))
