"""Translation tables and messages."""

from collections import defaultdict

from pyspark.sql import functions as F

from factloom.operators import retrieval
from factloom.sources import kafka


def plain_em(pairs, rounds):
    p = {(s, t): 1.0 for a, b in pairs for s in a for t in b}
    for _ in range(rounds):
        c, m = defaultdict(float), defaultdict(float)
        for a, b in pairs:
            for t in b:
                z = sum(p[s, t] for s in set(a))
                for s in set(a):
                    c[s, t] += a.count(s) * p[s, t] / z
        for (s, t), v in c.items():
            m[s] += v
        p = {(s, t): v / m[s] for (s, t), v in c.items()}
    return p


def test_translation_equals_plain_version(spark):
    pairs = [(["the", "house"], ["la", "casa"]), (["the", "book"], ["el", "libro"]), (["a", "book"], ["un", "libro"]), (["house"], ["casa"])]
    got = {(r.s, r.t): r.p for r in retrieval.translation_table(spark.createDataFrame(pairs, "a array<string>, b array<string>"), "a", "b", 4).collect()}
    want = plain_em(pairs, 4)
    assert set(got) <= set(want) and all(abs(got[k] - want[k]) < 1e-9 for k in got)
    assert max((p, t) for (s, t), p in got.items() if s == "book")[1] == "libro"


def test_messages(spark):
    raw = spark.createDataFrame([("d1", '{"ontologies": [{"ontology": "a"}, {"ontology": "b"}]}'), ("d2", "no json"), (None, '{"ontologies": [{"ontology": "a"}]}')], "key string, value string")
    raw = raw.select(F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"), F.current_timestamp().alias("timestamp"))
    assert sorted((r.doc_id, r.ontology) for r in kafka.parse(raw).collect()) == [("d1", "a"), ("d1", "b")]
