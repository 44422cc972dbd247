"""Metric learning, pairs and mention operators without a SQL oracle."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from factloom.operators import learning, mentions


def test_weights_separate_classes(spark):
    rng = np.random.default_rng(0)
    x = rng.random((600, 2))
    y = (x[:, 0] + 0.1 * rng.normal(size=600) > 0.5).astype(float)
    w = learning.fit_weights(x, y)
    assert w[1] > 1 and (w[1:] >= 0).all()
    df = spark.createDataFrame([(float(a), float(b)) for a, b in x[:50]], "a double, b double")
    got = [r.p > 0.5 for r in df.select(learning.weighted_score([F.col("a"), F.col("b")], w).alias("p")).collect()]
    assert np.mean(np.array(got) == (y[:50] > 0.5)) > 0.85


def test_sampled_pairs_grow_with_items(spark):
    for n in (1000, 4000):
        df = spark.range(n).select("id", (F.col("id") % 10).alias("g"))
        rows = learning.sampled_pairs(df, "id", "g", 3, buckets=4).collect()
        assert 3 * n - 4 * 6 <= len(rows) <= 3 * n and all(r.a != r.b for r in rows)
        assert len({frozenset((r.a, r.b)) for r in rows}) == len(rows)
        assert all(r.same == (r.a % 10 == r.b % 10) for r in rows)


@pytest.mark.parametrize("outer, inner, want", [("2019", "2019-02", True), ("2019-02", "2019-02-03", True), ("2019-02", "2019", False), ("2019-0", "2019-02", False), ("2019", "2019", True)])
def test_time_contains(spark, outer, inner, want):
    assert spark.range(1).select(mentions.time_contains(F.lit(outer), F.lit(inner)).alias("x")).first().x is want


def test_drop_covered_equals_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = [(int(k % 2), k, int(s), int(s + d)) for k, (s, d) in enumerate(zip(rng.integers(0, 30, 40), rng.integers(0, 9, 40)))]
    df = spark.createDataFrame(rows, "g int, id int, s int, e int")
    got = {r.id for r in mentions.drop_covered(df, ["g"], "s", "e", "id").collect()}
    want = {i for g, i, s, e in rows if not any(h == g and j != i and t <= s and f >= e and (t < s or f > e or j < i) for h, j, t, f in rows)}
    assert got == want


def test_templates_skip_ends(spark):
    df = spark.createDataFrame([(1, k, w) for k, w in enumerate("abc")], "d int, k int, w string")
    got = {r.feature for r in learning.templates(df, "d", "k", {"w": F.col("w")}, [(("w", -1), ("w", 1))]).collect()}
    assert got == {"w[-1]|w[1]=a|c"}
