"""Golden values and invariants of functions and operators that have no SQL oracle."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from factloom.functions import money, scores, text as X, time as times
from factloom.operators import clustering, consolidation, graph, grounding, metrics, resolvers, selection, spans, vectors
from factloom.sources import documents as D, sinks
from factloom.streaming import minibatch


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


@pytest.mark.parametrize(
    "value, start, end",
    [
        ("2019", "2019-01-01 00:00:00", "2019-12-31 23:59:59"),
        ("2019-02", "2019-02-01 00:00:00", "2019-02-28 23:59:59"),
        ("2020-02-29", "2020-02-29 00:00:00", "2020-02-29 23:59:59"),
        ("2020-Q3", "2020-07-01 00:00:00", "2020-09-30 23:59:59"),
        ("2020-H2", "2020-07-01 00:00:00", "2020-12-31 23:59:59"),
        ("2019-WI", "2019-12-01 00:00:00", "2020-02-28 23:59:59"),
        ("2020-W01", "2019-12-30 00:00:00", "2020-01-05 23:59:59"),
        ("2019-SU", "2019-06-01 00:00:00", "2019-08-31 23:59:59"),
        ("2019-05-06TMO", "2019-05-06 06:00:00", "2019-05-06 11:59:59"),
    ],
)
def test_times(spark, value, start, end):
    r = one(spark, times.normalise(F.lit(value)).alias("i")).i
    assert (str(r.start), str(r.end)) == (start, end)


@pytest.mark.parametrize("value", ["PAST_REF", "", "0999", "2101", "2019-13", "2019-02-30", "x2019", None])
def test_times_without_interval(spark, value):
    assert one(spark, times.normalise(F.lit(value).cast("string")).alias("i")).i is None


def test_months(spark):
    assert one(spark, times.month_of(F.lit("2019-02-03")).alias("m")).m == "2019-02"


@pytest.mark.parametrize(
    "value, want",
    [
        ("about $5 million", ("USD", 5e6, None, None)), ("over 3,500 dollars", ("USD", 3500.0, 3500.0, None)), ("up to €2.5bn", ("EUR", 2.5e9, None, 2.5e9)),
        ("20 birr", ("ETB", 20.0, 20.0, 20.0)), ("no money", None),
    ],
)
def test_money(spark, value, want):
    m = one(spark, money.amount(F.lit(value)).alias("m")).m
    assert (None if m is None else tuple(m)) == want


def test_quantities(spark):
    q = lambda s: tuple(one(spark, money.quantity(F.lit(s)).alias("q")).q)
    assert q("rose between 5 and 10 percent per year") == (None, 5.0, 10.0, "Increase", "year")
    assert q("fell by more than 7") == (7.0, 7.0, None, "Decrease", None)


def test_text(spark):
    r = one(
        spark, X.squeeze(F.lit(" a \n b ")).alias("a"), X.trigger_key(F.lit("# Big  Rain")).alias("b"), X.camel_words(F.lit("NaturalHTTPDisaster_type")).alias("c"),
        X.short_shape(F.lit("Abc-12.5,(x)")).alias("d"), X.token_class(F.lit("1999")).alias("e"), X.token_class(F.lit("12")).alias("f"), X.token_class(F.lit(".5")).alias("g"),
        X.strip_lines(F.lit(" a \n\n b")).alias("h"), X.scrub(F.lit("a<b>")).alias("i"), X.is_bad_example(F.lit("x y z"), ["x"]).alias("j"), X.is_short_worded(F.lit("ab cd efgh")).alias("k"),
    )
    assert tuple(r) == ("a b", "big rain", ["natural", "http", "disaster", "type"], "ULUL"[:2] + "-D.D.(L)", "other", "number", "float", "a\nb", "a b ", True, False)


def test_genre(spark):
    f = lambda t, p, n: one(spark, X.genre_is_news(F.lit(t).cast("string"), F.lit(p), F.lit(n).cast("int")).alias("x")).x
    assert [f(None, False, None), f("a", True, None), f("a" * 60_000, False, 0), f("a" * 49_999, False, None), f("a" * 50_000, False, 3)] == [False, False, True, True, False]


def test_scores(spark):
    r = one(
        spark, *[scores.actor_score(F.lit(n)).alias(f"a{n}") for n in (40, 6, 20)], *[scores.tier(F.lit(n)).alias(f"t{n}") for n in (10, 5, 2, 1, 0)],
        scores.argument_score(F.lit(1.0), F.lit("desc"), F.lit(False)).alias("c"), scores.angular_to_cosine(F.lit(1.0)).alias("d"),
        scores.group_similarity(F.lit(0.0), F.lit(1)).alias("g1"), scores.group_similarity(F.lit(3.0), F.lit(3)).alias("g3"), scores.wu_palmer(F.lit(1), F.lit(2), F.lit(3)).alias("w"),
        scores.f1(F.lit(0.0), F.lit(1.0)).alias("f"),
    )
    assert [round(x, 4) for x in r] == [0.95, 0.5, 0.5, 0.7, 0.5, 0.3, 0.2, 0.1, 0.5625, 0.5, 1.0, 0.5, 0.6667, 0.0]


def test_cluster_metrics(spark):
    gold = {"x": 8, "o": 5, "h": 4}
    pred = {1: "x1 x2 x3 x4 x5 o1", 2: "x6 o2 o3 o4 o5 h1", 3: "x7 x8 h2 h3 h4"}
    rows = [(m[0], p) for p, ms in pred.items() for m in ms.split()]
    assert len(rows) == sum(gold.values())
    df = spark.createDataFrame(rows, "g string, p int")
    assert metrics.pairwise_f(df, "g", "p").first().f1 == pytest.approx(0.476190476, abs=1e-3)
    assert metrics.bcubed(df, "g", "p").first().f1 == pytest.approx(0.486437064, abs=1e-3)
    assert metrics.nmi(df, "g", "p").first().nmi == pytest.approx(0.364562, abs=1e-3)


def test_chunks(spark):
    text = "".join(f"Sentence number {k} is here. " for k in range(200))
    parts = D.split_text(text, 1000)
    assert "".join(parts) == text and len(parts) <= -(-len(text) // 1000) and all(p.endswith(".") for p in parts[:-1])
    assert D.split_text("", 10) == [""] and D.split_text("x" * 50, 10) == ["x" * 50]
    rows = D.chunks(spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string"), 1000).orderBy("idx").collect()
    assert [r.chunk for r in rows] == parts and [r.char_offset for r in rows] == [sum(map(len, parts[:k])) for k in range(len(parts))]


def test_readers(spark, tmp_path):
    (tmp_path / "cdr.json").write_text(json.dumps([
        {"document_id": "d1", "extracted_text": "t", "extracted_metadata": {"Author": "A\tB", "CreationDate": "2019-05-01", "Pages": 2}},
        {"document_id": "d2", "extracted_text": "u"}, {"document_id": "d3"},
    ]))
    got = {r.doc_id: (r.author, r.creation_date, r.pages) for r in D.read_cdr(spark, str(tmp_path / "cdr.json")).collect()}
    assert got == {"d1": ("A B", "20190501", 2), "d2": ("UNKNOWN", "UNKNOWN", None)}
    (tmp_path / "m.tsv").write_text("d1\tp\t20190501\t0.5\tnews\ts\tu\t0\ta\thttp://x\nd2\tp\tUNKNOWN\t0.5\tnews\ts\tu\t0\ta\thttp://x\n")
    assert [str(r.creation_date) for r in D.read_metadata(spark, str(tmp_path / "m.tsv")).orderBy("doc_id").collect()] == ["2019-05-01", "None"]
    rel = {"docid": "d1.xml", "relation_type": "Cause-Effect", "connective_text": "Because", "prob": 0.5, "arg1_text": ["a"], "arg1_span_list": [[0, 1]], "arg2_text": ["b"], "arg2_span_list": [[5, 6]]}
    (tmp_path / "c.json").write_text(json.dumps([rel, rel | {"connective_text": "then"}]))
    rows = D.read_causal(spark, str(tmp_path / "c.json")).collect()
    assert [(r.doc_id, r.arg1_text, r.arg1_start, r.arg2_start) for r in rows] == [("d1", "b", 5, 0), ("d1", "a", 0, 5)]
    events = spark.createDataFrame([("d1", 0, 1, "A", "e1"), ("d1", 0, 1, "B", "e0"), ("d1", 5, 6, "B", "e2")], "doc_id string, start int, end int, model string, event_id string")
    got = D.attach_events(D.read_causal(spark, str(tmp_path / "c.json")), events, ["A", "B"]).orderBy("connective_text").collect()
    assert [(r.event1, r.event2) for r in got] == [("e2", "e1"), ("e1", "e2")]
    (tmp_path / "p.json").write_text(json.dumps({"paper_id": "p", "abstract": [{"text": "a"}, {"text": "b"}], "body_text": [{"text": "c"}]}))
    assert D.read_papers(spark, str(tmp_path / "p.json")).first().text == "a\nb\n\nc"


def test_fetch_and_resume(spark):
    want = spark.createDataFrame([(k,) for k in range(5)], "id long")
    left = D.resume(want, want.where("id < 2"), "id")
    got = D.fetch(left, lambda keys: [(k, f"v{k}") for k in keys if k != 3], "id long, value string").collect()
    assert sorted(map(tuple, got)) == [(2, "v2"), (4, "v4")]


def test_hac_and_committees():
    rng = np.random.default_rng(0)
    v = np.concatenate([rng.normal(c, 0.1, (6, 3)) for c in np.eye(3) * 3])
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    merges = clustering.hac(v @ v.T, 0.9)
    assert len(merges) == 15
    tree = clustering.hac(v @ v.T)
    assert all(x[2] > 0 for x in tree) and [x[2] for x in tree[:3]] == sorted([x[2] for x in tree[:3]], reverse=True)
    s = v @ v.T
    for a, b, avg in tree:
        both = list(a + b)
        n = len(both)
        assert avg == pytest.approx((s[np.ix_(both, both)].sum() - n) / (n * (n - 1)))
    groups = clustering.committees(s, k=5)
    owner = clustering.assign(s, groups)
    assert len(groups) == 3 and all(len(set(owner[k : k + 6])) == 1 for k in (0, 6, 12))
    assert set(np.array(clustering.farthest_first(v, 3)) // 6) == {0, 1, 2}


def units(n, d, seed, whole=False):
    v = np.random.default_rng(seed).normal(size=(n, d))
    v[n // 2 :] = v[: n - n // 2] + 0.3 * v[n // 2 :]
    if whole:  # along the axes, so that all products are exact and many are equal
        v = np.where(np.abs(v) == np.abs(v).max(axis=1, keepdims=True), np.sign(v), 0) * (np.arange(n)[:, None] % 7 > 0)
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def test_hac_of_units_needs_no_similarity_matrix():
    """The merges are those of the matrix, ties and zero vectors included; memory goes with the number of vectors."""
    import tracemalloc

    for seed, (n, d) in enumerate([(0, 2), (1, 2), (2, 3), (90, 2), (150, 3), (150, 8)]):
        for stop in (-1.0, 0.0, 0.3):
            u = units(n, d, seed, seed % 2 == 1)
            want = [(a[0], b[0]) for a, b, _ in clustering.hac(u @ u.T, stop)]
            assert [m[:2] for m in clustering.hac_units(u, stop)] == want
            assert [m[:2] for m in clustering.hac_units(u, stop, listed=2, cells=300)] == want
    u = units(4000, 4, 0)
    tracemalloc.start()
    clustering.hac_units(u, 0.9999)
    assert tracemalloc.get_traced_memory()[1] < 4000 * 4000 * 8 / 2
    tracemalloc.stop()


@pytest.mark.parametrize("k", [3, 50])
def test_committees_of_units_equal_those_of_the_matrix(k):
    for seed, (n, d) in enumerate([(1, 2), (2, 2), (40, 3), (90, 5), (120, 12)]):
        u = units(n, d, seed)
        groups = clustering.committees(u @ u.T, k)
        assert clustering.committees_of_units(u, k) == groups
        assert clustering.assign_units(u, groups).tolist() == clustering.assign(u @ u.T, groups).tolist()
    s = np.stack([units(30, 4, x) @ units(30, 4, x).T for x in range(9)])
    members, values = clustering.best_cohesions(s)
    for x in range(9):
        want, value = clustering.best_cohesion(s[x])
        assert tuple(np.flatnonzero(members[x])) == want and values[x] == pytest.approx(value)


def test_cluster_groups(spark):
    rows = [(g, 10 * g + k, [1.0, 0.01 * k] if k < 3 else [-1.0, 0.01 * k]) for g in range(2) for k in range(6)]
    df = spark.createDataFrame(rows, "g long, id long, v array<double>")
    got = {r.id: r.cluster for r in clustering.hac_by_group(df, "g", "id", "v", 0.5).collect()}
    assert got == {10 * g + k: 10 * g + (0 if k < 3 else 3) for g in range(2) for k in range(6)}
    assert clustering.cbc_by_group(df, "g", "id", "v", k=3).count() == 12


def test_threshold_pairs_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(60, 4))
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    df = spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(v)], "id long, v array<double>")
    got = {(r.a, r.b) for r in vectors.threshold_pairs(df, "id", "v", 0.7, rows=10).collect()}
    assert got == {(i, j) for i in range(60) for j in range(i + 1, 60) if round(float(u[i] @ u[j]), 6) >= 0.7}


def joins(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Join")


def test_threshold_pairs_make_no_row_for_each_pair(spark):
    """Near copies, nulls, a null value, a zero vector, other lengths and a repeated id; pairs are made in matrices, not in a join."""
    rng = np.random.default_rng(7)
    v = rng.normal(size=(900, 8))
    v[300:600] = v[:300] + 0.2 * rng.normal(size=(300, 8))
    rows = [(k, x.tolist()) for k, x in enumerate(v)]
    odd = [(0, v[0].tolist()), (2000, None), (2001, [None, *v[0][1:].tolist()]), (2002, [0.0] * 8), (2003, [1.0, 2.0]), (2004, [2.0, 4.0]), (2005, [])]
    got = vectors.threshold_pairs(spark.createDataFrame(rows + odd, "id long, v array<double>"), "id", "v", 0.8, rows=100)
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    want = [(i, j) for i, j in zip(*np.nonzero(np.triu(np.round(u @ u.T, 6) >= 0.8, 1)))]
    want += [(i, j) for i, j in want if i == 0] + [(2003, 2004)]
    assert sorted((r.a, r.b) for r in got.collect()) == sorted(want) and len(want) > 200 and joins(got) == 0


def test_weighted_neighbours_equal_weighted_match(spark):
    """Several blocks of queries and items; the registered query makes no row for each pair."""
    from factloom.plans import registry, vector_queries  # noqa: F401

    rng = np.random.default_rng(8)
    rows = [(k, rng.normal(size=3).tolist(), rng.normal(size=4).tolist()) for k in range(200)] + [(500, None, [1.0] * 4), (520, [0.0] * 3, [1.0] * 4)]
    e = spark.createDataFrame(rows, "id long, a array<double>, b array<double>")
    q = e.where("id % 5 = 0")
    features = [("a", 1.0), ("b", 0.5)]
    got = {(r["query"], r.item): round(r.distance, 9) for r in vectors.weighted_neighbours(q, e, "id", "id", features, 0.6, rows=30).collect()}
    parts = [(vectors.scored(q, e, "id", "id", f).selectExpr("query", "item", "1 - score AS distance"), w) for f, w in features]
    want = {(r["query"], r.item): round(r.distance, 9) for r in vectors.weighted_match(parts, 0.6).collect()}
    assert got == want and len(want) > 100
    assert joins(registry.QUERIES["weighted_multi_query"](spark, "/root/testdata/sf0.001")) == 0


def test_overlap_join_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    a = [(int(k % 3), k, int(s), int(s + d)) for k, (s, d) in enumerate(zip(rng.integers(-50, 50, 40), rng.integers(0, 40, 40)))]
    b = [(int(k % 3), k, int(s), int(s + d)) for k, (s, d) in enumerate(zip(rng.integers(-50, 50, 40), rng.integers(0, 40, 40)))]
    x = spark.createDataFrame(a, "g int, i int, s int, e int")
    y = spark.createDataFrame(b, "g int, j int, t int, f int")
    got = sorted((r.i, r.j) for r in spans.overlap_join(x, y, ["g"], 7, ("s", "e"), ("t", "f")).collect())
    assert got == sorted((i, j) for g, i, s, e in a for h, j, t, f in b if g == h and s <= f and t <= e)
    assert one(spark, spans.mark_up(F.lit("abcdef"), F.lit(1), F.lit(2)).alias("m"), spans.gap_text(F.lit("abcdef"), F.lit(1), F.lit(4)).alias("g")) == ("a[[bc]]def", "cd")


def test_sieve():
    rows = [(0, 1, "a", "x"), (0, 2, "a", "x"), (0, 3, "b", None), (1, 4, "a", "y"), (2, 5, "a", "x"), (2, 6, "a", None), (9, 7, "a", "x")]
    got = consolidation.sieve(rows, 5)
    assert got[1] == got[2] == got[5] == 1 and got[3] == 3 and got[4] == 4 and got[7] == 7


def test_coreference_by_document(spark):
    rows = [(d, k // 2, 100 * d + k, "ab"[k % 2], None if k % 3 else "x") for d in range(3) for k in range(12)]
    df = spark.createDataFrame(rows, "doc long, sent long, mention long, kind string, arg string")
    got = {r.mention: r.event for r in consolidation.coreference(df, 5).collect()}
    for d in range(3):
        plain = consolidation.sieve([(s, m, k, a) for dd, s, m, k, a in rows if dd == d], 5)
        assert all(got[m] == e for m, e in plain.items())


def test_keyword_mentions(spark):
    tokens = spark.createDataFrame([(1, k, w) for k, w in enumerate("heavy rain stop rain".split())], "doc int, pos int, lemma string")
    words = spark.createDataFrame([("heavy rain", "Flood"), ("rain", "Weather"), ("stop", "NO_EVENT")], "lemma string, kind string")
    got = {(r.pos, r.kind, r.bigram) for r in consolidation.keyword_mentions(tokens, words, "doc", "pos", "lemma").collect()}
    assert got == {(1, "Flood", True), (3, "Weather", False)}


def test_grounding(spark):
    s = spark.createDataFrame([("m", "a/b", "exact", 0.5), ("m", "a/b", "avg", 0.9), ("m", "c", "exact", 1.5), ("m", "d", "exact", 0.1)], "mention string, node string, mode string, score double")
    got = [(r.node, round(r.score, 3)) for r in grounding.ground(s, "mention", "node", ["exact", "avg"], threshold=0.2, k=5).collect()]
    assert got == [("c", 1.0), ("a/b", 0.81)]
    sub = grounding.ground(s, "mention", "node", ["exact", "avg"], spark.createDataFrame([("m", "a")], "mention string, prefix string"), k=5)
    assert [r.node for r in sub.collect()] == ["a/b"]
    m = spark.createDataFrame([("x", "f", "Y"), ("z", "f", "W")], "internal string, flag string, external string")
    kinds = spark.createDataFrame([("x",), ("q",)], "kind string")
    assert [r.external for r in grounding.external_types(kinds, "kind", m, "f").collect()] == ["Y"]
    g = spark.sql("SELECT array(named_struct('type', 'a', 'score', 0.5D)) g")
    up = g.select(grounding.upsert(F.col("g"), F.lit("a"), F.lit(0.7)).alias("x"), grounding.upsert(F.col("g"), F.lit("b"), F.lit(0.2)).alias("y")).first()
    assert [tuple(v) for v in up.x] == [("a", 0.7)] and [tuple(v) for v in up.y] == [("a", 0.5), ("b", 0.2)]


def test_search_and_entities(spark):
    q = spark.createDataFrame([("q", "t", 0.5), ("q", "u", 1.0)], "query string, type string, score double")
    c = spark.createDataFrame([("m1", "t", 1.0), ("m1", "u", 0.3), ("m2", "u", 0.9)], "mention string, type string, score double")
    hits = grounding.match(q, c, 5)
    assert [(r.mention, r.score) for r in hits.orderBy("rank").collect()] == [("m2", 0.9), ("m1", 0.5)]
    names = spark.createDataFrame([("m1", "A"), ("m1", "B"), ("m2", "A")], "mention string, name string")
    assert [r.mention for r in grounding.with_entities(hits, "mention", names, ["A"], ["B", "C"]).collect()] == ["m1"]


def test_resolvers(spark):
    e = spark.createDataFrame([("no rain today", "Weather"), ("no", "Weather"), ("lack of food", "FoodShortage")], "t string, k string")
    assert [r.p for r in e.select(resolvers.event_polarity(F.col("t"), F.col("k")).alias("p")).collect()] == ["Negative", "Positive", "Positive"]
    kids = spark.createDataFrame([(1, 2), (1, 3)], "l long, r long")
    assert resolvers.cascade(spark.createDataFrame([(1,), (2,)], "id long"), kids, "id", ["l", "r"]).count() == 1
    args = spark.createDataFrame([("g", "a", ["x"]), ("g", "b", ["x", "y"]), ("g", "c", ["y", "z"])], "g string, m string, args array<string>")
    assert [(r.small, r.large) for r in resolvers.covering(args, ["g"], "m", "args").collect()] == [("a", "b")]
    rules = spark.createDataFrame([("r", "role1", "PER"), ("r", "role2", "GPE")], "rule string, role string, kind string")
    have = spark.createDataFrame([("e1", "role1", "PER"), ("e1", "role2", "GPE"), ("e2", "role1", "PER")], "e string, role string, kind string")
    assert [r.e for r in selection.divide(have, ["e"], rules, "rule", ["role", "kind"]).collect()] == ["e1"]
    old, new = spark.createDataFrame([(1, "a"), (2, "a")], "id int, v string"), spark.createDataFrame([(2, "b")], "id int, v string")
    assert {(r.id, r.v) for r in selection.last_writer([old, new], "id").collect()} == {(1, "a"), (2, "b")}


def test_typing_scores(spark):
    df = spark.createDataFrame([(["a", "b"], ["a"]), (["c"], []), (["d"], ["d"])], "g array<string>, p array<string>")
    r = metrics.typing_scores(df, "g", "p").first()
    assert (round(r.strict, 4), round(r.macro_p, 4), round(r.macro_r, 4), r.micro_p, r.micro_r) == (0.3333, 0.6667, 0.5, 1.0, 0.5)


def test_numbered(spark):
    rows = [r["index"] for r in selection.numbered(spark.range(1000).repartition(5), ["id"]).orderBy("id").collect()]
    assert rows == list(range(1000))


def test_triples_out(spark, tmp_path):
    t = spark.createDataFrame([("a/1", "name", 'x "y"'), ("a/1", "in", "b/2")], "s string, p string, o string")
    sinks.write_ntriples(t, str(tmp_path / "nt"), "u:")
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "nt")).collect()) == ["<u:a/1> <u:in> <u:b/2> .", '<u:a/1> <u:name> "x \\"y\\"" .']
    with pytest.raises(ValueError):
        graph.join(graph.pattern(t, "?a", "in", "?b"), graph.pattern(t, "?c", "name", "?d"))


def test_pool(spark):
    m = spark.createDataFrame([("v1", "d1", 1), ("v1", "d1", 2), ("v2", "d1", 3)], "o string, d string, at int")
    done = spark.createDataFrame([("v2", "d1")], "o string, d string")
    assert [(r.o, r["at"]) for r in minibatch.pool(m, ["o", "d"], ["at"], done).collect()] == [("v1", 2)]


def plain_best(s):
    """Of all clusters of the average-group tree the one with the largest size times average similarity; s has a zero diagonal."""
    member, best = np.eye(len(s)), ((0,), 0.0)
    while len(member) > 1:
        totals, sizes = member @ s @ member.T, member.sum(axis=1)
        score = {}
        for a in range(len(member)):
            for b in range(a + 1, len(member)):
                n = sizes[a] + sizes[b]
                score[a, b] = (totals[a, a] + totals[b, b] + 2 * totals[a, b]) / (n * (n - 1))
        (a, b), top = max(score.items(), key=lambda x: x[1])
        if top <= 0:
            break
        both = member[a] + member[b]
        if both.sum() * top > best[1]:
            best = tuple(np.flatnonzero(both)), both.sum() * top
        member = np.vstack([np.delete(member, [a, b], axis=0), both])
    return best


def plain_committees(s, k):
    kept, left = [], list(range(len(s)))
    for _ in range(10):
        found = {}
        for i in left:
            near = sorted((j for j in left if j != i), key=lambda j: -s[i, j])[:k]
            if near:
                sub = s[np.ix_(near, near)].copy()
                np.fill_diagonal(sub, 0)
                members, cohesion = plain_best(sub)
                found[tuple(sorted(near[x] for x in members))] = cohesion
        floor = max(np.mean(list(found.values())) - np.std(list(found.values())), 0) if found else 0
        new = []
        for c in sorted(found, key=lambda c: (-round(found[c], 9), c)):
            if found[c] >= floor and all(s[np.ix_(c, d)].mean() <= 0.35 for d in kept + new):
                new.append(c)
        kept += new
        rest = [i for i in left if max((s[i, list(c)].mean() for c in kept), default=0) < 0.25]
        if not new or not rest or rest == left:
            return kept
        left = rest
    return kept


def test_registered_committees_use_fifty_neighbours(spark, tmp_path):
    from factloom.plans import registry, vector_queries  # noqa: F401

    rng = np.random.default_rng(5)
    v = np.concatenate([rng.normal(c, 0.35, (30, 4)) for c in np.eye(4)[:2]])
    rows = [(k, x.tolist(), 0) for k, x in enumerate(v)]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {r.vec_id: r.committee for r in registry.QUERIES["committees"](spark, str(tmp_path)).collect()}
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    owner = lambda k: dict(enumerate(clustering.assign(u @ u.T, plain_committees(u @ u.T, k)).tolist()))
    assert got == owner(50) and got != owner(10)
