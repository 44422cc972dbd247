"""Event rules, ontologies, neighbour search and services on small cases."""

import json
import threading
import urllib.error
import urllib.request

import numpy as np
import pytest
from pyspark.sql import functions as F

from factloom import services
from factloom.operators import annotators, event_rules as E, ontology as O, search as S, vectors as V
from factloom.plans import pipeline as P, registry
from factloom.streaming import minibatch

SF = "/root/testdata/sf0.001"


def test_accept_and_remap_types(spark):
    events = spark.createDataFrame([(1, 10, "Provide", 5), (1, 11, "Other", 9), (2, 20, "Provide", 5), (3, 30, "Provide", 1)], "sent int, mention int, kind string, pos int")
    entities = spark.createDataFrame([(1, 100, "FOOD", 7, 7), (1, 101, "SEED", 40, 40), (2, 200, "SEED", 20, 21), (3, 300, "PER", 1, 1)], "sent int, entity int, kind string, start int, end int")
    arguments = spark.createDataFrame([(10, "has_artifact", 101), (20, "has_artifact", 200)], "mention int, role string, entity int")
    required = spark.createDataFrame([("Provide", "FOOD"), ("Provide", "SEED")], "kind string, entity_kind string")
    assert {r.mention for r in E.accept_types(events, entities, required).collect()} == {10, 11, 20}
    mapping = spark.createDataFrame([("FOOD", "ProvideFood"), ("SEED", "ProvideSeed")], "entity_kind string, new_kind string")
    got = {tuple(r) for r in E.remap_types(events, entities, arguments, "Provide", "has_artifact", mapping).collect()}
    # 10 has an argument far away and another entity nearby, 20 only the argument, 30 neither.
    assert got == {(11, "Other", None, False), (10, "ProvideSeed", 101, False), (10, "ProvideFood", 100, True), (20, "ProvideSeed", 200, False)}


def test_added_and_propagated_arguments(spark):
    events = spark.createDataFrame([(1, 10, 5), (1, 11, 30), (2, 20, 5)], "sent int, mention int, pos int")
    values = spark.createDataFrame([(1, 7, 8, 8), (2, 8, 9, 9)], "sent int, entity int, start int, end int")
    tokens = spark.createDataFrame([(1, 20, ","), (2, 7, ","), (2, 1, "x")], "sent int, pos int, token string")
    none = spark.createDataFrame([], "mention int, role string, entity int")
    assert [tuple(r) for r in E.add_arguments(events, values, none, ["has_time"], "has_time", tokens).collect()] == [(10, "has_time", 7)]
    has = spark.createDataFrame([(10, "has_time", 1)], "mention int, role string, entity int")
    assert E.add_arguments(events, values, has, ["has_time"], "has_time", tokens).count() == 0
    doc = spark.createDataFrame([(1, k, 100 + k) for k in range(6)], "doc int, sent_no int, mention int")
    given = spark.createDataFrame([(100, "who", 1), (103, "who", 2), (103, "who", 3)], "mention int, role string, entity int")
    got = {(r.mention, r.entity) for r in E.propagate_arguments(doc, given, ["who"], 3).collect()}
    assert got == {(101, 1), (102, 1)}  # 104 is four sentences away, and 103 has two


def test_propagated_halves_equal_sql(spark, tmp_path):
    """Prices half-way between two thousands go to the even one, as in the SQL."""
    import duckdb

    from factloom.plans import registry, rule_queries  # noqa: F401

    rows = [(2 * k + f, k, "FO"[f], 1000.0 * k + 500, f"1995-01-0{f + 1}") for k in range(6) for f in range(2)]
    df = spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, d string")
    df.selectExpr("* except(d)", "cast(d as timestamp) as o_orderdate").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    got = registry.QUERIES["propagated_arguments"](spark, str(tmp_path)).select("mention", "role", "entity").collect()
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW orders AS SELECT * FROM read_parquet('{tmp_path}/orders.parquet/*.parquet')")
    want = duck.execute(f"SELECT mention, role, entity FROM ({registry.ORACLE_SQL['propagated_arguments']})").fetchall()
    assert sorted(map(tuple, got)) == sorted(want) and {e for *_, e in want} == {0, 2, 4, 6}


def test_ontology_of_a_file(spark, tmp_path):
    tree = [{"root # top": [{"a": [{"OntologyNode": None, "name": "x", "examples": ["one", "two # second"]}, {"b": [{"OntologyNode": None, "name": "x", "examples": ["three"]}]}]}]}]
    (tmp_path / "o.json").write_text(json.dumps(tree))
    nodes = O.read_ontology(spark, str(tmp_path / "o.json"))
    got = {r.path: r for r in nodes.collect()}
    assert set(got) == {"/", "/a", "/a/x", "/a/b", "/a/b/x"} and got["/"].name == "root" and got["/a/b/x"].depth == 3
    assert {(e.text, e.weight) for e in got["/a"].exemplars} == {("one", 0.5), ("two", 0.5), ("three", 0.25)}
    assert {r.path for r in O.nodes_by_name(nodes, "x").collect()} == {"/a/x", "/a/b/x"}
    yaml = pytest.importorskip("yaml")
    (tmp_path / "o.yml").write_text(yaml.safe_dump(tree))
    assert O.read_ontology(spark, str(tmp_path / "o.yml")).collect() == nodes.collect()


def test_approximate_neighbours_recall(spark):
    """All rows are in one cell each; nine of ten true neighbours are found, on the table and on clustered vectors."""
    for folder in (SF, "/root/testdata/sf0.01"):
        e = spark.read.parquet(f"{folder}/embeddings.parquet")
        got = {(r["query"], r.item) for r in registry.QUERIES["approximate_neighbours"](spark, folder).collect()}
        want = {(r["query"], r.item) for r in V.top_neighbours(e.where("vec_id % 20 = 0"), e, "vec_id", "vec_id", "embedding", 10).collect()}
        assert len(got & want) >= 0.9 * len(want)
        centres = S.fit_cells(e, "vec_id", "embedding", 5)
        assert S.cells_of(e, "embedding", centres, 1).count() == e.count()
    rng = np.random.default_rng(0)
    base = rng.normal(size=(30, 16))
    rows = [(k, (base[k % 30] + 0.1 * rng.normal(size=16)).tolist()) for k in range(1500)]
    e = spark.createDataFrame(rows, "vec_id long, v array<double>")
    q = e.where("vec_id % 20 = 0")
    got = {(r["query"], r.item) for r in S.approximate_top(q, e, "vec_id", "v", 10, S.fit_cells(e, "vec_id", "v", 30), 3).collect()}
    want = {(r["query"], r.item) for r in V.top_neighbours(q, e, "vec_id", "vec_id", "v", 10).collect()}
    assert len(got & want) >= 0.9 * len(want)


def test_tiles_do_not_change_results(spark):
    e = spark.read.parquet(f"{SF}/embeddings.parquet")
    one = {tuple(r)[:2]: round(r.score, 6) for r in V.scored(e.where("vec_id < 7"), e, "vec_id", "vec_id", "embedding").collect()}
    many = {tuple(r)[:2]: round(r.score, 6) for r in V.scored(e.where("vec_id < 7"), e, "vec_id", "vec_id", "embedding", rows=9).collect()}
    assert one == many and len(one) == 7 * (e.count() - 1)
    pairs = lambda rows: {tuple(r) for r in V.threshold_pairs(e, "vec_id", "embedding", 0.5, rows=rows).collect()}
    assert pairs(5) == pairs(10_000)


def test_services(spark):
    nodes = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 1.0])], "node string, vector array<double>")
    servers = [services.service(services.grounding_answer(spark, nodes, 0.3, 1)), services.service(services.annotation_answer(lambda df: df.assign(n=df["text"].str.len())))]
    for s in servers:
        threading.Thread(target=s.serve_forever, daemon=True).start()

    def post(s, body):
        r = urllib.request.Request(f"http://127.0.0.1:{s.server_port}/", body if isinstance(body, bytes) else json.dumps(body).encode(), {"Content-Type": "application/json"})
        return json.load(urllib.request.urlopen(r, timeout=60))

    got = post(servers[0], [{"id": 1, "vector": [0.1, 2]}, {"id": 2, "vector": [-1, 0]}])
    assert [x["groundings"] and x["groundings"][0]["type"] for x in got] == ["b", []] and post(servers[0], []) == []
    assert post(servers[1], [{"text": "abc"}, {"text": ""}]) == [{"text": "abc", "n": 3}, {"text": "", "n": 0}]
    for bad in (b"{", b"3", b'[{"x": 1}]'):
        with pytest.raises(urllib.error.HTTPError):
            post(servers[0], bad)
    for s in servers:
        s.shutdown()


def test_failing_programs_end_no_task(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id int, text string")
    assert {r.status for r in annotators.pipe(docs, ["sleep", "5"], timeout=1).collect()} == {-1}
    assert {r.status for r in annotators.pipe(docs, ["/no/such/program"]).collect()} == {-2}


def test_stream_keys_of_several_batches(spark, tmp_path):
    """A key that comes in two mini-batches is returned once, and windows keep the last batch's count."""
    for k in range(3):
        spark.createDataFrame([(1, f"2024-01-0{k + 1} 00:10:00", k), (10 + k, "2024-01-01 00:20:00", k)], "id int, ts string, n int").withColumn("ts", F.to_timestamp("ts")).coalesce(1).write.parquet(f"{tmp_path}/in/part{k}.parquet")
    schema = spark.read.parquet(f"{tmp_path}/in/part0.parquet").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{tmp_path}/in")
    seen = []
    minibatch.process(stream, lambda df, n: seen.append(df.count()), f"{tmp_path}/c")
    assert sum(seen) == 6 and len(seen) == 3
    rows = minibatch.run_once(spark, f"{tmp_path}/in/*", ["id"]).collect()
    assert sorted(r.id for r in rows) == [1, 10, 11, 12]
    got = {(str(r.window_start)[:13], r.n) for r in minibatch.window_counts(spark, f"{tmp_path}/in/*", "ts", "1 hour", []).collect()}
    assert got == {("2024-01-01 00", 4), ("2024-01-02 00", 1), ("2024-01-03 00", 1)}


def test_strip_events(spark):
    one = spark.createDataFrame([(1, 2, "r")], "event_id int, mention_id int, role string")
    kb = P.strip_events(P.KnowledgeBase({"documents": spark.createDataFrame([(1,)], "doc_id int"), "events": one, "event_arguments": one}))
    assert kb["documents"].count() == 1 and kb["events"].count() == kb["event_arguments"].count() == 0


def test_tree_and_metric_and_parameters(spark):
    edges = spark.createDataFrame([("r", "a"), ("r", "b"), ("b", 'c"')], "parent string, child string")
    (row,) = S.tree_json(edges, 3).collect()
    assert json.loads(row.tree) == {"id": "r", "children": [{"id": "a", "children": []}, {"id": "b", "children": [{"id": 'c"', "children": []}]}]}
    with pytest.raises(ValueError):
        S.metric("JACCARD")
    with pytest.raises(ValueError):
        S.feature("type")(lambda: F.lit(1))
    lines = spark.createDataFrame([("2 3",), ("a 1 2 3",), ("b 4 5 x",), ("c 1 1 1",)], "value string")
    assert {r.word: r.vector for r in S.read_embeddings(lines).collect()} == {"a": [1.0, 2.0, 3.0], "c": [1.0, 1.0, 1.0]}
