"""Annotated XML, archives, jobs, structured files, uploads, and edge cases of trees and coreference."""

import io
import json
import tarfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from factloom.operators import annotators, coreference as C, regression, structured, syntax as S
from factloom.sources import annotations as A, sinks
from factloom.streaming.jobs import Jobs

XML = """<Annotations version="1"><Document docid="d1" language="English"><OriginalText><Contents>Rain fell. It stopped.</Contents></OriginalText>
<Sentences><Sentence id="s0" char_offsets="0:9"><Contents>Rain fell.</Contents>
<MentionSet><Mention id="m0" mention_type="desc" entity_type="OTH" syn_node_id="n0"/></MentionSet>
<EventMentionSet><EventMention id="e0" event_type="Weather" anchor_node_id="n1" score="0.5"><EventMentionArg role="has_theme" mention_id="m0" score="0.9"/></EventMention></EventMentionSet></Sentence>
<Sentence id="s1" char_offsets="11:21"><Contents>It stopped.</Contents></Sentence></Sentences></Document></Annotations>"""


def test_annotated_xml(spark, tmp_path):
    (tmp_path / "d1.xml").write_text(XML)
    d = A.read_annotated(spark, str(tmp_path))
    assert [(r.sentence, r.sentence_id, r.start, r.end) for r in A.sentences(d).orderBy("sentence").collect()] == [(0, "s0", 0, 9), (1, "s1", 11, 21)]
    assert [tuple(r) for r in A.mentions(d).collect()] == [("d1", 0, "m0", "desc", "OTH")]
    assert [(r.event_id, r.event_type, r.score) for r in A.event_mentions(d).collect()] == [("e0", "Weather", 0.5)]
    assert [tuple(r) for r in A.event_arguments(d).collect()] == [("d1", "e0", "has_theme", "m0", 0.9)]


def test_hand_written_sentences(spark):
    assert [tuple(r) for r in A.from_sentences(spark, ["a", "b"]).collect()] == [("doc-0", "a"), ("doc-1", "b")]


def test_archives(spark, tmp_path):
    with tarfile.open(tmp_path / "x.tgz", "w:gz") as t:
        for name, body in (("a.txt", b"one"), ("sub/b.txt", b"")):
            info = tarfile.TarInfo(name)
            info.size = len(body)
            t.addfile(info, io.BytesIO(body))
    assert sorted((r.name, bytes(r.content)) for r in A.read_archives(spark, str(tmp_path / "*.tgz")).collect()) == [("a.txt", b"one"), ("sub/b.txt", b"")]


def test_structured_file(spark, tmp_path):
    ref = lambda f, e: {"descriptor": {"inputId": f, "frameIdx": 0, "entryIdx": e}}
    body = {"schema": "urn:x", "relationships": [{"type": "cause", "cause": ref("a", 1), "effect": ref("b", 2)}, {"type": "cause", "cause": ref("a", 1), "effect": ref("b", 3), "confidence": {"reliability": "high"}}]}
    (tmp_path / "s.json").write_text(json.dumps(body))
    r = structured.causal_relations(structured.read_structured(spark, str(tmp_path)), "position", "relationship").orderBy("relation").collect()
    assert [(x.cause, x.effect, x.reliability) for x in r] == [("Factor-a-0-1", "Factor-b-0-2", "low"), ("Factor-a-0-1", "Factor-b-0-3", "high")]


def test_jobs(spark, tmp_path):
    jobs = Jobs(spark, str(tmp_path))
    done = jobs.submit(lambda s: s.range(5))
    bad = jobs.submit(lambda s: s.range(5).select("missing"))
    assert jobs.result(done, 60).count() == 5 and jobs.status(done) == "done"
    with pytest.raises(Exception):
        jobs.result(bad, 60)
    assert jobs.status(bad) == "failed" and jobs.status("x") == "unknown"
    jobs.kill(done)
    assert jobs.status(done) == "done"


def test_upload_sends_every_row_once(spark, tmp_path):
    folder = str(tmp_path)

    def send(rows):
        import uuid

        with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
            json.dump(rows, f)

    sinks.upload(spark.range(0, 25, 1, 3), send, batch=4)
    batches = [json.loads(p.read_text()) for p in tmp_path.iterdir()]
    assert sorted(r["id"] for b in batches for r in b) == list(range(25)) and max(map(len, batches)) <= 4


@pytest.mark.parametrize("text,valid", [("attack", True), ("well-being", True), ("it's", False), ("a", False), ("x1", False), ("one two three four five six", False), ("", False), ("two  gaps", False)])
def test_valid_trigger(spark, text, valid):
    assert spark.createDataFrame([(text,)], "t STRING").select(S.valid_trigger(F.col("t"))).head()[0] is valid


def test_shatter_keeps_events_without_the_role(spark):
    rows = [(1, "A", "x"), (1, "A", "y"), (1, "A", "x"), (1, "B", "z"), (2, "B", "z"), (3, None, "q")]
    out = C.shatter(spark.createDataFrame(rows, "e INT, role STRING, f STRING"), ["e"], "role", "f", "A").collect()
    assert sorted((r.e, r.variant, r.f) for r in out) == [(1, 1, "x"), (1, 1, "x"), (1, 1, "z"), (1, 2, "y"), (1, 2, "z"), (2, 1, "z"), (3, 1, "q")]


def test_realis_conflict(spark):
    rows = [(["GENERIC"], ["ACTUAL"], True), (["OTHER"], ["GENERIC"], True), (["ACTUAL"], ["OTHER"], False), ([], [], False)]
    got = spark.createDataFrame(rows, "a ARRAY<STRING>, b ARRAY<STRING>, want BOOLEAN").select(C.realis_conflict(F.col("a"), F.col("b")).alias("got"), "want").collect()
    assert all(r.got == r.want for r in got)


def test_regression_against_least_squares(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 2))
    y = x @ np.array([2.0, -1.0]) + 3 + rng.normal(size=60)
    df = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(x, y)] + [(1.0, 1.0, None)], "a DOUBLE, b DOUBLE, y DOUBLE")
    got = [r.prediction for r in regression.predict(regression.fit(df, ["a", "b"], "y"), df.where("y IS NOT NULL")).orderBy("a").collect()]
    coef, *_ = np.linalg.lstsq(np.c_[x, np.ones(60)], y, rcond=None)
    assert np.allclose(got, (np.c_[x, np.ones(60)] @ coef)[np.argsort(x[:, 0])])


def test_phrases(spark):
    rows = [(1, "Cash for Work and cash for work".split()), (2, []), (3, None), (4, ["cash"])]
    df = spark.createDataFrame(rows, "d INT, w ARRAY<STRING>")
    got = annotators.phrase_mentions(df, "w", [("Aid", "cash for <work>"), ("Money", "cash")]).collect()
    assert sorted((r.d, r.event_type, r.phrase_start, r.phrase_end, r.anchor) for r in got) == [(1, "Aid", 0, 2, 2), (1, "Aid", 4, 6, 6), (1, "Money", 0, 0, 0), (1, "Money", 4, 4, 4), (4, "Money", 0, 0, 0)]


def test_model_and_program(spark):
    df = spark.createDataFrame([(1, "ab"), (2, None)], "doc_id INT, text STRING")

    def build():
        return lambda batch: batch.assign(n=batch["text"].fillna("").str.len())[["doc_id", "n"]]

    assert sorted(tuple(r) for r in annotators.annotate(df, build, "doc_id INT, n LONG").collect()) == [(1, 2), (2, 0)]
    assert sorted(tuple(r) for r in annotators.pipe(df, ["tr", "a", "x"]).collect()) == [(1, 0, "xb"), (2, 0, "")]


def test_dump(spark, tmp_path):
    sinks.write_dump({"a": spark.range(3)}, str(tmp_path))
    sinks.write_dump({"a": spark.range(2)}, str(tmp_path / "p"), "parquet")
    assert spark.read.json(str(tmp_path / "a")).count() == 3 and spark.read.parquet(str(tmp_path / "p" / "a")).count() == 2
