"""Pipelines of resolvers, and rules of sites."""

import json

import pytest

from factloom.plans import pipeline as P
from factloom.sources import sites


@pytest.fixture
def kb(spark):
    f = spark.createDataFrame
    return P.KnowledgeBase({
        "events": f([(1,), (2,), (3,)], "event_id long"),
        "event_mentions": f([(10, 1, "Rain"), (11, 1, "bad"), (12, 2, "BAD "), (13, 3, "rain")], "mention_id long, event_id long, trigger string"),
        "event_arguments": f([(10, "a"), (12, "b")], "mention_id long, role string"),
        "groundings": f([(10, "x", 0.5), (10, "y", 0.5), (13, "x", 0.1)], "mention_id long, type string, score double"),
        "relations": f([(100, 1, 3, "Cause-Effect"), (101, 1, 3, "Catalyst-Effect"), (102, 1, 2, "Before-After")], "relation_id long, left_id long, right_id long, type string"),
        "relation_mentions": f([(100, "Positive"), (101, "Negative"), (102, "Positive")], "relation_id long, polarity string"),
    })


def test_configured_pipeline(spark, kb):
    config = {"resolvers": [{"name": "drop_triggers", "options": {"triggers": ["bad"]}}, "drop_negative", "rename_relations", "unify_events", {"name": "best_type", "options": {"threshold": 0.2}}, "do_nothing"]}
    out = P.run(kb, P.from_config(json.dumps(config)), cut_every=2)
    assert sorted(r.event_id for r in out["events"].collect()) == [1, 3]
    assert [(r.relation_id, r.type) for r in out["relations"].collect()] == [(100, "cause")]
    assert [r.relation_id for r in out["relation_mentions"].collect()] == [100]
    assert [r.role for r in out["event_arguments"].collect()] == ["a"]
    assert sorted((r.group_id, r.event_id) for r in out["event_groups"].collect()) == [("bad", 1), ("rain", 1), ("rain", 3)]
    assert [(r.mention_id, r.type) for r in out["groundings"].collect()] == [(10, "x")]


def test_renaming_keeps_the_first(kb):
    assert sorted((r.relation_id, r.type) for r in P.RESOLVERS["rename_relations"](kb)["relations"].collect()) == [(100, "cause"), (102, "before")]


def test_errors(spark):
    with pytest.raises(ValueError):
        P.from_config('{"resolvers": ["no_such"]}')
    with pytest.raises(ValueError):
        P.KnowledgeBase({"events": spark.range(1)})


def test_round_trip(spark, kb, tmp_path):
    P.save(kb, str(tmp_path))
    assert P.load(spark, str(tmp_path), ["events", "relations"])["relations"].count() == 3


def test_sites(spark):
    html = '<html><head><meta name="author" content="A B"><meta property="article:published_time" content="2019-01-02"></head><body><h1>T &amp; x</h1><div class="body main"><p>One<p>Two <b>b</b><nav>no</nav></div><p>out</body>'
    assert sites.read_page(html, sites.Site(body="div.main")) == {"title": "T & x", "text": "One\nTwo b", "author": "A B", "published": "2019-01-02"}
    pages = spark.createDataFrame([(1, "http://www.a.org/x", html), (2, "http://b.org", html), (3, "https://a.org", None)], "page_id long, url string, html string")
    got = {r.page_id: r.title for r in sites.extract(pages, {"a.org": sites.Site(body="div.main")}).collect()}
    assert got == {1: "T & x", 3: ""}
