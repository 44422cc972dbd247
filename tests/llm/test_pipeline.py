"""The pipeline, stage by stage, against brute force on whole inputs."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline as C
from factloom.llm import html_extract, language_id, license_scan, near_copies, packing
from tests.llm.test_operators import ODD, SF, check_pieces, docs, lower, luhn, words

PRIVATE = re.compile(r"[\w.]+@mail\d\.example\.com|\+1 \(\d{3}\) 555-\d{4}|\b4\d{15}\b|\b(?:\d{1,3}\.){3}\d{1,3}\b|\b[0-9a-f]{40}\b|AKIA[0-9A-Z]{16}|(?<=password=)\w+")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output of each stage, written and read again as the pipeline does."""
    folder, out = tmp_path_factory.mktemp("stages"), {}
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    for name, f in C.STAGES:
        got = f(spark, frame, SF)
        got.write.parquet(f"{folder}/{name}")
        after = spark.read.parquet(f"{folder}/{name}")
        out[name] = (frame.collect(), after.collect(), frame.columns, after.columns)
        frame = after
    return out


def test_columns_stay(stages):
    for name, _ in C.STAGES[:-1]:
        assert stages[name][2] == stages[name][3]


def test_language_keeps_documents_with_letters(stages):
    before, after, *_ = stages["language"]
    kept = {r.doc_id for r in after}
    assert all(r.doc_id in kept for r in before if len(re.findall(r"[^\W\d_]", r.text or "")) > 20)
    assert not any(r.doc_id in kept for r in before if not re.search(r"[^\W\d_]", r.text or ""))


def five_words(text):
    w = words(lower(text))
    return frozenset(tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))) if w else frozenset()


def similar_classes(texts):
    """The smallest id of each component of pairs with a similarity of 0.8 or more, by comparing all pairs."""
    sets, root = {k: five_words(t) for k, t in texts.items()}, {k: k for k in texts}
    for a in sorted(sets):
        for b in sets:
            common = len(sets[a] & sets[b])
            if a < b and common >= 0.8 * (len(sets[a]) + len(sets[b]) - common) and root[a] != root[b]:
                lo, hi = sorted((root[a], root[b]))
                root = {k: lo if r == hi else r for k, r in root.items()}
    return root


def test_edited_copies_go(stages):
    before, after, *_ = stages["near_duplicates"]
    classes = similar_classes({r.doc_id: r.text for r in before})
    assert {r.doc_id for r in after} == set(classes.values()) and len(after) == len(set(classes.values()))


def test_near_copies_of_edited_texts(spark):
    """Copies with one to six words changed, chains of copies, and a large group; some lie just below the similarity."""
    rng = np.random.default_rng(3)
    base = [[f"w{x}" for x in rng.integers(0, 5000, rng.integers(3, 150))] for _ in range(40)]
    texts = [" ".join(b) for b in base]
    for _ in range(300):
        w = texts[rng.integers(0, len(texts))].split()
        for k in rng.integers(0, len(w), rng.integers(0, 7)):
            w[k] = f"W{rng.integers(0, 5000)}"
        texts.append(" ".join(w))
    got = {r.doc_id: r.component_id for r in near_copies.near_copies(docs(spark, texts)).collect()}
    assert got == similar_classes(dict(enumerate(texts)))


def test_stage_joins_fingerprints_by_the_trie(spark, monkeypatch):
    """The stage's first candidates are those of op5's trie join, over five-word shingles; copies that it links are tied by it
    alone, and what it links wrongly is not."""
    seen, whole = [], near_copies.simhash.similar_links
    monkeypatch.setattr(near_copies.simhash, "similar_links", lambda nodes, *a, **k: seen.append(nodes.collect()) or whole(nodes, *a, **k))
    rng = np.random.default_rng(11)
    base = [f"w{x}" for x in rng.integers(0, 9000, 400)]
    texts = [" ".join(base), " ".join([*base[:-1], "end"]), " ".join(f"v{x}" for x in rng.integers(0, 9000, 50)), "", None]
    frame = docs(spark, texts)
    assert {r.doc_id for r in C.near_duplicates(spark, frame, SF).collect()} == {0, 2, 3}
    want = near_copies.simhash.fingerprints(pa.array(texts), near_copies.SHINGLE).view(np.int64)
    assert [{r.fp for r in s} for s in seen] == [set(want.tolist())]
    sets = spark.createDataFrame([(bytes([k]), int(c)) for k, c in enumerate([*want[:3], want[0]])], "fp binary, code long")
    got = {(r.a[0], r.b[0]) for r in near_copies._trie_pairs(sets).collect()}
    assert got == {(0, 1), (0, 3)}


@pytest.mark.parametrize("tile", [2000, 5])
def test_near_copies_of_hot_groups(spark, monkeypatch, tile):
    """Chains of edits from one text, and a passage in texts of their own; with buckets whole and cut into tiles."""
    whole = near_copies._tiles
    monkeypatch.setattr(near_copies, "_tiles", lambda known, sets: whole(known, sets, tile))
    rng = np.random.default_rng(5)
    word = lambda: f"w{rng.integers(0, 9000)}"
    chain = [[word() for _ in range(80)]]
    for _ in range(150):
        w = list(chain[rng.integers(0, len(chain))])
        for k in rng.integers(0, len(w), rng.integers(1, 4)):
            w[k] = word()
        chain.append(w)
    passage = [word() for _ in range(60)]
    shared = [passage + [word() for _ in range(rng.integers(20, 60))] for _ in range(60)]
    texts = [" ".join(w) for w in chain + shared]
    got = {r.doc_id: r.component_id for r in near_copies.near_copies(docs(spark, texts)).collect()}
    assert got == similar_classes(dict(enumerate(texts)))


def test_rows_that_share_an_id(spark):
    texts = ["one two three four five six", "one two three four five six", "another text of its own with words", "one two three four five six", None, ""]
    frame = docs(spark, texts, ids=[1, 1, 1, 2, 3, None])
    for shuffled in (frame, frame.repartition(3)):
        kept = near_copies.drop_near_copies(shuffled)
        assert kept.columns == frame.columns
        assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(1, texts[0]), (1, texts[2]), (3, None), (None, "")], key=str)


def test_no_benchmark_item_is_left(spark, stages):
    before, after, *_ = stages["benchmark"]
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    held = {r.doc_id for r in before if any(i in (r.text or "") for i in items)}
    kept = {r.doc_id for r in after}
    assert not held & kept and len({r.doc_id for r in before} - held - kept) <= 1


def test_no_private_value_is_left(stages):
    before, after, *_ = stages["personal_data"]
    texts = {r.doc_id: r.text for r in after}
    assert set(texts) == {r.doc_id for r in before} and all(r.n_chars == len(r.text) for r in after)
    for r in before:
        found = [v for v in PRIVATE.findall(r.text or "") if not re.fullmatch(r"4\d{15}", v) or luhn(v)]
        assert not any(v in texts[r.doc_id] for v in found)
        assert found or texts[r.doc_id] == r.text


def test_pieces_cover_all_documents(stages):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    before, after, *_ = stages["pack"]
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    ids = {r.doc_id: [*tok.encode(r.text or "", add_special_tokens=False).ids, 0] for r in before}
    assert {r.doc_id for r in after} == set(ids)
    check_pieces(after, ids)


def test_run_is_the_chain_of_stages(spark, stages):
    key = lambda r: (r.doc_id, r.doc_tokens)
    assert {key(r) for r in C.run(spark, SF).collect()} == {key(r) for r in stages["pack"][1]}


def test_odd_rows_go_through(spark):
    frame = docs(spark, [*ODD, "one two three four five six seven", "mail me: a.b@c.org"], ids=[None, *range(1, len(ODD) + 2)])
    frame = frame.withColumnRenamed("score", "kinds").withColumnRenamed("shard", "fp")
    for name, f in C.STAGES:
        got = f(spark, frame, SF)
        frame = spark.createDataFrame(got.collect(), got.schema)
    rows = frame.collect()
    assert {r.doc_id for r in rows} >= {3, 8} and all(r.length > 0 for r in rows)
    for empty in (docs(spark, []),):
        for name, f in C.STAGES:
            empty = f(spark, empty, SF)
        assert empty.count() == 0


def test_pages_and_licenses_of_odd_rows(spark):
    pages = spark.createDataFrame([(1, "u", None, "x", 3), (2, None, "", "x", 3), (None, "u", "<p>" + "long text and the rest " * 5000, "x", 3), (4, "u", "<b", "x", 3)], "page_id long, url string, html string, text string, n_chars long")
    got = {r.page_id: r for r in html_extract.extract(pages).collect()}
    assert len(got) == 4 and got[1].text == "" and got[1].n_chars == 0 and got[None].n_chars > 90_000
    assert html_extract.extract(pages.limit(0)).count() == 0 and license_scan.scan(docs(spark, [])).count() == 0


def test_dot_product_order():
    """Of what fits, the item most along the remaining room goes in first; nothing is lost and all limits hold."""
    rng = np.random.default_rng(0)
    loss = lambda n, k: np.r_[0, np.cumsum(np.arange(n) < k)]
    items = [packing.Item(k, 0, int(n), loss(n, n // 3)) for k, n in enumerate(rng.integers(1, 200, 500))]
    limits = packing.Limits(256, 6, 80)
    out = list(packing.pack(iter(items), limits, cut=False))
    assert Counter(x.owner for s in out for x in s) == Counter(range(500))
    assert all(sum(x.length for x in s) <= 256 and len(s) <= 6 and sum(x.demand() for x in s) <= 80 for s in out)
    assert len(out) <= 1.15 * max(sum(x.length for x in items) / 256, sum(x.demand() for x in items) / 80, 500 / 6)
    for s in out:
        assert s[0].length == max(x.length for x in s)


def test_window_rows_of_long_text():
    data = np.frombuffer(b"a" * 1000, np.uint8)
    x, row = language_id.windows(data, np.array([0, 0, 10, 1000]))
    assert Counter(row.tolist()) == {1: 1, 2: -(-990 // language_id.WINDOW)} and x[0, 9] == ord("a") and x[0, 10] == 0
