from __future__ import annotations

import numpy as np

from strata.llm import winnowing as w
from strata.llm.queries import op1_winnowing
from tests.llm import brute
from tests.llm.conftest import SF, pairs_of


def check(found, rows):
    want = brute.edits(rows)
    assert len(found) == len(rows)
    texts = dict(rows)
    for r in found:
        n, edited, nxt = want[r["doc_id"]]
        assert (r["n_chars"], r["edited_sha256"]) == (n, brute.sha(edited))
        sets = [set(w.fingerprint(t)[1].tolist()) for t in (texts[r["doc_id"]] or "", edited, nxt)]
        for name, other in (("near_edited", sets[1]), ("near_next", sets[2])):
            union = len(sets[0] | other)
            assert r[name] == (len(sets[0] & other) / union if union else 1.0)
        assert r["fingerprint"] == w.encode(*w.fingerprint(texts[r["doc_id"]] or ""))
        assert r["edited_fingerprint"] == w.encode(*w.fingerprint(edited))


def test_fingerprint_is_the_rightmost_minimum_of_each_window():
    rng = np.random.default_rng(3)
    for n in (0, 1, 5, 23, 24, 25, 55, 56, 400):
        for letters in ("ab", "abcdefghé字😀"):
            text = "".join(rng.choice(list(letters), n))
            for k, size in ((24, 32), (3, 4), (5, 1)):
                pos, h = w.fingerprint(text, k, size)
                assert list(zip(pos.tolist(), h.tolist())) == brute.winnow(text, k, size)


def test_chunks_change_nothing(monkeypatch):
    rng = np.random.default_rng(4)
    text = "".join(rng.choice(list("abc "), 5000))
    whole = w.fingerprint(text)
    monkeypatch.setattr(w, "_CHUNK", 97)
    parts = w.fingerprint(text)
    assert all(np.array_equal(a, b) for a, b in zip(whole, parts))


def test_shared_passages_share_a_fingerprint():
    rng = np.random.default_rng(5)
    make = lambda n: "".join(rng.choice(list("abcdefgh "), n))
    for _ in range(50):
        passage = make(w.K + w.W - 1)
        a, b = make(200) + passage + make(150), make(90) + passage + make(310)
        assert set(w.fingerprint(a)[1].tolist()) & set(w.fingerprint(b)[1].tolist())


def test_query_on_the_whole_table(spark, docs):
    found = op1_winnowing(spark, SF).collect()
    check(found, pairs_of(docs))
    far = sorted(r["near_next"] for r in found)
    assert far[len(far) // 2] < 0.05 < 0.25 < sorted(r["near_edited"] for r in found)[len(far) // 2]


def test_edges(spark, edge_docs, no_docs):
    check(w.with_edits(edge_docs).collect(), pairs_of(edge_docs))
    assert w.with_edits(no_docs).collect() == []
    assert w.fingerprints(no_docs).collect() == []
    one = spark.createDataFrame([(7, "only one document")], "doc_id long, text string")
    check(w.with_edits(one).collect(), [(7, "only one document")])


def test_null_and_repeated_ids(spark):
    df = spark.createDataFrame([(None, "n1 text"), (2, "b"), (2, "a"), (5, "five texts")], "doc_id long, text string")
    rows = {(r["doc_id"], r["n_chars"]): r["edited_sha256"] for r in w.with_edits(df).collect()}
    assert rows[(5, 10)] == brute.sha("five a")
    assert rows[(None, 7)] == brute.sha("n1 tfiv")
    assert len(w.with_edits(df).collect()) == 4


def test_general_interface(spark, edge_docs):
    rows = {r["doc_id"]: r for r in w.fingerprints(edge_docs).collect()}
    for d, t in pairs_of(edge_docs):
        pos, h = w.fingerprint(t or "")
        assert [(g["pos"], g["hash"]) for g in rows[d]["grams"]] == list(zip(pos.tolist(), h.tolist()))
