from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import substring_dedup as s
from strata.llm.queries import op6_substring_dedup
from tests.llm import brute
from tests.llm.conftest import SF, pairs_of


def check(df, rows, window=50):
    want = {d: (n, g, brute.sha(k)) for d, (n, g, k) in brute.deduped(rows, window).items()}
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in df.collect()} == want


def test_query_on_the_whole_table(spark, docs):
    found = op6_substring_dedup(spark, SF)
    assert found.filter("n_removed > 0").count() > 0
    check(found, pairs_of(docs))


def test_edges(edge_docs, no_docs):
    check(s.removed(edge_docs), pairs_of(edge_docs))
    assert s.removed(no_docs).collect() == []


def test_null_and_repeated_ids(spark):
    long = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(None, long), (4, long), (4, long), (9, "x " + long)], "doc_id long, text string")
    rows = sorted(((r["doc_id"], r["n_removed"]) for r in s.removed(df).collect()), key=str)
    assert rows == sorted([(None, 0), (4, 0), (4, 0), (9, 60)], key=str)
    # a null id is not taken for the id 0
    df = spark.createDataFrame([(None, long), (0, long), (-3, "x " + long)], "doc_id long, text string")
    rows = sorted(((r["doc_id"], r["n_removed"]) for r in s.removed(df).collect()), key=str)
    assert rows == sorted([(None, 0), (0, 60), (-3, 0)], key=str)


@pytest.mark.parametrize("chunk", [50, 400_000])
def test_overlaps_repeats_and_hot_passages(spark, monkeypatch, chunk):
    monkeypatch.setattr(s, "_CHUNK_WINDOWS", chunk)
    r = random.Random(2)
    words = lambda n: [r.choice("abcdefgh") + str(r.randint(0, 60)) for _ in range(n)]
    hot, rows = words(70), []
    for d in range(120):
        t = words(r.randint(0, 120))
        if d % 3 == 0:
            at = r.randint(0, len(t))
            t[at:at] = hot
        if rows and r.random() < 0.4:
            other = rows[r.randrange(len(rows))][1].split()
            a = r.randint(0, len(other))
            t += other[a : a + r.randint(30, 90)]
        if d % 10 == 0:
            t += ["same"] * 80  # a window that repeats inside its document
        rows.append((d, " ".join(t)))
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    check(s.removed(df), rows)
    check(s.removed(df, window=12, gram=5), rows, 12)


def test_kept_text(spark):
    long = " ".join(f"w{i}" for i in range(50))
    df = spark.createDataFrame([(1, long), (2, f"head\n{long} tail")], "doc_id long, text string")
    assert {r["doc_id"]: r["kept_text"] for r in s.removed(df, keep_text=True).collect()} == {1: long, 2: "head tail"}


def test_the_sketch_never_counts_too_little(spark, docs):
    """Also when it is far too small, it only lets more windows through."""
    rows = s.text_bytes(docs, "doc_id", "text").withColumn("key", F.xxhash64("text"))
    batch = rows.toArrow().combine_chunks().to_batches()[0]
    anchor, row = s.Windows(batch, 50, 25).anchors()
    ids, code = batch.column("doc_id").to_numpy()[row], s.codes(anchor).view(np.int64)
    _, inverse, n = np.unique(anchor, return_inverse=True, return_counts=True)
    everything = set(zip(ids.tolist(), code.tolist()))
    twice = {x for x, k in zip(zip(ids.tolist(), code.tolist()), n[inverse].tolist()) if k > 1}
    for slices in (1, 3, 16):
        got = {(r["doc_id"], r["code"]) for r in s.repeated_anchors(rows, slices=slices).collect()}
        assert twice <= got <= everything
    assert len(got - twice) < 0.1 * len(everything - twice)


@pytest.mark.parametrize("gigabytes", [1, 5, 16, 64])
def test_the_sketch_grows_with_the_corpus(gigabytes):
    """The share of unique anchors that pass does not rise with the size (by
    one slice's load, as slices are alike)."""
    slices = s.slices_for(gigabytes << 30)
    anchors = (gigabytes << 30) / 6.5 * 2 / 27
    r = np.random.default_rng(gigabytes)
    code = s.codes(r.integers(0, 1 << 64, int(anchors / slices), dtype=np.uint64))
    assert (s.estimates(code) > 1).mean() < 0.04
    assert len(np.unique(s.slice_of(code, slices))) > min(slices, 1000) * 0.5


@pytest.mark.parametrize("chunk", [3, 500_000])
def test_a_full_sketch_or_a_tiny_chunk_changes_no_result(spark, docs, monkeypatch, chunk):
    monkeypatch.setattr(s, "slices_for", lambda *_: 1)
    monkeypatch.setattr(s, "estimates", lambda code: np.full(len(code), 2))
    monkeypatch.setattr(s, "_CHUNK_ANCHORS", chunk)
    check(s.removed(docs), pairs_of(docs))
