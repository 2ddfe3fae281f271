"""Dual-tree search against plain scoring of every pair."""

from __future__ import annotations

import random

import numpy as np
import pytest

from strata.llm import lexical_search as ls
from tests.llm import brute
from tests.llm.conftest import SF, pairs_of


def found(docs, items, **options):
    out = ls.search(docs, items, **options)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    rows = [tuple(r) for r in out.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def frames(spark, rows, items, parts=3):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(parts), spark.createDataFrame(items, "item_id long, text string")


def test_whole_table(spark, docs):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert found(docs, items) == brute.ranked(pairs_of(docs), [tuple(r) for r in items.select("item_id", "text").collect()])


def made(seed, n=400, n_items=30):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["é", "ÀB", "x1"]
    text = lambda most: " ".join(r.choices(words, k=r.randint(0, most)))
    rows = [(i, text(40)) for i in r.sample(range(10**6), n)]
    return rows + [(10**7 + i, "w1 w2 W3, w4!") for i in range(n // 2)], [(i, text(6)) for i in range(n_items)]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_texts_with_ties(spark, seed):
    rows, items = made(seed)
    assert found(*frames(spark, rows, items)) == brute.ranked(rows, items)


def test_small_blocks_batches_and_groups_change_nothing(spark, monkeypatch):
    rows, items = made(3)
    monkeypatch.setattr(ls, "_BLOCK_ITEMS", 4)
    monkeypatch.setattr(ls, "_BATCH_DOCS", 100)
    assert found(*frames(spark, rows, items), item_bytes=300) == brute.ranked(rows, items)
    assert found(*frames(spark, rows, items), k=3) == brute.ranked(rows, items, k=3)


def test_edges_nulls_repeats_and_clashing_columns(spark, edge_docs, no_docs):
    items = [(1, "word A b"), (1, "tie"), (2, None), (3, "?!"), (None, "same text"), (4, "absent"), (5, "x" * 5000), (6, "ab 1234")]
    df = spark.createDataFrame([(*i, 7, "q") for i in items], "item_id long, text string, rank int, term string")
    rows = pairs_of(edge_docs)
    assert found(edge_docs, df) == brute.ranked(rows, items)
    assert found(no_docs, df) == set()
    assert found(edge_docs, df.limit(0)) == set()
    rows += [(None, "same text"), (None, "tie"), (9, "same text"), (9, "word word")]
    assert found(spark.createDataFrame(rows, "doc_id long, text string"), df) == brute.ranked(rows, items)


def test_pairs_of_nodes_are_pruned_and_bounds_hold():
    """Most leaf pairs are never scored, and no bound is below a score under it."""
    r = np.random.default_rng(5)
    n, width = 4096, 300
    row = np.repeat(np.arange(n), 12)
    term = np.concatenate([r.choice(width, 12, replace=False) for _ in range(n)])
    term[: n * 6] = (row[: n * 6] // 40 + term[: n * 6] % 7) % width  # topics
    pair, first = np.unique(row * width + term, return_index=True)
    row, term = row[first], term[first]
    c = r.integers(1, 1000, len(row))
    weights = r.integers(100, 9000, width)
    items = [np.unique(r.choice(width, 8)) for _ in range(64)]
    (block,) = ls.Block.all(items, weights)
    own = np.isin(term, block.terms)
    tree = ls.Documents(block, row[own], np.searchsorted(block.terms, term[own]), c[own], np.arange(n))
    scored = []
    plain = tree.score
    tree.score = lambda leaf, at, best: (scored.append(len(at)), plain(leaf, at, best))
    best = ls.Best(block, 10, {})
    tree.search(best)
    dense = np.zeros((n, width))
    dense[row, term] = c
    w = np.zeros((64, width))
    for i, t in enumerate(items):
        w[i, t] = weights[t]
    every = w @ dense.T
    for i, rows in zip(block.numbers, best.rows):
        want = sorted((-int(s), d) for d, s in enumerate(every[i]))[:10]
        assert rows == [x for x in want if x[0] < 0]
    assert sum(scored) < 0.8 * 64 * n / ls.LEAF
    for level, nodes in enumerate(tree.up):
        bound = block.up[0] @ nodes.T
        true = np.maximum.reduceat(every[block.numbers], np.arange(0, n, ls.LEAF * ls.FAN**level), axis=1)
        assert (bound >= true).all()
