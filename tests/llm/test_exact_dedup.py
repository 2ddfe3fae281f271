"""Exact dedup against a plain grouping, with splits, pages and colliding keys."""

from __future__ import annotations

import re
from collections import defaultdict

import pytest

from strata.llm import exact_dedup
from tests.llm import brute
from tests.llm.conftest import pairs_of

COLUMNS = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def plain(rows):
    groups = defaultdict(list)
    for d, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(d)
    out = []
    for t, ids in groups.items():
        ids.sort(key=lambda d: (d is None, d or 0))
        out += [(d, ids[0], len(ids), i == 0, brute.sha(t)) for i, d in enumerate(ids)]
    return out


def found(df, **options):
    out = exact_dedup.duplicates(df, **options)
    assert out.columns == COLUMNS
    return [tuple(r) for r in out.collect()]


def same(a, b):
    return sorted(a, key=repr) == sorted(b, key=repr)


def test_whole_table(docs):
    assert same(found(docs), plain(pairs_of(docs)))


def test_edges(edge_docs):
    assert same(found(edge_docs), plain(pairs_of(edge_docs)))


def test_empty_table(no_docs):
    assert found(no_docs) == []


def test_null_and_repeated_ids_keep_one_row_a_group(spark):
    rows = [(None, "a  b"), (None, "a b"), (5, "a\tb"), (5, "a b"), (5, "c"), (5, "c"), (None, None), (None, ""), (1, "c ")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert same(found(df), plain(rows))


@pytest.mark.parametrize("options", [{"capacity": 4000}, {"key_bits": 2}, {"capacity": 500, "key_bits": 0}])
def test_splits_pages_and_collisions_change_nothing(spark, docs, options):
    rows = pairs_of(docs)[:120]
    rows += [(10_000 - i, "the hot text that many rows share " * 4) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(16)
    assert same(found(df, **options), plain(rows))


def test_directory_splits_what_is_too_full_and_pages_what_cannot_be_split(spark):
    keys = [(k << 57, 10) for k in range(1, 64)] + [((1 << 62) + (k << 50), 10) for k in range(20)] + [(7 << 60, 1000)] * 3
    buckets, first, total, splits = exact_dedup.directory(spark.createDataFrame(keys, "key long, n_bytes long"), 100, 1)
    got = {r["start"]: r for r in buckets.collect()}
    assert total == 3830 and sum(r["n_bytes"] for r in got.values()) == total
    assert all(r["n_bytes"] <= 100 or r["pages"] > 1 for r in got.values())
    hot = max(s for s in got if s <= 7 << 60)
    assert got[hot]["pages"] == 31 and splits.count() >= 1


def test_a_hot_text_leaves_each_task_once(spark):
    df = spark.createDataFrame([(i, "same text") for i in range(4000)], "doc_id long, text string").repartition(4)
    rows = exact_dedup.text_bytes(df, "doc_id", "text").mapInArrow(exact_dedup._entries(63), exact_dedup._ROWS)
    assert rows.filter("row = entry").count() <= 4
