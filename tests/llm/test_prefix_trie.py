"""The prefix trie against a plain one."""

from __future__ import annotations

import random

import pytest

from strata.llm import prefix_trie
from tests.llm import brute
from tests.llm.conftest import SF

KIND = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def check(spark, rows, df=None, **options):
    out = prefix_trie.nodes(spark.createDataFrame(rows, KIND) if df is None else df, **options)
    assert out.columns == COLUMNS
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(brute.trie(rows), key=repr)


def test_whole_table(spark):
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    check(spark, [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()], df)


def made(seed: int, n: int = 60, longest: int = 14):
    """Conversations over few texts, so that many share prefixes or are equal."""
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(400), n):
        stem = r.choice([[], ["a"], ["a", "bb"] * 3, ["x"] * 9])
        rows += [(c, t, r.choice(["user", "user", None]), text) for t, text in enumerate((stem + [r.choice(["é", "", "long text", None]) for _ in range(r.randint(0, longest))])[: longest])]
    return rows


@pytest.mark.parametrize("block", [1, 3, 4])
def test_shared_prefixes_and_any_block_length(spark, block):
    check(spark, made(block), block=block)


def test_slots_of_turns_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SLOT", 2)
    monkeypatch.setattr(prefix_trie, "_IDS", 3)
    check(spark, made(9, 40))


def test_nulls_ties_repeats_negative_turns_and_clashing_columns(spark):
    rows = [
        (None, 0, "user", "lost"), (5, None, "b", "second"), (5, None, "a", "first"), (5, -3, "user", "third"), (5, 0, None, None), (5, 0, None, None),
        (6, 0, "user", "x"), (7, 1, "", ""), (7, 0, "", ""), (8, 2, "a", "b"), (9, 2, "ab", ""), (1000003, 0, "u", "t"),
    ]
    df = spark.createDataFrame([(*r, 1, "k", 2) for r in rows], KIND + ", depth int, x string, j int")
    check(spark, rows, df)


def test_turnless_conversations_belong_to_the_root(spark):
    # crc32("1") % 9 and the like leave short conversations without a turn when their base is absent
    rows = [(c, 0, "user", "only") for c in range(1, 60) if c % 5]
    assert any(u[1] == 0 and u[3] == len(rows) for u in brute.trie(rows))
    check(spark, rows)


def test_all_turnless_and_empty_tables(spark):
    import zlib

    rows = [(c, 0, "user", "only") for c in range(1, 60) if c % 5 and zlib.crc32(str(c).encode()) % 9]
    check(spark, rows)
    check(spark, [], spark.createDataFrame([], KIND))
