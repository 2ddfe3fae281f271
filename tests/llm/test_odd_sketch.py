from __future__ import annotations

import math
import random

import numpy as np
import pytest

from strata.llm import odd_sketch as o
from strata.llm.common import tidied, written
from strata.llm.components import components
from strata.llm.queries import op3_odd_sketch
from strata.session import shared_dir
from tests.llm import brute
from tests.llm.conftest import SF, pairs_of


def check(df, rows):
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}
    assert found == brute.near(rows)


def test_query_on_the_whole_table(spark, docs):
    check(op3_odd_sketch(spark, SF), pairs_of(docs))


def test_edges(edge_docs, no_docs):
    check(o.near_duplicates(edge_docs), pairs_of(edge_docs))
    assert o.near_duplicates(no_docs).collect() == []


def test_null_ids_take_part_and_repeats_agree(spark):
    rows = [(None, "a b c"), (3, "a b c"), (3, "a b c"), (2, "a b c"), (None, None), (None, "d e f"), (None, "d e f")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in o.near_duplicates(df).collect()), key=str)
    assert got == sorted([(None, 2, False), (None, None, True), (2, 2, True), (3, 2, False), (3, 2, False), (None, None, True), (None, None, True)], key=str)
    assert sorted(map(tuple, o.deduplicated(df).collect()), key=str) == sorted([(2, "a b c"), (None, None), (None, "d e f")], key=str)


def test_an_id_that_repeats_with_another_text(spark):
    """Each text has its own links, and of each group one row stays."""
    a, b = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")
    rows = [(1, a, 7), (2, a, 7), (2, b, 7), (3, b + " more", 7), (4, "", 7), (4, "", 7), (4, None, 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, key1 int")
    got = {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in o.near_duplicates(df).collect()}
    assert got == {(1, 59, 1, True), (2, 59, 1, False), (2, 59, 2, True), (3, 60, 2, False), (4, 0, 4, True)}
    assert sorted(map(tuple, o.deduplicated(df).collect()), key=str) == sorted([rows[0], rows[2], *rows[4:]], key=str)


def test_one_row_of_a_group_whose_id_repeats(spark):
    a = " ".join(f"a{i}" for i in range(60))
    df = spark.createDataFrame([(1, a), (1, a + " x"), (1, a + " x y"), (1, a), (5, a)], "doc_id long, text string")
    (row,) = o.deduplicated(df).collect()
    assert row["doc_id"] == 1 and row["text"].startswith(a)


def test_only_the_tables_that_the_result_reads_are_left(spark, docs):
    import os

    at = os.path.join(shared_dir(spark).removeprefix("file:"), "strata")
    before = set(os.listdir(at)) if os.path.isdir(at) else set()
    with tidied(spark) as keep:
        found = o.near_duplicates(docs)
        left = {x.rsplit("-", 1)[0] for x in set(os.listdir(at)) - before}
        assert left == {"near-features", "near-of"}
        keep.append(written(found, "near-found"))
    assert {x.rsplit("-", 1)[0] for x in set(os.listdir(at)) - before} == {"near-found"}
    assert keep[0].count() == docs.count()
    with pytest.raises(ValueError), tidied(spark):
        written(docs, "near-lost")
        raise ValueError
    assert not any(x.startswith("near-lost") for x in os.listdir(at))


@pytest.mark.parametrize("seed", [1, 2])
def test_chains_stars_and_near_misses(spark, monkeypatch, seed):
    """Families of edited copies around the threshold, some in chains whose
    ends are far apart, and one large family: all links, also with many
    blocks of a bucket."""
    monkeypatch.setattr(o, "BLOCK", 16)
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(4))
    rows, d = [], 0
    for family in range(30):
        n = r.choice([6, 12, 40, 120])
        base = [word() for _ in range(n)]
        for copy in range(90 if family == 0 else r.randint(1, 8)):
            text = list(base)
            for _ in range(r.choice([0, 1, 1, 2, max(1, n // 20), n // 12])):
                text[r.randrange(n)] = word()
            rows.append((d, " ".join(text)))
            d += 1
            if r.random() < 0.5:
                base = text  # a chain
    r.shuffle(rows)
    check(o.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")), rows)


def test_sketch_estimates_high_likeness():
    rng = np.random.default_rng(8)
    for share in (0.95, 0.9, 0.8, 0.7):
        common, rest = rng.integers(1, 1 << 62, int(2000 * share), dtype=np.uint64), 1000 - int(1000 * share)
        a = np.unique(np.concatenate([common, rng.integers(1, 1 << 62, rest, dtype=np.uint64)]))
        b = np.unique(np.concatenate([common, rng.integers(1, 1 << 62, rest, dtype=np.uint64)]))
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        s = o.odd_sketches(o.samples(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)])))
        assert abs(float(o.likeness(np.unpackbits(s[0] ^ s[1]).sum())) - true) < 0.1


def loss(likeness):
    """The probability that a pair misses all bands or is dropped by its sketch."""
    odd = np.zeros(o.BITS + 2)  # by the number of odd cells
    odd[0] = 1
    n = np.arange(o.BITS + 2)
    dropped = [0.0]
    for _ in range(o.SAMPLES):
        for _ in range(2):  # each sample that differs sets a bit in both
            up, down = odd * np.clip(o.BITS - n, 0, None) / o.BITS, odd * n / o.BITS
            odd = np.append(0, up[:-1]) + np.append(down[1:], 0)
        dropped.append(odd[o.MOST_BITS + 1 :].sum())
    differ = [math.comb(o.SAMPLES, d) * (1 - likeness) ** d * likeness ** (o.SAMPLES - d) for d in range(o.SAMPLES + 1)]
    return (1 - likeness**o.ROWS) ** o.BANDS + float(np.dot(differ, dropped))


def test_a_pair_at_the_threshold_is_hardly_ever_lost():
    assert loss(o.THRESHOLD / 100) < 1e-9


def test_whole_set_bitmaps_bound_the_difference_from_below():
    rng = np.random.default_rng(9)
    for n in (1, 5, 100, 130, 500, 5000, 30_000):
        a = np.unique(rng.integers(1, 1 << 62, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[: int(0.9 * n)], rng.integers(1, 1 << 62, n // 9 + 1, dtype=np.uint64)]))
        x, y = o.parity(a), o.parity(b)
        size = 8 * min(len(x), len(y))
        apart = int(np.bitwise_count(o.folded(x, size) ^ o.folded(y, size)).sum())
        true = len(np.setxor1d(a, b))
        assert apart <= true and (apart - true) % 2 == 0
        if n <= 5000:
            assert apart >= 0.8 * true - 2


def test_components_of_paths_hubs_and_loops(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(900 + i, 900) for i in range(1, 200)] + [(5, 5), (7, 6), (6, 7), (160, 900)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 100 for i in range(100, 161)} | {900 + i: 100 for i in range(200)} | {6: 6, 7: 6}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_lower_thresholds_are_refused(docs):
    with pytest.raises(ValueError):
        o.near_duplicates(docs, threshold=50)
