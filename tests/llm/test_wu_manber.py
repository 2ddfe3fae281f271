from __future__ import annotations

import random

from strata.llm import wu_manber as m
from strata.llm.queries import op5_wu_manber
from tests.llm import brute
from tests.llm.conftest import SF, pairs_of


def check(df, rows, items):
    want = {d: (n, h, len(i), brute.sha(",".join(i)), h > 0) for d, (n, h, i) in brute.contaminated(rows, items).items()}
    found = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in df.collect()}
    assert found == want


def test_query_on_the_whole_tables(spark, docs):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    found = op5_wu_manber(spark, SF)
    assert found.filter("contaminated").count() > 0
    check(found, pairs_of(docs), items)


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_edges(spark, edge_docs, no_docs):
    items = [(1, "tie tie"), (2, "WORD"), (3, None), (4, ""), (5, "... !"), (6, "same TEXT, here"), (6, "ab ab ab ab ab ab ab ab ab ab ab"), (7, "é ü"), (8, "x" * 5000)]
    check(m.contamination(edge_docs, bench(spark, items)), pairs_of(edge_docs), items)
    assert m.contamination(no_docs, bench(spark, items)).collect() == []
    check(m.contamination(edge_docs, bench(spark, [])), pairs_of(edge_docs), [])


def test_random_texts_of_few_words(spark):
    r = random.Random(6)
    text = lambda n: " ".join(r.choice(["a", "B", "c1", "é", "dd"]) for _ in range(n)) if n else ""
    rows = [(i, text(r.randint(0, 200))) for i in range(60)]
    items = [(i, text(r.choice([0, 1, 2, 4, 7, 9, 10, 11, 14]))) for i in range(40)] + [(99, rows[3][1]), (100, rows[5][1][:60])]
    items = [x for x in items if len(x[1].split()) != 1] + [(50, "zz")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    check(m.contamination(docs, bench(spark, items)), rows, items)


def test_blocks_of_a_large_benchmark(spark, docs):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = pairs_of(docs)
    check(m.contamination(docs, bench(spark, items), block_bytes=8000), rows, items)


def test_shifts_pass_over_no_occurrence():
    found = m.patterns([("1", b"a b c d e f g h i j"), ("2", b"c d e f g h i j k l")])
    s = m.searchers(found)[0]
    assert s.m == 10 and int(s.table.max()) == 9


def test_tables_of_a_full_block_are_small_and_equal_patterns_are_one():
    import tracemalloc

    r = random.Random(8)
    vocabulary = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 9))) for _ in range(20_000)]
    items = [(str(i), " ".join(r.choices(vocabulary, k=2000)).encode()) for i in range(160)]
    items += [("again", items[5][1]), ("short", b"Only three words"), ("none", b" .. ")]
    size = sum(len(t) for _, t in items)
    tracemalloc.start()
    found = m.patterns(items)
    driver = tracemalloc.get_traced_memory()[0]
    tables = m.searchers(found)
    now, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert [s.m for s in tables] == [3, 10]
    assert driver < 8 * size and now < 16 * size + (1 << 25) and peak < 40 * size + (1 << 25)
    s = tables[1]
    assert len(s.first) == 160 * 1991 and len(s.row) == 161 * 1991
    w = items[5][1].split()[7:17]
    (p,) = [p for p in range(len(s.first)) if s._text(s.first[p]) == b" ".join(w)]
    assert s.items(p) == ["5", "again"]
