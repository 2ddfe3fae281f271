"""The registered queries against their SQL, and the pipeline."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
import corpus_pipeline as cp
from strata.llm import odd_sketch, piece_bpe, secret_scan, wu_manber
from strata.llm.queries import PIECE_MODEL, QUERIES, vocabulary
from strata.llm.sql import ORACLE_SQL
from tests.llm import brute
from tests.llm.conftest import SF, pairs_of
from tests.oracle_check import compare


def test_all_are_registered():
    assert {*QUERIES, "pipeline"} <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, name):
    res = compare(spark, SF, [name], verbose=True)[name]
    assert res[0] == "MATCH", res


def test_pipeline_equals_brute_force(spark, docs):
    """Each stage's decision from the plain versions, over the whole table."""
    import sentencepiece

    found = {r["doc_id"]: r for r in cp.run(spark, SF).collect()}
    from strata.llm import language_id

    model = language_id.fit(docs)
    rows = [(d, t) for d, t in pairs_of(docs) if any(c.isalpha() for c in t or "") and model.predict(t)[1] >= cp.LEAST_SCORE]
    kept = brute.near(rows)
    rows = [(d, t) for d, t in rows if kept[d][2]]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaks = brute.contaminated(rows, items)
    rows = [(d, t) for d, t in rows if not leaks[d][1]]
    library = sentencepiece.SentencePieceProcessor(model_file=vocabulary(PIECE_MODEL))
    assert set(found) == {d for d, _ in rows} and len(rows) < docs.count()
    for d, t in rows:
        masked = secret_scan.redact(t, secret_scan.spans(t))
        assert not brute.secrets(masked)
        ids = library.encode(masked, add_eos=True)
        assert found[d]["ids"] == ids and found[d]["decoded"] == library.decode(ids) == masked


def test_unlearned_languages_and_junk_go_and_clean_documents_stay(spark, docs):
    import random

    r = random.Random(4)
    junk = " ".join("".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(2, 9))) for _ in range(80))
    bad = ["今天天气很好，我们去公园散步。" * 5, "Сегодня хорошая погода, и мы идем гулять в парк. " * 4, "Η γρήγορη καφέ αλεπού πηδάει πάνω από το σκυλί", junk]
    rows = [(10**9 + i, t, "en", "s", len(t)) for i, t in enumerate(bad)]
    df = docs.select(*cp.COLUMNS).unionByName(spark.createDataFrame(rows, docs.select(*cp.COLUMNS).schema))
    kept = {r["doc_id"] for r in cp.identify_language(spark, df, SF).select("doc_id").collect()}
    assert kept == {d for d, t in pairs_of(docs) if any(c.isalpha() for c in t or "")}


def test_stages_take_edge_cases_and_empty_tables(spark, edge_docs, no_docs):
    for name, stage in cp.STAGES:
        for df in (edge_docs, no_docs):
            out = stage(spark, df, SF)
            if name != "encode":
                assert out.columns == cp.COLUMNS
                assert out.dtypes == edge_docs.select(*cp.COLUMNS).dtypes
            n = out.count()
            assert n == 0 if df is no_docs else n > 0


def test_stages_judge_repeats_alike_and_near_dedup_leaves_one(spark):
    rows = [(1, "the same text of the day here", "en", "s", 5), (1, "the same text of the day here", "en", "s", 5), (None, "the same text of the day here", None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in cp.STAGES[1:]:
        kept = stage(spark, df, SF).collect()
        assert len(kept) == (1 if name == "near_dedup" else 3), name
        if name == "near_dedup":
            assert kept[0]["doc_id"] == 1


def test_operators_ignore_extra_columns(edge_docs):
    assert odd_sketch.near_duplicates(edge_docs).columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert wu_manber.clean(edge_docs, edge_docs.sparkSession.createDataFrame([(1, "tie tie tie")], "item_id long, text string")).columns == edge_docs.columns
    assert piece_bpe.encoded(edge_docs, vocabulary(PIECE_MODEL)).columns == ["doc_id", "ids", "decoded"]
