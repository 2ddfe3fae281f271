from __future__ import annotations

from collections import defaultdict

import numpy as np

from strata.llm import token_counts as t
from strata.llm.queries import BYTE_RANKS, op7_token_counts, vocabulary
from tests.llm.conftest import SF, pairs_of


def brute(text, coding):
    """Tokens by section, walking over the bytes of every token."""
    found = t.sections(text)
    owner = [i for i, (_, a, b) in enumerate(found) for _ in text[a:b].encode("utf-8")]
    start, most, share = defaultdict(int), defaultdict(int), defaultdict(float)
    at = 0
    for i in coding.encode_ordinary(text):
        n = len(coding.decode_single_token_bytes(i))
        own = owner[at : at + n]
        start[own[0]] += 1
        most[max(sorted(set(own)), key=own.count)] += 1
        for s in own:
            share[s] += 1 / n
        at += n
    assert at == len(text.encode("utf-8"))
    return found, start, most, share


def check(df, rows):
    coding, _ = t.coding(vocabulary(BYTE_RANKS))
    got = defaultdict(dict)
    for r in df.collect():
        got[r["doc_id"]][r["section"]] = r
    for d, text in rows:
        if not text:
            assert d not in got
            continue
        found, start, most, share = brute(text, coding)
        assert "".join(text[a:b] for _, a, b in found) == text
        assert len(got[d]) == len(found)
        for i, (kind, a, b) in enumerate(found):
            r = got[d][i]
            assert (r["kind"], r["start"], r["end"], r["n_tokens"], r["n_tokens_most"]) == (kind, a, b, start[i], most[i])
            assert abs(r["n_tokens_share"] - share[i]) < 1e-6


def test_query_on_the_whole_table(spark, docs):
    check(op7_token_counts(spark, SF), pairs_of(docs))


def test_edges(edge_docs, no_docs):
    check(t.section_counts(edge_docs, vocabulary(BYTE_RANKS)), pairs_of(edge_docs))
    assert t.section_counts(no_docs, vocabulary(BYTE_RANKS)).collect() == []


def test_boundary_tokens(spark):
    texts = ["a\n\n\n\nb", "# h\n\n- x\n- y\n\n1. z\n|a|b|\n\nend\n", "\n\n\n", "é\n\n字字\n\n\n😀", " \n x \n\n\n\n\n\n y"]
    rows = list(enumerate(texts))
    check(t.section_counts(spark.createDataFrame(rows, "doc_id long, text string"), vocabulary(BYTE_RANKS)), rows)


def test_rules_conserve_the_tokens():
    rng = np.random.default_rng(1)
    for _ in range(200):
        ends = np.cumsum(rng.integers(1, 9, rng.integers(1, 30)))
        cuts = np.unique(np.concatenate([[0, ends[-1]], rng.integers(0, ends[-1] + 1, 5)]))
        for x in t.attribute(ends, cuts):
            assert abs(x.sum() - len(ends)) < 1e-9


def test_long_white_space_is_cut_by_the_patterns_own_rule(spark, monkeypatch):
    import random
    import re

    coding, _ = t.coding(vocabulary(BYTE_RANKS))
    texts = [" " * 5_000_000 + "x", "\n" * 2_000_000, "a b" + " \t\r\n\u3000" * 300_000 + "z"]
    for x in texts:
        assert coding.decode(t.encode(coding, x)) == x
    rows = t.section_counts(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), vocabulary(BYTE_RANKS)).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in rows if r["section"] == 0} == {i: len(t.encode(coding, x)) for i, x in enumerate(texts)}
    monkeypatch.setattr(t, "_LONG_BLANK", re.compile(t._LONG_BLANK.pattern.replace("4096", "3")))
    r = random.Random(1)
    for _ in range(3000):
        x = "".join(r.choice([" ", "  ", "\t", "\n", "\n\n", "a", "B1", "é", "!", "'s", "\u3000", "\x1f", "\x85"]) for _ in range(r.randint(0, 20)))
        assert t.encode(coding, x) == coding.encode_ordinary(x), repr(x)
