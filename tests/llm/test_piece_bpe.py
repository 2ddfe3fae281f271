from __future__ import annotations

import random

import pytest
import sentencepiece

from strata.llm import piece_bpe as p
from strata.llm.queries import PIECE_MODEL, op4_piece_bpe, vocabulary
from tests.llm import brute
from tests.llm.conftest import SF, pairs_of


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=vocabulary(PIECE_MODEL))


@pytest.fixture(scope="module")
def own():
    return p.PieceModel(vocabulary(PIECE_MODEL))


def check(df, rows, library):
    found = {r["doc_id"]: tuple(r)[1:] for r in df.collect()}
    assert len(found) == len(rows)
    for d, t in rows:
        ids = library.encode(t or "", add_eos=True)
        assert found[d] == (len(ids), brute.sha(" ".join(map(str, ids))), brute.sha(library.decode(ids)))


def test_query_on_the_whole_table(spark, docs, library):
    check(op4_piece_bpe(spark, SF), pairs_of(docs), library)


def test_edges(edge_docs, no_docs, library):
    path = vocabulary(PIECE_MODEL)
    check(p.digests(edge_docs, path), pairs_of(edge_docs), library)
    assert p.digests(no_docs, path).collect() == []
    rows = {r["doc_id"]: r for r in p.encoded(edge_docs, path).collect()}
    for d, t in pairs_of(edge_docs):
        assert rows[d]["ids"] == library.encode(t or "", add_eos=True)
        assert rows[d]["decoded"] == library.decode(rows[d]["ids"])


def test_random_texts_like_the_library(own, library):
    r = random.Random(11)
    parts = ["a", "e", "s", "th", "ing", " ", "  ", "      ", "\n", "\t", "é", "é", "Ω", "字", "😀", "▁", "<s>", "</s>", "<0x41>", "\x00", "AA", "----", "==", "0", "�", "‍", "ﬁ"]
    for _ in range(4000):
        t = "".join(r.choice(parts) for _ in range(r.randint(0, 30)))
        ids = [*own.encode(t), own.end_id]
        assert ids == library.encode(t, add_eos=True), t
        assert own.decode(ids) == library.decode(ids), t


def test_runs_of_one_character(own, library):
    for c in " a-=0\néh":
        for n in range(1, 70):
            assert own.encode(c * n) == library.encode(c * n), (c, n)


def test_backtracking_equals_merging(own):
    """The result is that of the definition, and not the greedy one."""
    r = random.Random(12)
    greedy_differs = 0
    for _ in range(2000):
        word = "▁" + "".join(r.choice("abehinorst") for _ in range(r.randint(1, 14)))
        got = [own.piece[i] for i in own.split(word)]
        assert got == own.merge(word)
        greedy, at = [], 0
        while at < len(word):
            n = max(k for k in range(1, len(word) - at + 1) if k == 1 or word[at : at + k] in own.ids)
            greedy.append(word[at : at + n])
            at += n
        greedy_differs += greedy != got
    assert greedy_differs


def test_full_tables_of_remembered_words_change_nothing(library, monkeypatch):
    monkeypatch.setattr(p, "_REMEMBER", 5)
    own = p.PieceModel(vocabulary(PIECE_MODEL))
    r = random.Random(13)
    for _ in range(300):
        t = " ".join("".join(r.choice("aeinst") for _ in range(r.randint(1, 6))) for _ in range(20))
        assert own.encode(t) == library.encode(t)


def test_decoding_bad_bytes(own, library):
    r = random.Random(14)
    for _ in range(3000):
        ids = [r.choice([r.randint(3, 258), r.randint(3, 258), r.randint(259, 31999), 2, 1, 0]) for _ in range(r.randint(0, 8))]
        assert own.decode(ids) == library.decode(ids), ids
