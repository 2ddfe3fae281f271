from __future__ import annotations

import random
import re

from strata.llm import licenses as li
from strata.llm.queries import op2_license_scan
from tests.llm import brute
from tests.llm.conftest import SF, pairs_of


def contained(text, template):
    """The largest share of the template's shingles in a stretch of its length, margins included."""
    w, t = (brute.BENCH.findall(brute.lower(x or "")) for x in (text, template))
    want = set(zip(t, t[1:]))
    m = max(1, len(t) // 10)
    best = 0.0
    for at in range(-len(t) + 4, max(1, len(w) - 3)):
        part = w[max(0, at - m) : max(0, at + len(t) + m)]
        best = max(best, len(want & set(zip(part, part[1:]))) / len(want))
    return best


def names(df):
    return {r["doc_id"]: {m["name"]: m["containment"] for m in r["licenses"]} for r in df.collect()}


def test_query_on_the_whole_table(spark, docs):
    found = {r["doc_id"]: r for r in op2_license_scan(spark, SF).collect()}
    for d, t in pairs_of(docs):
        got = {x.split(":")[0] for x in found[d]["licenses"].split(";") if x}
        assert found[d]["n_licenses"] == len(got)
        # what stands there word for word is always found
        flat = " ".join(brute.BENCH.findall(brute.lower(t or "")))
        for name, template in li.TEMPLATES.items():
            if re.search(rf"(?:^| ){re.escape(' '.join(brute.BENCH.findall(brute.lower(template))))}(?: |$)", flat):
                assert name in got
        for name in got:
            assert contained(t, li.TEMPLATES[name]) >= li.CONTAINED


def test_edges(edge_docs, no_docs):
    assert all(not x for x in names(li.scan(edge_docs)).values())
    assert li.scan(no_docs).collect() == []


def test_recall_on_edited_copies(spark):
    r = random.Random(3)
    filler = lambda n: [r.choice("abcdefgh") + str(r.randint(0, 999)) for _ in range(n)]
    rows, want = [], {}
    for d in range(600):
        name, template = r.choice(list(li.TEMPLATES.items()))
        words = template.split()
        if d % 2:
            for _ in range(max(0, len(words) // 25)):
                words[r.randrange(len(words))] = "changed"
        text = " ".join(filler(r.randint(0, 90)) + words + filler(r.randint(0, 90)))
        rows.append((d, text))
        want[d] = {n for n, t in li.TEMPLATES.items() if contained(text, t) >= li.CONTAINED}
    got = names(li.scan(spark.createDataFrame(rows, "doc_id long, text string")))
    hits = sum(len(want[d] & set(got[d])) for d in want)
    assert all(set(got[d]) <= want[d] for d in want)
    assert hits / sum(map(len, want.values())) > 0.98
    assert all(want[d] <= set(got[d]) for d in range(0, 600, 2))  # unchanged copies


def test_every_place_of_a_repeated_notice(spark, tmp_path):
    notice, other = (li.TEMPLATES[x].split() for x in ("BSD notice", "MIT"))
    n = len(brute.BENCH.findall(" ".join(notice)))
    changed = ["changed" if i == 9 else w for i, w in enumerate(notice)]
    filler = lambda k: [f"w{k}x{i}" for i in range(k)]
    rows = [
        (0, " ".join(filler(13) + notice + filler(31) + notice + filler(7) + notice)),
        (1, " ".join(notice * 3 + filler(5) + other)),  # back to back
        (2, " ".join(filler(3) + changed + filler(40) + notice)),
        (3, " ".join(notice[:10] + notice[11:] + notice)),  # a word left out
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: [(m["name"], m["start"], m["end"]) for m in r["licenses"]] for r in li.scan(df).collect()}
    assert got[0] == [("BSD notice", a, a + n) for a in (13, 44 + n, 51 + 2 * n)]
    assert sorted(got[1]) == [("BSD notice", a, a + n) for a in (0, n, 2 * n)] + [("MIT", 3 * n + 5, 3 * n + 10)]
    assert got[2] == [("BSD notice", 43 + n, 43 + 2 * n), ("BSD notice", 3, 3 + n)]  # best first
    assert len(got[3]) == 2 and got[3][0] == ("BSD notice", n - 1, 2 * n - 1) and got[3][1][1:] == (0, n - 1)
    df.write.parquet(str(tmp_path / "documents.parquet"))
    query = {r["doc_id"]: (r["n_licenses"], r["licenses"].count("BSD notice:")) for r in op2_license_scan(spark, str(tmp_path)).collect()}
    assert query == {0: (1, 3), 1: (2, 3), 2: (1, 2), 3: (1, 2)}


def test_short_templates_are_refused(docs):
    import pytest

    with pytest.raises(ValueError):
        li.Templates({"x": "four words are few"})
