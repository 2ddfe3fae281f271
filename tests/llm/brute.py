"""Plain Python versions of the contracts, written apart from the operators."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
BENCH = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def edits(rows):
    """(doc_id, text) -> {doc_id: (n_chars, edited text, next text)}; ids are distinct."""
    rows = sorted(((d, t or "") for d, t in rows), reverse=True)
    out = {}
    for i, (d, t) in enumerate(rows):
        nxt = rows[(i + 1) % len(rows)][1]
        half = len(t) // 2
        out[d] = (len(t), t[: len(t) - half] + nxt[:half], nxt)
    return out


def winnow(text: str, k: int, w: int):
    """Positions of the chosen k-grams, given as (position, gram), by the operator's gram order."""
    from strata.llm.winnowing import _kgram_hashes

    import numpy as np

    if not text:
        return []
    k = min(k, len(text))
    h = [int(_kgram_hashes(np.array([ord(c) for c in text[i : i + k]], np.uint32), k)[0]) for i in range(len(text) - k + 1)]
    w = min(w, len(h))
    chosen = {max((i for i in range(s, s + w) if h[i] == min(h[s : s + w]))) for s in range(len(h) - w + 1)}
    return [(i, h[i]) for i in sorted(chosen)]


def shingles(text):
    words = SPACE.findall(lower(text or ""))
    if len(words) < 2:
        return {tuple(words)} if words else set()
    return set(zip(words, words[1:]))


def near(rows, share=80):
    """{doc_id: (n_shingles, component_id, kept)}, by a prefix filter that is exact."""
    sets = {d: shingles(t) for d, t in rows}
    often = defaultdict(int)
    for s in sets.values():
        for x in s:
            often[x] += 1
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    index = defaultdict(list)
    for d, s in sets.items():
        need = -(-share * len(s) // 100)
        tried = set()
        for x in sorted(s, key=lambda x: (often[x], x))[: len(s) - need + 1]:
            for other in index[x]:
                if other not in tried:
                    tried.add(other)
                    o = sets[other]
                    if 100 * len(s & o) >= share * len(s | o):
                        a, b = find(d), find(other)
                        parent[max(a, b)] = min(a, b)
            index[x].append(d)
    return {d: (len(s), find(d), find(d) == d) for d, s in sets.items()}


def contaminated(rows, items, window=10):
    """{doc_id: (n_words, n_hit, item ids)}"""
    patterns = defaultdict(set)
    for item, text in items:
        w = BENCH.findall(lower(text or ""))
        for i in range(max(1, len(w) - window + 1) if w else 0):
            patterns[tuple(w[i : i + window])].add(str(item))
    sizes = {len(p) for p in patterns}
    out = {}
    for d, text in rows:
        w = BENCH.findall(lower(text or ""))
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (p := tuple(w[i : i + n])) in patterns:
                    hit.update(range(i, i + n))
                    found |= patterns[p]
        out[d] = (len(w), len(hit), sorted(found))
    return out


def deduped(rows, window=50):
    """{doc_id: (n_words, n_removed, kept text)}"""
    words = {d: SPACE.findall(t or "") for d, t in rows}
    least = {}
    for d in sorted(words):
        w = words[d]
        for i in range(len(w) - window + 1):
            least.setdefault(tuple(w[i : i + window]), d)
    out = {}
    for d, w in words.items():
        gone = set()
        for i in range(len(w) - window + 1):
            if least[tuple(w[i : i + window])] < d:
                gone.update(range(i, i + window))
        out[d] = (len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))
    return out


def secrets(text):
    """Base spans by the contract's patterns, tried at every place."""
    text = text or ""
    word = "[A-Za-z0-9+/_.=-]+"
    name = "(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    kinds = [("assign", re.compile(f"{name}[\"']?\x20*[:=]\x20*[\"']?({word})"), 1, 6), ("access", re.compile("AKIA[A-Z0-9]+"), 0, 20), ("hex", re.compile("[0-9a-f]+"), 0, 24)]
    out = []
    for rank, (kind, pattern, group, least) in enumerate(kinds):
        at = 0
        while m := pattern.search(text, at):
            at = m.end()
            if len(m[group]) >= least:
                out.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
    return [s for *_, s in sorted(out)]


def trie(rows):
    """(conv_id, turn, role, text) -> the trie's nodes as the contract has them, as tuples."""
    import zlib

    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    for x in own.values():
        x.sort()
    built = {}
    for c, x in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(t[2:] for t in own.get(c - c % 5, [])[:h] + x[h:])
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, x in built.items():
        ends[x].append(c)
        for d in range(len(x) + 1):
            members[x[:d]].append(c)
            if d:
                children[x[: d - 1]].add(x[:d])
    saved, leaves = {}, {}
    for u in sorted(members, key=len, reverse=True):
        size = len(u[-1][1].encode()) if u else 0
        saved[u] = (len(members[u]) - 1) * size + sum(saved[v] for v in children[u])
        leaves[u] = sum(leaves[v] for v in children[u]) or 1
    return [
        (min(m), len(u), min(members[u[:-1]]) if u else None, len(m), len(children[u]), leaves[u], saved[u], sha(",".join(map(str, sorted(ends[u])))))
        for u, m in members.items()
    ]


def ranked(rows, items, k=10):
    """(doc_id, text), (item_id, text) -> {(item_id, rank, doc_id, score)}."""
    import math
    from collections import Counter

    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    docs = [(d, Counter(term.findall(lower(t or "")))) for d, t in rows]
    docs = [(d, c, c.total()) for d, c in docs if c]
    n_docs, n_terms = len(docs), sum(n for _, _, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    wanted = defaultdict(set)
    for i, t in items:
        wanted[i] |= {x for x in term.findall(lower(t or "")) if x in df}
    w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    out = set()
    for i, ts in wanted.items():
        scored = []
        for d, c, n in docs:
            m = 10 + 90 * n * n_docs // n_terms
            s = sum(w[t] * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in ts if t in c)
            if s:
                scored.append((-s, d is None, d))
        out |= {(i, r, d, -s) for r, (s, _, d) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)}
    return out
