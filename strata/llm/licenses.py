"""License scans: MinHash bands over text windows, then exact containment.

Templates are cut into windows of 4, 8 or 32 words (by their length) at every
word; documents into windows of the same sizes, one every half window. So an
unchanged template, wherever it stands, holds a whole document window that
equals a template window and meets it in every band. Each window's set of
2-word shingles has ``BANDS`` bands of ``ROWS`` MinHash values: windows of
likeness s meet with probability 1 - (1 - s**ROWS)**BANDS, over 0.99 from
s = 0.6 on. Every window that meets one proposes its template at that place;
a place is a match where at least ``CONTAINED`` of the template's distinct
shingles are in the document's words from there on (as many as the template
has, and a margin on both sides). Of each template all places are reported
that do not overlap a better one (equal containment: one that has more of the
shingles without the margin, then an earlier one). Copies with words left
out may stand closer than the template is long: a place that overlaps others
by the margin at most is cut to the words between them.

Words are runs of letters and digits, A-Z lower-cased. Templates need five
words or more. Edge cases: null, empty and short texts have no match;
repeated rows give repeated results; extra columns are not read.
"""

from __future__ import annotations

from bisect import bisect, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strata.llm.common import mix64, pieces, raw, text_bytes, word_hashes, word_spans
from strata.llm.wu_manber import WORDS

BANDS = 12
ROWS = 2
CONTAINED = 0.8
_rng = np.random.default_rng(77)
_XOR = _rng.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64)
_ODD = _rng.integers(1, 1 << 62, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

#: Public license statements and notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0 notice": "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "GPL-3.0": "licensed under the GNU General Public License, version 3",
    "GPL-2.0": "licensed under the GNU General Public License, version 2",
    "GPL notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "LGPL-3.0": "licensed under the GNU Lesser General Public License, version 3",
    "AGPL-3.0": "licensed under the GNU Affero General Public License, version 3",
    "MIT": "Released under the MIT License",
    "MIT notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "BSD-3-Clause": "Licensed under the BSD 3-Clause License",
    "BSD notice": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "ISC notice": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "CC-BY-4.0": "licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
}


def window_size(words: int) -> int:
    """With windows each half size apart, one lies whole inside ``words`` words."""
    return 32 if words >= 47 else 8 if words >= 11 else 4


def shingle_hashes(h: np.ndarray) -> np.ndarray:
    return mix64(h[:-1] * np.uint64(0xD1342543DE82EF95) + h[1:])


def band_keys(values: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """(bands, windows): keys of the windows of ``size`` shingles at ``starts``."""
    out = np.empty((BANDS, len(starts)), np.uint64)
    edges = np.empty(2 * len(starts), np.int64)
    edges[::2], edges[1::2] = starts, starts + size
    padded = np.append(values, np.uint64(0))
    for band in range(BANDS):
        key = np.full(len(starts), np.uint64(band + 1))
        for k in range(band * ROWS, band * ROWS + ROWS):
            key = key * np.uint64(0x9E3779B97F4A7C15) + np.minimum.reduceat((padded ^ _XOR[k]) * _ODD[k], edges)[::2]
        out[band] = mix64(key)
    return out


def _words(text: bytes) -> np.ndarray:
    data = np.frombuffer(text, np.uint8)
    starts, ends, _ = word_spans(data, np.array([0, len(data)]), WORDS)
    return word_hashes(data, starts, ends, lower=True)


class Templates:
    """Band keys of all template windows, sorted, and the templates' shingles."""

    def __init__(self, templates: dict[str, str]):
        self.names = list(templates)
        self.n_words, self.shingles, parts = [], [], {}
        for t, text in enumerate(templates.values()):
            h = _words(text.encode())
            if len(h) < 5:
                raise ValueError(f"template {self.names[t]!r} has fewer than five words")
            s = shingle_hashes(h)
            self.n_words.append(len(h))
            self.shingles.append(np.unique(s))
            size = window_size(len(h))
            at = np.arange(len(h) - size + 1)
            for band, keys in enumerate(band_keys(s, at, size - 1)):
                parts.setdefault((size, band), []).append((keys, np.full(len(at), t), at))
        self.bands: dict[int, list] = {}
        for (size, _), found in sorted(parts.items()):
            keys, t, at = (np.concatenate(x) for x in zip(*found))
            order = np.argsort(keys, kind="stable")
            self.bands.setdefault(size, []).append((keys[order], t[order], at[order]))


def _candidates(templates: Templates, s: np.ndarray, first: np.ndarray) -> set[tuple[int, int, int]]:
    """(row, template, word where it would start) proposed by the windows."""
    out: set[tuple[int, int, int]] = set()
    for size, bands in templates.bands.items():
        starts, rows = [], []
        for row, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
            if b - a >= size:
                x = np.arange(a, b - size + 1, size // 2)
                starts.append(x)
                rows.append(np.full(len(x), row))
        if not starts:
            continue
        starts, rows = np.concatenate(starts), np.concatenate(rows)
        for (keys, t, at), own in zip(bands, band_keys(s, starts, size - 1)):
            lo = np.searchsorted(keys, own, "left")
            met = np.flatnonzero(keys[np.minimum(lo, len(keys) - 1)] == own)
            for w in met.tolist():
                i = int(lo[w])
                while i < len(keys) and keys[i] == own[w]:
                    out.add((int(rows[w]), int(t[i]), int(starts[w] - at[i])))
                    i += 1
    return out


def _margin(n: int) -> int:
    return max(1, n // 10)


def _apart(found: list[tuple[float, float, int, int]], margin: int) -> list[tuple[float, int, int]]:
    """Of (share, share without margin, start, end) the (share, start, end)
    that do not overlap, best first, then earlier."""
    out: list[tuple[float, int, int]] = []
    taken: list[tuple[int, int]] = []  # by start, disjoint
    rest = [(share, start, end) for share, _, start, end in sorted(found, key=lambda x: (-x[0], -x[1], x[2]))]
    for most in (0, margin):
        left = []
        for share, start, end in rest:
            i = bisect(taken, (start, start))
            a = max(start, taken[i - 1][1]) if i else start
            b = min(end, taken[i][0]) if i < len(taken) else end
            if a < b and a - start <= most and end - b <= most:
                insort(taken, (a, b))
                out.append((share, a, b))
            else:
                left.append((share, start, end))
        rest = left
    return sorted(out, key=lambda x: (-x[0], x[1]))


def scan(df: DataFrame, templates: dict[str, str] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text", contained: float = CONTAINED) -> DataFrame:
    """A row a document: n_words and ``licenses``, a list of (name, start,
    end, containment) with word numbers: by template, its places that do not
    overlap, best first, then earlier."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Templates(templates)
        kind = pa.list_(pa.struct([("name", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("containment", pa.float64())]))
        for b in pieces(batches):
            data, off = raw(b.column("text"))
            starts, ends, first = word_spans(data, off, WORDS)
            s = shingle_hashes(word_hashes(data, starts, ends, lower=True)) if len(starts) > 1 else np.zeros(0, np.uint64)
            places: list[dict[int, list[tuple[float, float, int, int]]]] = [{} for _ in range(b.num_rows)]
            for row, t, at in sorted(_candidates(known, s, first)):
                n = known.n_words[t]
                margin = _margin(n)
                lo, hi = max(at - margin, int(first[row])), min(at + n + margin, int(first[row + 1]))
                share = float(np.isin(known.shingles[t], s[lo : hi - 1]).mean())
                if share >= contained:
                    start, end = max(at, int(first[row])), min(at + n, int(first[row + 1]))
                    own = float(np.isin(known.shingles[t], s[start : end - 1]).mean())
                    places[row].setdefault(t, []).append((share, own, start - int(first[row]), end - int(first[row])))
            found = [[{"name": known.names[t], "start": a, "end": e, "containment": c} for t, f in sorted(x.items()) for c, a, e in _apart(f, _margin(known.n_words[t]))] for x in places]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(np.diff(first), pa.int64()), pa.array(found, kind)], names=["doc_id", "n_words", "licenses"])

    return text_bytes(df, id_col, text_col).mapInArrow(run, "doc_id long, n_words long, licenses array<struct<name:string,start:long,end:long,containment:double>>")
