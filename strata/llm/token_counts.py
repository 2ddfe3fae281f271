"""Token counts of sections by offset-mapped attribution.

Each document is encoded once, as a whole, by a byte-level BPE. Such a coding
loses nothing, so the running sum of the tokens' byte lengths is the exact
span of every token. Sections are spans of the text too; the interval join of
the two sorted lists gives the tokens of each section, and a token over a
boundary is allocated by a stated rule:

* ``start``: to the section that holds its first byte;
* ``most``: to the section that holds most of its bytes, the earlier on ties;
* ``share``: to each section by its share of the token's bytes.

The sections of a document are its paragraphs: a section is a run of lines
with the line ends behind it (so sections cover the text), and a new one
begins after each blank line or where the kind of line changes: ``heading``
(``#``), ``list``, ``table`` (with ``|``) or ``prose``.

Edge cases: null and empty texts have no section and no row; blank lines
before the first text belong to the first section; repeated documents give
repeated rows; extra columns are not read.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from strata.llm.common import pieces, text_bytes, texts

#: Split pattern of the vocabulary (a fixed value that belongs to its file).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_CODINGS: dict[str, tuple[tiktoken.Encoding, np.ndarray]] = {}


def coding(path: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The coding of a rank file and the byte length of each token, one a worker."""
    if path not in _CODINGS:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        size = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            size[i] = len(token)
        _CODINGS[path] = tiktoken.Encoding("byte-bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), size
    return _CODINGS[path]


#: What the pattern takes for white space (fixed values: Unicode White_Space).
_LONG_BLANK = re.compile("[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]{4096,}")


def encode(bpe: tiktoken.Encoding, text: str) -> list[int]:
    """The ids of a text. The splitter can't take very long runs of white
    space, so these are cut off first, by the pattern's own rule: a run is a
    piece of its own, without its last character if more text follows."""
    ids, at = [], 0
    for m in _LONG_BLANK.finditer(text):
        end = m.end() if m.end() == len(text) else m.end() - 1
        ids += bpe.encode_ordinary(text[at : m.start()])
        ids += bpe._encode_single_piece(text[m.start() : end])
        at = end
    return ids + bpe.encode_ordinary(text[at:])


def _kind(line: str) -> str:
    s = line.lstrip()
    if s.startswith("#"):
        return "heading"
    if s.startswith(("- ", "* ", "+ ")) or s[:1].isdigit() and s.lstrip("0123456789")[:2] in (". ", ") "):
        return "list"
    return "table" if "|" in s else "prose"


def sections(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points; they cover the text."""
    out: list[list] = []
    at, fresh = 0, True
    for line in text.split("\n"):
        end = min(at + len(line) + 1, len(text))
        if end == at:
            break
        if line.strip():
            kind = _kind(line)
            if not out or out[-1][0] is not None and (fresh or out[-1][0] != kind):
                out.append([kind, at, end])
            out[-1][0], out[-1][2], fresh = kind, end, False
        else:
            if not out:
                out.append([None, at, end])
            out[-1][2], fresh = end, out[-1][0] is not None
        at = end
    return [(k or "prose", a, b) for k, a, b in out]


def attribute(ends: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens by section under the rules start, most and share. ``ends``: byte
    ends of the tokens; ``bounds``: byte bounds of the sections (one more)."""
    n = len(bounds) - 1
    starts = np.concatenate([[0], ends[:-1]])
    a = np.searchsorted(bounds, starts, "right") - 1  # section of the first byte
    b = np.searchsorted(bounds, ends, "left") - 1  # section of the last byte
    by_start = np.bincount(a, minlength=n)
    by_most, by_share = np.bincount(a[a == b], minlength=n), np.bincount(a[a == b], minlength=n).astype(np.float64)
    for i in np.flatnonzero(a != b):  # at most one a boundary
        cuts = np.clip(bounds[a[i] : b[i] + 2], starts[i], ends[i])
        part = np.diff(cuts)
        by_most[a[i] + int(part.argmax())] += 1
        by_share[a[i] : b[i] + 1] += part / (ends[i] - starts[i])
    return by_start, by_most, by_share


def section_counts(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row a section: its span in code points and its tokens by each rule."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, size = coding(path)
        for b in pieces(batches):
            rows: list[tuple] = []
            for doc, text in zip(b.column("doc_id").to_pylist(), texts(b.column("text"))):
                found = sections(text)
                if not found:
                    continue
                ends = np.cumsum(size[np.array(encode(bpe, text), np.int64)])
                cuts = [0, *(e for _, _, e in found)]
                if len(text) == ends[-1]:
                    bounds = np.array(cuts)
                else:  # code points that are not one byte
                    first = (np.frombuffer(text.encode("utf-8"), np.uint8) & 0xC0) != 0x80
                    bounds = np.append(np.flatnonzero(first), len(first))[cuts]
                for i, ((kind, s, e), x, y, z) in enumerate(zip(found, *attribute(ends, bounds))):
                    rows.append((doc, i, kind, s, e, int(x), int(y), float(z)))
            if rows:
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["doc_id", "section", "kind", "start", "end", "n_tokens", "n_tokens_most", "n_tokens_share"])

    return text_bytes(df, id_col, text_col).mapInArrow(run, "doc_id long, section long, kind string, start long, end long, n_tokens long, n_tokens_most long, n_tokens_share double")
