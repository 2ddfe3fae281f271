"""Substring dedup with a count-min prefilter.

A window is 50 consecutive words of one document (words between white space,
unchanged). A word goes if a window over it has a word sequence that also
starts in a document with a smaller id.

Pass 1 counts, in count-min sketches of a partition each, the *anchors* of
every document: of a window's 26 25-word grams the one with the least hash.
Equal windows have equal anchors, and neighbouring windows mostly share
theirs, so there are about 13 times fewer anchors than windows. The sketch has
about 12 cells an anchor at every size of the corpus, in slices of a fixed
size; more text means more slices. A partition's sketch is sparse: the cells
that its anchors touch, by slice, with the document that asks. The task of a
slice adds up what all partitions counted there and tells the documents whose
anchors it estimates at two or more. Nothing is broadcast or collected. A
sketch never counts too little, so a window whose anchor is estimated at one
document stands in no second one. An anchor that many documents of a
partition's chunk hold is known there to be repeated: two of them count it in
the slice, the others are told without asking.

Pass 2 hashes (128 bits) only windows whose anchor is estimated repeated and
groups them exactly. Before the shuffle, equal windows of a task's chunk are
grouped there: only those of the least document go on, the others are already
known to be repeated. So a passage that stands in a third of all documents
sends one row a chunk. No window is lost; the sketch only saves work.

Edge cases: null and empty texts have no words; documents with fewer than 50
words have no window. Rows that repeat a doc_id are no smaller document for
each other; rows with a null id are left as they are. Extra columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import SPACE_WORDS, mix64, pieces, powers, raw, sha256, text_bytes, word_hashes, word_spans

WINDOW = 50
GRAM = 25
DEPTH = 2
CELLS_AN_ANCHOR = 12
SLICE_BITS = 18  # a slice has 2**18 cells in each of its rows
_CHUNK_WINDOWS = 400_000
_CHUNK_ANCHORS = 500_000
_MULT = np.uint64(0xD1342543DE82EF95)


class Windows:
    """The windows of a batch: where they start, their anchors and hashes."""

    def __init__(self, batch: pa.RecordBatch, window: int, gram: int):
        data, off = raw(batch.column("text"))
        starts, ends, self.first = word_spans(data, off, SPACE_WORDS)
        h = word_hashes(data, starts, ends)
        self.window, n = window, len(h)
        counts = np.diff(self.first)
        many = np.maximum(counts - window + 1, 0)
        many[batch.column("doc_id").is_null().to_numpy(zero_copy_only=False)] = 0
        self.row = np.repeat(np.arange(len(counts)), many)
        #: word index of each window's first word, and its number in the document
        self.pos = np.arange(len(self.row)) - np.repeat(np.cumsum(many) - many, many)
        self.at = self.pos + self.first[self.row]
        self._up, self._down = powers(n + 1)
        self._sums = [self._running(h), self._running(mix64(h ^ _MULT))] if len(self.at) else []
        if len(self.at):
            g = self._hash(0, np.arange(n - gram + 1), gram)
            span, w = 1, window - gram + 1
            low = g
            while span * 2 <= w:
                low = np.minimum(low[: len(low) - span], low[span:])
                span *= 2
            self.anchor = np.minimum(low[self.at], low[self.at + w - span])
        else:
            self.anchor = np.zeros(0, np.uint64)

    def _running(self, h: np.ndarray) -> np.ndarray:
        out = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(h * self._up[: len(h)], out=out[1:])
        return out

    def _hash(self, which: int, at: np.ndarray, n: int) -> np.ndarray:
        s = self._sums[which]
        return mix64((s[at + n] - s[at]) * self._down[at])

    def hashes(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = self.at[which]
        return self._hash(0, at, self.window), self._hash(1, at, self.window)

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """(anchor, row) of all documents, each anchor once a document."""
        if not len(self.at):
            return self.anchor, self.row
        new = np.ones(len(self.at), bool)
        new[1:] = (self.anchor[1:] != self.anchor[:-1]) | (self.row[1:] != self.row[:-1])
        a, r = self.anchor[new], self.row[new]
        order = np.lexsort((a, r))
        a, r = a[order], r[order]
        keep = np.ones(len(a), bool)
        keep[1:] = (a[1:] != a[:-1]) | (r[1:] != r[:-1])
        return a[keep], r[keep]


def codes(anchors: np.ndarray) -> np.ndarray:
    """Where an anchor is counted: 28 bits choose the slice, twice 18 its cells."""
    return mix64(anchors ^ np.uint64(0x632BE59BD9B4E019))


def slice_of(code: np.ndarray, slices: int) -> np.ndarray:
    return ((code >> np.uint64(2 * SLICE_BITS)) * np.uint64(slices) >> np.uint64(64 - 2 * SLICE_BITS)).astype(np.int32)


def estimates(code: np.ndarray) -> np.ndarray:
    """Count-min estimates for the anchors counted in one slice, at least the true counts."""
    mask = np.uint64((1 << SLICE_BITS) - 1)
    least = None
    for d in range(DEPTH):
        cell = (code >> np.uint64(d * SLICE_BITS) & mask).astype(np.int64)
        n = np.bincount(cell, minlength=1 << SLICE_BITS)[cell]
        least = n if least is None else np.minimum(least, n)
    return least


def slices_for(text_bytes_: int, window: int = WINDOW, gram: int = GRAM) -> int:
    """Slices for about ``CELLS_AN_ANCHOR`` cells an anchor, whatever the size."""
    anchors = text_bytes_ / 6.5 * 2 / (window - gram + 2)
    return min(1 << (64 - 2 * SLICE_BITS), max(1, int(np.ceil(CELLS_AN_ANCHOR * anchors / (DEPTH << SLICE_BITS)))))


_ASK = "slice int, code long, doc_id long, key long"


def _asks(held: list[tuple[np.ndarray, ...]], slices: int) -> pa.RecordBatch:
    """A chunk's part of the sketch, by slice. Of the documents that share an
    anchor two ask; the others are known to repeat it (a slice below 0)."""
    code, doc, key = (np.concatenate(x) for x in zip(*held))
    order = np.argsort(code, kind="stable")
    code, doc, key = code[order], doc[order], key[order]
    more = np.zeros(len(code), bool)
    more[2:] = code[2:] == code[:-2]
    to = np.where(more, -1 - (key & 0x3FFFFFFF), slice_of(code, slices)).astype(np.int32)
    return pa.RecordBatch.from_arrays([pa.array(to), pa.array(code.view(np.int64)), pa.array(doc), pa.array(key)], names=["slice", "code", "doc_id", "key"])


def repeated_anchors(rows: DataFrame, window: int = WINDOW, gram: int = GRAM, slices: int | None = None) -> DataFrame:
    """doc_id, key and code of the anchors estimated at two documents or more.
    ``rows``: doc_id, text (binary), key. ``slices``: by the size of the texts."""
    slices = slices or slices_for(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0, window, gram)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        many = 0
        for b in pieces(batches):
            anchor, row = Windows(b, window, gram).anchors()
            if not len(anchor):
                continue
            held.append((codes(anchor), *(b.column(c).fill_null(0).to_numpy(zero_copy_only=False)[row] for c in ("doc_id", "key"))))
            many += len(anchor)
            if many >= _CHUNK_ANCHORS:
                yield _asks(held, slices)
                held, many = [], 0
        if held:
            yield _asks(held, slices)

    def told(code: np.ndarray, doc: np.ndarray, key: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(key), pa.array(code.view(np.int64))], names=["doc_id", "key", "code"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: list[tuple[np.ndarray, ...]] = []  # what came of the open slice

        def answer() -> pa.RecordBatch:
            code, doc, key = (np.concatenate(x) for x in zip(*open_))
            again = estimates(code) > 1
            return told(code[again], doc[again], key[again])

        last = None
        for b in batches:
            s, code, doc, key = (b.column(c).to_numpy(zero_copy_only=False) for c in ("slice", "code", "doc_id", "key"))
            code = code.view(np.uint64)
            at = int(np.searchsorted(s, 0))
            if at:
                yield told(code[:at], doc[:at], key[:at])
            cuts = [at, *(np.flatnonzero(s[at + 1 :] != s[at:-1]) + at + 1).tolist(), len(s)] if at < len(s) else []
            for x, y in zip(cuts, cuts[1:]):
                if s[x] != last and open_:
                    yield answer()
                    open_.clear()
                last = s[x]
                open_.append((code[x:y], doc[x:y], key[x:y]))
        if open_:
            yield answer()

    asked = rows.mapInArrow(count, _ASK).repartition("slice").sortWithinPartitions("slice")
    return asked.mapInArrow(merge, "doc_id long, key long, code long")


def among(code: np.ndarray, row: np.ndarray, told: pa.Array) -> np.ndarray:
    """Which (code, row) stand in the row's list; by 64 bits of hash, so at
    worst a few more."""
    many = told.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    own = np.repeat(np.arange(len(many)), many)
    have = told.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    mixed = lambda c, r: c ^ mix64(r.astype(np.uint64) * _MULT)
    return np.isin(mixed(code, row), mixed(have, own))


_WINDOW_ROW = "h1 long, h2 long, doc_id long, key long, pos int, known binary"


def _window_rows(chunk: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
    """Windows (h1, h2, doc, key, pos) of a chunk: those of the least document
    of each hash, and the positions of the others, by document, as known."""
    h1, h2, doc, key, pos = (np.concatenate(x) for x in zip(*chunk))
    order = np.lexsort((doc, h2, h1))
    h1, h2, doc, key, pos = h1[order], h2[order], doc[order], key[order], pos[order]
    new = np.ones(len(h1), bool)
    new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
    least = doc[np.maximum.accumulate(np.where(new, np.arange(len(h1)), 0))]
    go = doc == least
    yield pa.RecordBatch.from_arrays(
        [pa.array(h1[go]), pa.array(h2[go]), pa.array(doc[go]), pa.array(key[go]), pa.array(pos[go], pa.int32()), pa.nulls(int(go.sum()), pa.binary())],
        names=["h1", "h2", "doc_id", "key", "pos", "known"],
    )
    if not go.all():
        d, k, packed = _packed(doc[~go], key[~go], pos[~go])
        yield pa.RecordBatch.from_arrays(
            [pa.array(k ^ np.arange(len(k))), pa.array(k), pa.array(d), pa.array(k), pa.array(np.zeros(len(k)), pa.int32()), pa.array(packed, pa.binary())],
            names=["h1", "h2", "doc_id", "key", "pos", "known"],
        )


def _packed(doc: np.ndarray, key: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Positions by document, as int32 bytes."""
    order = np.lexsort((pos, key, doc))
    doc, key, pos = doc[order], key[order], pos[order].astype(np.int32)
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])
    at = np.flatnonzero(new)
    return doc[at], key[at], [x.tobytes() for x in np.split(pos, at[1:])]


def _rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text, key (a hash of the text) and ``at``, the id or 0: joins on
    columns without nulls filter nothing, so two joins share one exchange."""
    return text_bytes(df, id_col, text_col).withColumns({"at": F.coalesce("doc_id", F.lit(0)), "key": F.xxhash64("text")})


def repeated_starts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc_id, key (a hash of the text) and ``starts``, the word numbers at which
    windows start that also start in a document with a smaller id."""
    if not 0 < gram <= window:
        raise ValueError("a gram is a part of a window")
    rows = _rows(df, id_col, text_col)
    told = repeated_anchors(rows, window, gram).groupBy("doc_id", "key").agg(F.collect_list("code").alias("codes"))
    # the same exchange of the documents serves here and in ``removed``
    open_ = rows.join(told.withColumnRenamed("doc_id", "at"), ["at", "key"]).select("doc_id", "key", "text", "codes")

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        many = 0
        for b in pieces(batches):
            w = Windows(b, window, gram)
            which = np.flatnonzero(among(codes(w.anchor), w.row, b.column("codes")))
            if not len(which):
                continue
            h1, h2 = (x.view(np.int64) for x in w.hashes(which))
            row = w.row[which]
            doc, key = (b.column(c).fill_null(0).to_numpy(zero_copy_only=False)[row] for c in ("doc_id", "key"))
            held.append((h1, h2, doc, key, w.pos[which]))
            many += len(which)
            if many >= _CHUNK_WINDOWS:
                yield from _window_rows(held)
                held, many = [], 0
        if held:
            yield from _window_rows(held)

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # (h1, h2, least document) of the open group
        held: list[tuple[np.ndarray, ...]] = []
        many = 0
        for b in batches:
            if not b.num_rows:
                continue
            known = b.column("known").is_valid().to_numpy(zero_copy_only=False)
            if known.any():
                k = b.filter(pa.array(known))
                many_ = [len(x) // 4 for x in k.column("known").to_pylist()]
                pos = np.frombuffer(b"".join(k.column("known").to_pylist()), np.int32)
                yield _starts([(*(np.repeat(k.column(c).to_numpy(zero_copy_only=False), many_) for c in ("doc_id", "key")), pos)])
                b = b.filter(pa.array(~known))
                if not b.num_rows:
                    continue
            h1, h2, doc, key, pos = (b.column(c).to_numpy(zero_copy_only=False) for c in ("h1", "h2", "doc_id", "key", "pos"))
            new = np.ones(len(h1), bool)
            new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
            least = doc[np.maximum.accumulate(np.where(new, np.arange(len(h1)), 0))]
            if last and last[:2] == (h1[0], h2[0]):
                to = int(np.flatnonzero(new)[1]) if new.sum() > 1 else len(h1)
                least[:to] = last[2]
            last = (h1[-1], h2[-1], least[-1])
            gone = doc > least
            if gone.any():
                held.append((doc[gone], key[gone], pos[gone]))
                many += int(gone.sum())
            if many >= 4 * _CHUNK_WINDOWS:
                yield _starts(held)
                held, many = [], 0
        if held:
            yield _starts(held)

    found = open_.mapInArrow(candidates, _WINDOW_ROW).repartition("h1").sortWithinPartitions("h1", "h2", "doc_id")
    # a row a window; the grouping combines those of a document before its shuffle
    return found.mapInArrow(group, "doc_id long, key long, pos int").groupBy("doc_id", "key").agg(F.collect_list("pos").alias("starts"))


def _starts(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    """Positions in order of their document, so that equal keys are neighbours."""
    doc, key, pos = (np.concatenate(x) for x in zip(*held))
    order = np.lexsort((key, doc))
    return pa.RecordBatch.from_arrays([pa.array(doc[order]), pa.array(key[order]), pa.array(pos[order], pa.int32())], names=["doc_id", "key", "pos"])


def removed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM, keep_text: bool = False) -> DataFrame:
    """One row a document: doc_id, n_words, n_removed, kept_sha256 (of the
    kept words joined by one space) and, if asked for, ``kept_text``."""
    starts = repeated_starts(df, id_col, text_col, window, gram).withColumnRenamed("doc_id", "at")
    joined = _rows(df, id_col, text_col).join(starts, ["at", "key"], "left")
    joined = joined.select("doc_id", "text", F.when(F.col("doc_id").isNotNull(), F.col("starts")).alias("starts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            n, gone, kept = [], [], []
            for text, starts in zip(b.column("text").to_pylist(), b.column("starts").to_pylist()):
                words = (text or b"").split()  # the ASCII white space of bytes
                n.append(len(words))
                if starts:
                    cover = np.zeros(len(words) + 1, np.int64)
                    at = np.unique(np.array(starts, np.int64))
                    cover[at] += 1
                    np.subtract.at(cover, at + window, 1)
                    stay = np.cumsum(cover[:-1]) == 0
                    words = [w for w, k in zip(words, stay.tolist()) if k]
                gone.append(n[-1] - len(words))
                kept.append(b" ".join(words))
            out = [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array([sha256(k) for k in kept], pa.string())]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            if keep_text:
                out.append(pa.array([k.decode("utf-8", "replace") for k in kept], pa.string()))
                names.append("kept_text")
            yield pa.RecordBatch.from_arrays(out, names=names)

    return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", kept_text string" if keep_text else ""))
