"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

A pattern is ten consecutive words of a benchmark item (a shorter item is one
pattern of its own length). For patterns of ``m`` words a table over hashed
blocks of two words says how far a window may move without passing over an
occurrence; where it says 0, the bucket of the block (the patterns that end
in it) is compared word by word with the text. Patterns of different lengths
are searched apart, so a short item does not shorten the moves of the others.

At most ``block_bytes`` of benchmark text are broadcast at a time, as the
words and the places where patterns begin; a larger benchmark is searched in
several such blocks, one after the other, and every block sees every document.
A worker process builds the tables once, as flat arrays: about 10 bytes for
each byte of benchmark text, 24 while they are built.

Edge cases: null and empty texts have no words; an item without words has no
pattern; several rows with one item id are one item; a null item id is
written as the empty string. Repeated documents give repeated results; extra
columns are not read. With no benchmark rows nothing is hit.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import byte_class, mix64, pieces, raw, text_bytes, word_hashes, word_spans

#: Words: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z.
WORDS = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
WINDOW = 10
BLOCK_BYTES = 16 << 20
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


class Patterns(NamedTuple):
    """Words of benchmark items, joined by a space, and the patterns in them."""

    text: bytes
    starts: np.ndarray  # of the words in the text
    ends: np.ndarray
    first: np.ndarray  # word with which each pattern begins
    length: np.ndarray  # words of each pattern
    row: np.ndarray  # item of each pattern
    ids: list[str]  # items by row


def patterns(items: list[tuple[str, bytes]], window: int = WINDOW) -> Patterns:
    """All windows of ``window`` words, a shorter item as one pattern."""
    off = np.zeros(len(items) + 1, np.int64)
    off[1:] = np.cumsum([len(t) for _, t in items])
    low = b"".join(t for _, t in items).translate(_LOWER)
    starts, ends, at = word_spans(np.frombuffer(low, np.uint8), off, WORDS)
    text = b" ".join([low[a:b] for a, b in zip(starts.tolist(), ends.tolist())])
    size = ends - starts
    to = np.cumsum(size + 1) - 1
    n = np.diff(at)
    length = np.minimum(n, window)
    count = np.where(n > 0, n - length + 1, 0)
    row = np.repeat(np.arange(len(items)), count)
    first = at[:-1][row] + np.arange(len(row)) - (np.cumsum(count) - count)[row]
    small = lambda x: x.astype(np.int32)
    return Patterns(text, small(to - size), small(to), small(first), small(length[row]), small(row), [i for i, _ in items])


class Searcher:
    """Shift table and suffix buckets for patterns of ``m`` words. A bucket is
    a run of equal keys in a sorted array; equal patterns are one entry."""

    def __init__(self, m: int, found: Patterns, h: np.ndarray):
        self.m, self.block, self.found = m, min(2, m), found
        which = found.length == m
        first, row = found.first[which], found.row[which]
        whole = np.zeros(len(first), np.uint64)
        for j in range(m):
            whole = blocks(whole, h[first + j])
        key = self._block(h, first + m - 1)
        order = np.lexsort((row, whole, key))
        first, row, whole, key = first[order], row[order], whole[order], key[order]
        new = np.ones(len(first), bool)
        new[1:] = (key[1:] != key[:-1]) | (whole[1:] != whole[:-1])
        for i in np.flatnonzero(~new).tolist():
            new[i] = self._text(first[i]) != self._text(first[i - 1])
        entry = np.flatnonzero(new)
        self.first, self.key, self.row, self.at = first[entry], key[entry], row, np.append(entry, len(row))
        self.bits = np.uint64(64 - max(16, min(24, int(len(entry) * m * 8).bit_length())))
        self.table = np.full(1 << (64 - int(self.bits)), min(m - self.block + 1, 255), np.uint8)
        for j in range(self.block - 1, m):
            np.minimum.at(self.table, (self._block(h, self.first + j) >> self.bits).astype(np.int64), np.uint8(min(m - 1 - j, 255)))

    def _block(self, h: np.ndarray, at: np.ndarray) -> np.ndarray:
        return blocks(h[at - 1] if self.block == 2 else None, h[at])

    def _text(self, first: int) -> bytes:
        return self.found.text[self.found.starts[first] : self.found.ends[first + self.m - 1]]

    def items(self, entry: int) -> list[str]:
        """The items that have a pattern."""
        return [self.found.ids[r] for r in self.row[self.at[entry] : self.at[entry + 1]].tolist()]

    def search(self, h: np.ndarray, first: np.ndarray, word) -> Iterator[tuple[int, int, int]]:
        """(row, word index of the end, pattern) of each occurrence; ``word(i)``
        gives the text of word i."""
        if len(h) < self.m:
            return
        key = np.zeros(len(h), np.uint64)
        if self.block == 2:
            key[1:] = blocks(h[:-1], h[1:])
        else:
            key = blocks(None, h)
        shifts = self.table[(key >> self.bits).astype(np.int64)]
        still = np.flatnonzero(shifts == 0)
        low, high = (np.searchsorted(self.key, key[still], side) for side in ("left", "right"))
        some = low < high
        shifts[still[~some]] = 1  # no bucket has this block
        bucket = dict(zip(still[some].tolist(), zip(low[some].tolist(), high[some].tolist())))
        shift, m = shifts.tobytes(), self.m
        for row, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
            i = a + m - 1
            while i < b:
                s = shift[i]
                if s:
                    i += s
                    continue
                text = b" ".join([word(j) for j in range(i - m + 1, i + 1)])
                for p in range(*bucket[i]):
                    if text == self._text(self.first[p]):
                        yield row, i, p
                i += 1


def blocks(a: np.ndarray | None, b: np.ndarray) -> np.ndarray:
    return mix64(b if a is None else a * np.uint64(0xD1342543DE82EF95) + b)


def searchers(found: Patterns) -> list[Searcher]:
    data = np.frombuffer(found.text, np.uint8)
    h = word_hashes(data, found.starts.astype(np.int64), found.ends.astype(np.int64))
    return [Searcher(m, found, h) for m in np.unique(found.length).tolist()]


_built: dict = {}


def _searchers(found) -> list[Searcher]:
    """The tables of a broadcast; a worker process keeps those it used last."""
    if _built.get("found") is not found:
        _built.clear()
        _built.update(searchers=searchers(found.value), found=found)
    return _built["searchers"]


def _blocks_of(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple[str, bytes]]]:
    items = benchmark.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    size = items.agg(F.sum(F.octet_length("text") + F.octet_length("item")).alias("n")).first()["n"] or 0
    n = max(1, -(-int(size) * 2 // block_bytes))
    for k in range(n):
        part = items if n == 1 else items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k)
        yield [(r["item"], bytes(r["text"])) for r in part.distinct().collect()]


def occurrences(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES, item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, n_words, ``hits`` (numbers of the words inside an occurrence,
    as int32 bytes) and ``items`` (ids of the items that occur)."""
    spark = docs.sparkSession
    df = text_bytes(docs, id_col, text_col).withColumns({"n_words": F.lit(0).cast("long"), "hits": F.lit(b""), "items": F.array().cast("array<string>")})
    for items in _blocks_of(benchmark, item_col, item_text, block_bytes):
        found = spark.sparkContext.broadcast(patterns(items, window))
        df = df.mapInArrow(_scan(found), "doc_id long, text binary, n_words long, hits binary, items array<string>")
    return df.drop("text")


def _scan(found):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = _searchers(found)
        for b in pieces(batches):
            data, off = raw(b.column("text"))
            starts, ends, first = word_spans(data, off, WORDS)
            h = word_hashes(data, starts, ends, lower=True)
            hit = np.zeros(len(h), bool)
            old_hits, items = b.column("hits").to_pylist(), [set(x or ()) for x in b.column("items").to_pylist()]
            for row, x in enumerate(old_hits):
                if x:
                    hit[first[row] + np.frombuffer(x, np.int32)] = True

            def word(i: int) -> bytes:
                return data[starts[i] : ends[i]].tobytes().translate(_LOWER)

            for s in search:
                for row, i, p in s.search(h, first, word):
                    hit[i - s.m + 1 : i + 1] = True
                    items[row].update(s.items(p))
            hits = [np.flatnonzero(hit[x:y]).astype(np.int32).tobytes() for x, y in zip(first[:-1], first[1:])]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("text"), pa.array(np.diff(first), pa.int64()), pa.array(hits, pa.binary()), pa.array([sorted(x) for x in items], pa.list_(pa.string()))],
                names=["doc_id", "text", "n_words", "hits", "items"],
            )

    return run


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES, item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` (all columns) that hold no occurrence."""
    for items in _blocks_of(benchmark, item_col, item_text, block_bytes):
        found = docs.sparkSession.sparkContext.broadcast(patterns(items, window))

        def run(batches: Iterator[pa.RecordBatch], found=found) -> Iterator[pa.RecordBatch]:
            search = _searchers(found)
            for b in pieces(batches, text_col):
                keep = np.ones(b.num_rows, bool)
                for row, _, _ in _found(b.column(text_col), search):
                    keep[row] = False
                yield b.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def _found(col: pa.Array, search: list[Searcher]) -> Iterator[tuple[int, int, int]]:
    data, off = raw(col)
    starts, ends, first = word_spans(data, off, WORDS)
    h = word_hashes(data, starts, ends, lower=True)
    for s in search:
        yield from s.search(h, first, lambda i: data[starts[i] : ends[i]].tobytes().translate(_LOWER))


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per document: its words, those inside an occurrence, its items."""
    return occurrences(docs, benchmark, **options).select(
        "doc_id",
        "n_words",
        (F.octet_length("hits") / 4).cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.octet_length("hits") > 0).alias("contaminated"),
    )
