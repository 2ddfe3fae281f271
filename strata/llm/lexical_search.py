"""Ranked lexical search: the best documents for each item, by dual-tree search.

1. One pass over the texts turns each document into its length and the counts
   of the items' terms (a term is known by 64 bits of hash and its length); the
   collection's figures come from that table.
2. A task builds a hierarchy over each batch of its documents: they are sorted
   by their heaviest term, leaves hold ``LEAF`` of them, an inner node ``FAN``
   nodes, and each node has, by term, the largest contribution of its
   documents. The items have such a hierarchy over their weights. The product of
   an item node's and a document node's maxima bounds all scores between
   them; a pair whose bound is below the weakest kth score of the node's items
   goes as a whole, nothing else does. Leaf pairs are scored exactly.
3. A first round scores for each item only the leaf with the best bound in
   each batch; the kth best of these over all tasks is where the second, full
   round starts pruning.

Scores are whole numbers: products and sums of float64 are exact below 2**53,
which ``EXACT_TERMS`` terms can't reach; blocks with more use int64.

Broadcast are the items' terms and weights, at most ``ITEM_BYTES`` of item
text at a time: a larger benchmark is searched in several passes. Inside a
task items go by blocks of at most 256 items or 8,192 terms (or one item).

Edge cases: a null text has no terms and never counts; an item without terms, or
whose terms no document has, gets no row; rows that repeat an item_id are one
item with the terms of all; rows that repeat a doc_id are documents of their
own; a null doc_id comes last among equal scores; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import byte_class, pieces, prepare, raw, rows_of, text_bytes, word_hashes, word_spans, written

#: [^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+: delimiters are ASCII, so bytes serve as well as code points.
WORDS = ~byte_class((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
K = 10
LEAF, FAN = 32, 8
ITEM_BYTES = 16 << 20
EXACT_TERMS = 200_000
_BATCH_DOCS, _BATCH_COUNTS, _CELLS = 8192, 1 << 21, 1 << 21
_BLOCK_ITEMS, _BLOCK_TERMS = 256, 8192
_LAST = np.iinfo(np.int64).max


def terms(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and lengths of all terms and, by row, the index of its first."""
    starts, ends, first = word_spans(data, off, WORDS)
    return word_hashes(data, starts, ends, lower=True), ends - starts, first


class Vocabulary:
    """The items' terms, sorted by hash, and each item's term numbers."""

    def __init__(self, items: dict[str | None, bytes]):
        self.names = list(items)
        data = b"\x00".join(items.values())
        off = np.cumsum([0, *(len(t) + 1 for t in items.values())])
        off[-1] -= 1 if items else 0
        h, size, first = terms(np.frombuffer(data, np.uint8), off)
        self.hashes, at, number = np.unique(h, return_index=True, return_inverse=True)
        self.sizes = size[at]
        self.items = [np.unique(number[a:b]) for a, b in zip(first[:-1], first[1:])]

    def counts(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """By row the number of terms and the end of its counts; term numbers and counts."""
        h, size, first = terms(data, off)
        n = len(first) - 1
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1) if len(self.hashes) else np.zeros(len(h), int)
        known = (self.hashes[at] == h) & (self.sizes[at] == size) if len(self.hashes) else np.zeros(len(h), bool)
        pair, tf = np.unique(rows_of(first)[known] * len(self.hashes) + at[known], return_counts=True)
        rows = pair // max(1, len(self.hashes))
        return np.diff(first), np.searchsorted(rows, np.arange(n + 1)), pair % max(1, len(self.hashes)), tf


def _vectors(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            n, off, term, tf = vocabulary.value.counts(*raw(b.column("text")))
            off = pa.array(off, pa.int32())
            lists = [pa.ListArray.from_arrays(off, pa.array(x, pa.int32())) for x in (term, tf)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), *lists], names=["doc_id", "n", "term", "tf"])

    return run


def _figures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents that hold each term; at -1 documents with a term, at -2 all terms."""
    for b in batches:
        df, n = np.bincount(_flat(b.column("term"))[0], minlength=1), b.column("n").to_numpy()
        has = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array([-1, -2, *has], pa.int64()), pa.array([int((n > 0).sum()), int(n.sum()), *df[has]], pa.int64())], names=["term", "x"])


def _flat(col: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    off = col.offsets.to_numpy()
    return col.values.to_numpy()[off[0] : off[-1]], off - off[0]


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _levels(leaves: np.ndarray) -> list[np.ndarray]:
    """Coordinate maxima from the leaves up to one node."""
    out = [leaves]
    while len(out[-1]) > 1:
        out.append(np.maximum.reduceat(out[-1], np.arange(0, len(out[-1]), FAN), axis=0))
    return out


def _children(nodes: np.ndarray, n: int) -> np.ndarray:
    out = (nodes[:, None] * FAN + np.arange(FAN)).ravel()
    return out[out < n]


class Block:
    """The hierarchy over some items: ``up[0]`` has a row of weights an item."""

    def __init__(self, numbers: list[int], items: list[np.ndarray], weights: np.ndarray):
        self.numbers = np.array(numbers)
        self.terms = np.unique(np.concatenate([items[i] for i in numbers]))
        self.kind = np.float64 if len(self.terms) <= EXACT_TERMS else np.int64
        w = np.zeros((len(numbers), len(self.terms)), self.kind)
        for row, i in enumerate(numbers):
            at = np.searchsorted(self.terms, items[i])
            w[row, at] = weights[items[i]]
        self.up = _levels(w)

    @staticmethod
    def all(items: list[np.ndarray], weights: np.ndarray) -> list[Block]:
        """Items with the same heaviest term are neighbours."""
        order = sorted((i for i, t in enumerate(items) if len(t)), key=lambda i: (int(items[i][np.argmax(weights[items[i]])]), i))
        out, now, size = [], [], 0
        for i in order:
            if now and (len(now) == _BLOCK_ITEMS or size + len(items[i]) > _BLOCK_TERMS):
                out.append(Block(now, items, weights))
                now, size = [], 0
            now.append(i)
            size += len(items[i])
        return out + ([Block(now, items, weights)] if now else [])


class Best:
    """The k best (score, document) of each item of a block so far; ``score``
    and ``doc`` are the weakest of them, or a bound known from elsewhere."""

    def __init__(self, block: Block, k: int, seeds: dict[int, tuple[int, int]]):
        self.k, self.rows = k, [[] for _ in block.numbers]
        known = [seeds.get(int(i), (1, _LAST)) for i in block.numbers]
        self.score, self.doc = np.array([s for s, _ in known], block.kind), np.array([d for _, d in known], np.int64)
        self.sizes = [len(x) for x in block.up]
        self._weakest()

    def _weakest(self) -> None:
        self.least = [self.score]
        for _ in self.sizes[1:]:
            self.least.append(np.minimum.reduceat(self.least[-1], np.arange(0, len(self.least[-1]), FAN)))

    def may(self, level: int, nodes: np.ndarray, bound: np.ndarray, first_doc: int) -> np.ndarray:
        """Whether documents from ``first_doc`` on with scores up to ``bound`` can still count."""
        least = self.least[level][nodes]
        if level:
            return bound >= least
        return (bound > least) | ((bound == least) & (first_doc <= self.doc[nodes]))

    def add(self, items: np.ndarray, scores: np.ndarray, docs: np.ndarray) -> None:
        hit = (scores >= self.score[items][:, None]) & (scores > 0)
        some = np.flatnonzero(hit.any(axis=1))
        for i in some:
            item, at = items[i], np.flatnonzero(hit[i])
            rows = sorted(self.rows[item] + [(-int(s), int(d)) for s, d in zip(scores[i, at], docs[at])])[: self.k]
            self.rows[item] = rows
            if len(rows) == self.k and (rows[-1][0], rows[-1][1]) < (-int(self.score[item]), int(self.doc[item])):
                self.score[item], self.doc[item] = -rows[-1][0], rows[-1][1]
        if len(some):
            self._weakest()


class Documents:
    """The hierarchy over a batch of documents, for one block of items.
    ``pos``, ``col``, ``c``: place of the document in the batch's order, column
    of the term in the block, contribution; sorted by ``pos``."""

    def __init__(self, block: Block, pos: np.ndarray, col: np.ndarray, c: np.ndarray, docs: np.ndarray):
        self.block, self.pos, self.col, self.c, self.docs = block, pos, col, c.astype(block.kind), docs
        n, width = -(-len(docs) // LEAF), len(block.terms)
        leaves = np.zeros(n * width, block.kind)
        np.maximum.at(leaves, pos // LEAF * width + col, self.c)
        self.up = _levels(leaves.reshape(n, width))
        self.first = [np.minimum.reduceat(docs, np.arange(0, len(docs), LEAF))]
        for _ in self.up[1:]:
            self.first.append(np.minimum.reduceat(self.first[-1], np.arange(0, len(self.first[-1]), FAN)))

    def score(self, leaf: int, items: np.ndarray, best: Best) -> None:
        a, b = np.searchsorted(self.pos, (leaf * LEAF, leaf * LEAF + LEAF))
        docs = self.docs[leaf * LEAF : leaf * LEAF + LEAF]
        cols, at = np.unique(self.col[a:b], return_inverse=True)
        dense = np.zeros((len(cols), len(docs)), self.c.dtype)
        dense[at, self.pos[a:b] - leaf * LEAF] = self.c[a:b]
        best.add(items, self.block.up[0][np.ix_(items, cols)] @ dense, docs)

    def seed(self, best: Best) -> None:
        """Each item against the leaf with the best bound."""
        at = (self.block.up[0] @ self.up[0].T).argmax(axis=1)
        for leaf in np.unique(at):
            self.score(int(leaf), np.flatnonzero(at == leaf), best)

    def search(self, best: Best) -> None:
        top = len(self.block.up) - 1
        self._visit(len(self.up) - 1, np.zeros(1, int), top, np.zeros(1, int), best)

    def _visit(self, level: int, nodes: np.ndarray, item_level: int, items: np.ndarray, best: Best) -> None:
        bounds = self.block.up[item_level][items] @ self.up[level][nodes].T
        for k in np.argsort(-bounds.max(axis=0), kind="stable"):
            node = nodes[k]
            keep = items[best.may(item_level, items, bounds[:, k], self.first[level][node])]
            if not len(keep):
                continue
            if not level and not item_level:
                self.score(int(node), keep, best)
                continue
            below = _children(nodes[k : k + 1], len(self.up[level - 1])) if level else nodes[k : k + 1]
            self._visit(max(level - 1, 0), below, max(item_level - 1, 0), _children(keep, best.sizes[item_level - 1]) if item_level else keep, best)


def _searched(found, k: int, whole: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights, n_docs, n_terms, seeds = found.value
        blocks = Block.all(items, weights)
        bests = [Best(x, k, seeds) for x in blocks]
        widest = max((len(x.terms) for x in blocks), default=1)
        for docs, lengths, row, term, tf in _cut(batches, max(LEAF, min(_BATCH_DOCS, _CELLS // widest * LEAF))):
            m = np.array([10 + 90 * int(n) * n_docs // n_terms for n in lengths], np.int64)
            c = 1_000_000_000 * tf // (1000 * tf + 8 * m[row])
            # documents with the same heaviest term are neighbours
            heavy = np.full(len(docs), -1, np.int64)
            by = np.lexsort((weights[term] * c, row))
            heavy[row[by]] = term[by]
            order = np.lexsort((docs, m, heavy))
            place = np.empty(len(docs), np.int64)
            place[order] = np.arange(len(docs))
            pos = place[row]
            by = np.argsort(pos, kind="stable")
            pos, term, c, docs = pos[by], term[by], c[by], docs[order]
            for block, best in zip(blocks, bests):
                col = np.minimum(np.searchsorted(block.terms, term), len(block.terms) - 1)
                own = block.terms[col] == term
                if own.any():
                    tree = Documents(block, pos[own], col[own], c[own], docs)
                    tree.search(best) if whole else tree.seed(best)
        out = [(int(i), -s, None if d == _LAST else d) for block, best in zip(blocks, bests) for i, rows in zip(block.numbers, best.rows) for s, d in rows]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], names=["item", "score", "doc_id"])

    return run


def _cut(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple]:
    """Documents by ``most`` and a bounded number of counts (or one): ids (null: the
    largest number), lengths, and (row, term, count)."""
    for b in batches:
        docs = b.column("doc_id").fill_null(_LAST).to_numpy(zero_copy_only=False)
        lengths, (term, off), (tf, _) = b.column("n").to_numpy(), _flat(b.column("term")), _flat(b.column("tf"))
        a = 0
        while a < len(docs):
            z = min(a + most, max(a + 1, int(np.searchsorted(off, off[a] + _BATCH_COUNTS, "right")) - 1))
            row = np.repeat(np.arange(min(z, len(docs)) - a), np.diff(off[a : z + 1]))
            yield docs[a:z], lengths[a:z], row, term[off[a] : off[min(z, len(docs))]].astype(np.int64), tf[off[a] : off[min(z, len(docs))]].astype(np.int64)
            a = z


def _groups(items: DataFrame, id_col: str, text_col: str, item_bytes: int) -> Iterator[dict[str | None, bytes]]:
    """The items' texts by id, some MB at a time."""
    t = items.select(F.col(id_col).cast("string").alias("item"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))
    size = t.agg(F.sum(F.octet_length("text") + 16).alias("n")).first()["n"] or 0
    n = max(1, -(-int(size) * 2 // item_bytes))
    for k in range(n):
        out: dict[str | None, bytes] = {}
        for r in t.filter(F.pmod(F.xxhash64("item"), F.lit(n)) == k).collect():
            out[r["item"]] = out.get(r["item"], b"") + b"\x00" + bytes(r["text"])
        if out:
            yield out


def _best(df: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", item_bytes: int = ITEM_BYTES) -> DataFrame:
    """item_id, rank, doc_id and score of each item's ``k`` best documents."""
    spark = prepare(docs.sparkSession)
    sc, kind = spark.sparkContext, items.schema[item_col].dataType
    out = None
    for group in _groups(items, item_col, item_text, item_bytes):
        vocabulary = Vocabulary(group)
        texts = text_bytes(docs, id_col, text_col).mapInArrow(_vectors(sc.broadcast(vocabulary)), "doc_id long, n long, term array<int>, tf array<int>")
        vectors = written(texts, "search-vectors")
        # a row a term of the items
        figures = {r["term"]: r["x"] for r in vectors.select("n", "term").mapInArrow(_figures, "term long, x long").groupBy("term").agg(F.sum("x").alias("x")).collect()}
        n_docs, n_terms = figures.get(-1, 0), figures.get(-2, 0)
        weights = np.array([weight(n_docs, figures.get(t, 0)) if t in figures else 0 for t in range(len(vocabulary.hashes))], np.int64)

        def found(seeds: dict, whole: bool, vectors=vectors, fixed=(vocabulary.items, weights, n_docs, max(1, n_terms))) -> DataFrame:
            return vectors.mapInArrow(_searched(sc.broadcast((*fixed, seeds)), k, whole), "item long, score long, doc_id long")

        # the weakest of k known scores: a row an item
        weakest = _best(found({}, False), k).filter(F.col("rank") == k).collect()
        seeds = {r["item"]: (r["score"], _LAST if r["doc_id"] is None else r["doc_id"]) for r in weakest}
        names = spark.createDataFrame([(i, x) for i, x in enumerate(vocabulary.names)], "item long, name string")
        part = _best(found(seeds, True), k).join(names, "item").select(F.col("name").cast(kind).alias("item_id"), F.col("rank").cast("int").alias("rank"), "doc_id", "score")
        out = part if out is None else out.unionByName(part)
    if out is None:
        return items.select(F.col(item_col).alias("item_id"), F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).limit(0)
    return out
