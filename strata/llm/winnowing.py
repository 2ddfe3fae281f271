"""Document fingerprints by winnowing.

Every k-gram of code points gets a rolling hash; of each ``w`` consecutive
hashes the smallest is chosen, on ties the rightmost; a fingerprint is the
list of chosen (position, hash). Two texts that share ``k + w - 1``
consecutive code points share a fingerprint hash, and matches shorter than
``k`` are never reported.

Edge cases: a null text counts as empty; an empty text has no fingerprint;
a text shorter than ``k`` has one, of the whole text, at position 0; a text
with fewer than ``w`` hashes has the smallest of them. Repeated rows give
repeated results. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import mix64, pieces, powers, sha256, text_bytes, texts

K = 24
W = 32
_CHUNK = 1 << 19
_LOW = np.uint64(0xFFFFFFFF)


def _kgram_hashes(points: np.ndarray, k: int) -> np.ndarray:
    """32-bit hashes of all k-grams, by differences of one running sum."""
    up, down = powers(len(points) + 1)
    total = np.zeros(len(points) + 1, np.uint64)
    np.cumsum(mix64(points.astype(np.uint64) + np.uint64(1)) * up[: len(points)], out=total[1:])
    return mix64((total[k:] - total[:-k]) * down[: len(points) - k + 1]) >> np.uint64(32)


def fingerprint(text: str, k: int = K, w: int = W) -> tuple[np.ndarray, np.ndarray]:
    """Positions and 32-bit hashes (both uint32) of the chosen k-grams."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    n = len(points)
    if not n:
        return np.zeros(0, np.uint32), np.zeros(0, np.uint32)
    k = min(k, n)
    grams = n - k + 1
    w = min(w, grams)
    found = []
    for at in range(0, grams - w + 1, _CHUNK):
        many = min(_CHUNK, grams - w + 1 - at)  # windows that start in this chunk
        h = _kgram_hashes(points[at : at + many + w + k - 2], k)
        # the smallest key is the smallest hash and, on ties, the rightmost position
        keys = (h << np.uint64(32)) | (_LOW - np.arange(at, at + len(h), dtype=np.uint64))
        span = 1
        while span * 2 <= w:
            keys = np.minimum(keys[: len(keys) - span], keys[span:])
            span *= 2
        keys = np.minimum(keys[:many], keys[w - span : w - span + many])
        keep = np.ones(len(keys), bool)
        keep[1:] = keys[1:] != keys[:-1]
        keys = keys[keep]
        if found and len(keys) and found[-1][-1] == keys[0]:
            keys = keys[1:]
        found.append(keys)
    keys = np.concatenate(found)
    return (_LOW - (keys & _LOW)).astype(np.uint32), (keys >> np.uint64(32)).astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard likeness of two hash sets (each sorted, distinct); 1 if both are empty."""
    if not len(a) and not len(b):
        return 1.0
    if not len(a) or not len(b):
        return 0.0
    both = np.concatenate([a, b])
    both.sort()
    common = int(np.count_nonzero(both[1:] == both[:-1]))
    return common / (len(both) - common)


def encode(pos: np.ndarray, hashes: np.ndarray) -> str:
    """Hex, 16 digits a chosen k-gram: 8 of its position, 8 of its hash."""
    out = np.empty((len(pos), 2), ">u4")
    out[:, 0], out[:, 1] = pos, hashes
    return out.tobytes().hex()


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, w: int = W) -> DataFrame:
    """doc_id, n_chars and ``grams``: the chosen (pos, hash), in text order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            found = [(len(t), *fingerprint(t, k, w)) for t in texts(b.column("text"))]
            grams = [[{"pos": int(p), "hash": int(x)} for p, x in zip(pos, h)] for _, pos, h in found]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([n for n, *_ in found], pa.int64()), pa.array(grams, pa.list_(pa.struct([("pos", pa.int64()), ("hash", pa.int64())])))],
                names=["doc_id", "n_chars", "grams"],
            )

    return text_bytes(df, id_col, text_col).mapInArrow(run, "doc_id long, n_chars long, grams array<struct<pos:long,hash:long>>")


def edit(text: str, next_text: str) -> str:
    """The last half of the code points replaced by the first as many of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + next_text[:half]


def with_edits(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, w: int = W) -> DataFrame:
    """Fingerprints of each text and of its edit with the next document (by
    descending id; after the last comes the first), and their likeness.

    The ids are cut into ranges of about equal counts, read from the id column
    alone. Texts move once, to the range of their id; the first document of
    each range is also sent to the range before it, where it is the next of
    the last one. A task streams its sorted rows with one row of look-ahead.
    Rows with an equal id follow each other in order of their text; rows with
    a null id come last.
    """
    spark = df.sparkSession
    rows = text_bytes(df, id_col, text_col)
    n = 2 * max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = rows.approxQuantile("doc_id", [i / n for i in range(1, n)], 1 / (4 * n))
    cuts = np.unique(np.array(found, np.float64).astype(np.int64))

    def ranges(ids: pa.Array) -> np.ndarray:
        """Range 0 holds the largest ids; null ids have the last one."""
        out = len(cuts) - np.searchsorted(cuts, ids.fill_null(0).to_numpy(zero_copy_only=False), "right")
        out[ids.is_null().to_numpy(zero_copy_only=False)] = len(cuts) + 1
        return out

    def firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            part, i = np.unique(ranges(b.column("doc_id")), return_inverse=True)
            most = np.full(len(part), np.iinfo(np.int64).min)
            np.maximum.at(most, i, b.column("doc_id").fill_null(most.min() if len(most) else 0).to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(most, pa.int64())], names=["part", "head"])

    # a row a range, and there are as many ranges as partitions
    heads = rows.select("doc_id").mapInArrow(firsts, "part int, head long").groupBy("part").agg(F.max("head").alias("head")).orderBy("part").collect()
    null_part = len(cuts) + 1
    before = {r["part"]: heads[i - 1]["part"] for i, r in enumerate(heads)}
    by_id = {r["head"]: before[r["part"]] for r in heads if r["part"] != null_part}
    ids = np.array(sorted(by_id), np.int64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            doc = b.column("doc_id")
            part = ranges(doc)
            head = np.isin(doc.fill_null(0).to_numpy(zero_copy_only=False), ids) | (part == null_part)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(part, pa.int32()), pa.array(np.zeros(len(part), bool))], names=["doc_id", "text", "part", "extra"])
            if head.any():
                copies = b.filter(pa.array(head))
                to = [before[null_part] if d is None else by_id[d] for d in copies.column("doc_id").to_pylist()]
                yield pa.RecordBatch.from_arrays([*copies.columns, pa.array(to, pa.int32()), pa.array([True] * len(to))], names=["doc_id", "text", "part", "extra"])

    dealt = (
        rows.mapInArrow(deal, "doc_id long, text binary, part int, extra boolean")
        .repartition(n, "part")
        .sortWithinPartitions(F.col("part"), F.col("extra"), F.col("doc_id").desc_nulls_last(), F.coalesce("text", F.lit(b"")))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # (part, doc_id, text, fingerprint): waits for its next
        out: list[tuple] = []
        for b in pieces(batches):
            for part, extra, doc, text in zip(b.column("part").to_pylist(), b.column("extra").to_pylist(), b.column("doc_id").to_pylist(), texts(b.column("text"))):
                pos, h = fingerprint(text, k, w)
                seen = np.unique(h)
                if last and last[0] == part:
                    out.append(_pair(last, text, seen, k, w))
                # of several copied rows (an id that repeats) only the first is the next
                last = None if extra else (part, doc, text, pos, h, seen)
            if out:
                yield _batch(out)
                out = []

    return dealt.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def _pair(row: tuple, next_text: str, next_seen: np.ndarray, k: int, w: int) -> tuple:
    _, doc, text, pos, h, seen = row
    edited = edit(text, next_text)
    epos, eh = fingerprint(edited, k, w)
    return doc, len(text), sha256(edited), encode(pos, h), encode(epos, eh), likeness(seen, np.unique(eh)), likeness(seen, next_seen)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)
