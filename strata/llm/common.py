"""Shared helpers: Arrow batches as numpy bytes, word spans and hashes.

Tasks see texts as the raw UTF-8 bytes of an Arrow batch, so a batch is
tokenised and hashed by a few numpy passes instead of one Python step a word.
A batch is cut into pieces of a few MB of text first; memory is bounded by
that and by the longest single text.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_path

PIECE_BYTES = 2 << 20
_BLOCK = 1 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it
    (an installed package or ``--py-files`` does the same on a cluster)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in have:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, have)])
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts the lineage, keeps
    column pruning and gives the planner the real size."""
    path = scratch_path(df.sparkSession, name)
    for paths in _tidied.get():
        paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


_tidied: ContextVar[tuple[list[str], ...]] = ContextVar("tidied", default=())


@contextmanager
def tidied(spark: SparkSession) -> Iterator[list[DataFrame]]:
    """The tables that ``written`` makes inside are removed at the end, also
    after a failure, but for those that the frames put into the list read.
    Nothing made inside may be read later by any other frame."""
    kept: list[DataFrame] = []
    paths: list[str] = []
    token = _tidied.set((*_tidied.get(), paths))
    try:
        yield kept
        files = [f for df in kept for f in df.inputFiles()]
        used = {os.path.basename(os.path.dirname(f)) for f in files}
    except BaseException:
        used = set()
        raise
    finally:
        _tidied.reset(token)
        for path in paths:
            if os.path.basename(path) not in used:
                at = spark._jvm.org.apache.hadoop.fs.Path(path)
                at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def text_bytes(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text as binary) with fixed names, whatever else ``df`` carries."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))


# -- Arrow ------------------------------------------------------------------


def raw(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a binary or string column; a null row is empty."""
    if col.null_count:
        col = col.fill_null(b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    wide = pa.types.is_large_binary(col.type) or pa.types.is_large_string(col.type)
    off = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    data = col.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row slices whose ``column`` holds about ``most`` bytes (or one row)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, off = raw(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(off, off[at] + most, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def texts(col: pa.Array) -> list[str]:
    """The rows as str; a null is the empty text."""
    return ["" if b is None else b.decode("utf-8", "replace") for b in col.to_pylist()]


def sha256(data: bytes | str) -> str:
    return hashlib.sha256(data.encode("utf-8", "replace") if isinstance(data, str) else data).hexdigest()


# -- words and hashes -------------------------------------------------------


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, bool)
    for a, b in ranges:
        out[a : b + 1] = True
    return out


#: Words between white space: [^\x20\x09-\x0D]+ (all delimiters are ASCII, so bytes serve as well as code points).
SPACE_WORDS = ~byte_class((0x20, 0x20), (0x09, 0x0D))

_rng = np.random.default_rng(20240229)
_TABLE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = _TABLE.copy()
_LOWER[65:91] = _TABLE[97:123]
_BASE = 0x9E3779B97F4A7C15
_INV = pow(_BASE, -1, 1 << 64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[0] = 1
    return np.multiply.accumulate(out)


_POW = {"up": _powers(_BASE, _BLOCK), "down": _powers(_INV, _BLOCK)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n > len(_POW["up"]):
        return _powers(_BASE, n), _powers(_INV, n)
    return _POW["up"], _POW["down"]


def word_spans(data: np.ndarray, off: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte spans of all words and, by row, the index of its first word
    (one entry more than rows). Words never cross rows."""
    m = word[data]
    before = np.zeros(len(m), bool)
    before[1:] = m[:-1]
    before[off[:-1][off[:-1] < len(m)]] = False
    starts = np.flatnonzero(m & ~before)
    after = np.zeros(len(m), bool)
    after[:-1] = m[1:]
    inner = off[1:]
    after[inner[inner > 0] - 1] = False
    ends = np.flatnonzero(m & ~after) + 1
    return starts, ends, np.searchsorted(starts, off)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hashes of byte spans (sorted, disjoint), by a few MB at a time."""
    table_ = _LOWER if lower else _TABLE
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + _BLOCK, "right")))
        base = starts[at]
        block = data[base : ends[to - 1]]
        up, down = powers(len(block) + 1)
        total = np.zeros(len(block) + 1, np.uint64)
        np.cumsum(table_[block] * up[: len(block)], out=total[1:])
        s, e = starts[at:to] - base, ends[at:to] - base
        h = (total[e] - total[s]) * down[s]
        out[at:to] = mix64(h + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        at = to
    return out


def rows_of(first: np.ndarray) -> np.ndarray:
    """Row number of each element, from the first-element index by row."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))
