"""Exact dedup by an extendible-hash index over tables in the shared folder.

1. Every text is normalised (runs of white space become one space) and keyed
   by 63 bits of its SHA-256. A map task joins equal texts first, bytes
   compared, so a text that a third of all rows share leaves each task a few
   times; such an *entry* carries the text once, its least row and a count.
   Entries and the rows that belong to them are one Parquet table.
2. The directory grows by doubling: it starts at a depth that suits the bytes,
   and buckets beyond ``capacity`` are split by the next bit of the key until
   they fit or hold one key. Only (key, bytes) are read for that.
3. Each bucket, a range of keys, has an owner task: entries come sorted by key,
   and entries of one key are chained by comparing bytes. A bucket that can't
   be split (one key, many entries) gets overflow pages, each owned by a task;
   the pages' survivors meet in another round, with pages four times as large,
   until one page holds them.
4. Rows find what became of their entry by a join in which no key has more
   rows than one map task joins.

What goes through the driver: the split buckets, at most two for every
``capacity`` bytes and ``capacity`` grows so that these are at most 2**21.

Edge cases: a null text is the empty text; of equal texts the row with the
least doc_id stays (null ids last); rows that repeat an id are rows of their
own, and one row of a group stays; other columns are ignored; an empty table
gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import SPACE_WORDS, pieces, prepare, raw, text_bytes, written

KEY_BITS = 63
#: Bytes of a bucket: what its owner sorts.
CAPACITY = 32 << 20
#: Bytes of different texts that a map task holds to join equal ones.
HELD = 24 << 20
_MOST_BUCKETS = 1 << 20
_BLANK = ~SPACE_WORDS
_ROWS = "row long, doc_id long, entry long, key long, n_bytes long, n long, sha binary, text binary"
_OWNED = "entry long, leader long, keep_id long, n long, key long, pages int, n_bytes long, text binary"


def normalised(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of rows in which each run of white space is one space."""
    blank = _BLANK[data]
    again = np.zeros(len(data), bool)
    again[1:] = blank[:-1]
    again[off[:-1][off[:-1] < len(data)]] = False
    keep = ~(again & blank)
    out = np.where(blank, np.uint8(32), data)[keep]
    at = np.zeros(len(data) + 1, np.int64)
    np.cumsum(keep, out=at[1:])
    return out, at[off]


def _order(doc: int | None, row: int) -> tuple:
    return doc is None, doc or 0, row


def _entries(key_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 40  # the table is written once, so a row keeps its number
        rows, held, size = [], {}, 0  # (row, doc_id, entry); text -> [least row's order, count, key, digest]

        def flush() -> pa.RecordBatch:
            known = list(held.items())
            out = []
            for r, d, e in rows:
                text, (least, n, key, sha) = known[e]
                out.append((r, d, least[2], key, len(text), n, sha, text) if r == least[2] else (r, d, least[2], None, None, None, None, None))
            kinds = [pa.int64()] * 6 + [pa.binary()] * 2
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["row", "doc_id", "entry", "key", "n_bytes", "n", "sha", "text"])

        number: dict[bytes, int] = {}
        for b in pieces(batches):
            data, off = normalised(*raw(b.column("text")))
            data = data.tobytes()
            for k, doc in enumerate(b.column("doc_id").to_pylist()):
                text = data[off[k] : off[k + 1]]
                if text in number:
                    x = held[text]
                    x[0], x[1] = min(x[0], _order(doc, row)), x[1] + 1
                else:
                    sha = hashlib.sha256(text).digest()
                    held[text] = [_order(doc, row), 1, int.from_bytes(sha[:8], "big") >> 1 >> (KEY_BITS - key_bits) << (KEY_BITS - key_bits), sha]
                    number[text] = len(number)
                    size += len(text)
                rows.append((row, doc, number[text]))
                row += 1
            if size >= HELD or len(rows) >= 200_000:
                yield flush()
                rows, held, number, size = [], {}, {}, 0
        if rows:
            yield flush()

    return run


def directory(keys: DataFrame, capacity: int, spread: int) -> tuple[DataFrame, int, int, DataFrame]:
    """The index's directory over ``keys`` (key, n_bytes): (buckets, first
    depth, bytes, splits). ``buckets``: start of the key range, depth, n_bytes
    and pages. ``splits``: for each slot of the first depth that was split or
    has pages the sorted starts of its buckets and their pages."""
    total = int(keys.agg(F.sum("n_bytes")).first()[0] or 0)
    capacity = max(capacity, total // _MOST_BUCKETS)
    first = depth = min(KEY_BITS, max(1, (max(2 * total // capacity, 4 * spread) - 1).bit_length()))

    def slot(d: int):
        return F.shiftright("key", KEY_BITS - d)

    active, done = keys.withColumn("slot", slot(depth)), []
    while True:
        fill = written(active.groupBy("slot").agg(F.sum("n_bytes").alias("n_bytes"), F.min("key").alias("lo"), F.max("key").alias("hi")), "index-fill")
        over = (F.col("n_bytes") > capacity) & (F.col("lo") < F.col("hi"))
        pages = F.when(F.col("n_bytes") > capacity, F.ceil(F.col("n_bytes") / capacity)).otherwise(1).cast("int")
        done.append(fill.filter(~over).select(F.shiftleft("slot", KEY_BITS - depth).alias("start"), F.lit(depth).alias("depth"), "n_bytes", pages.alias("pages")))
        more = fill.filter(over).select("slot")
        if more.isEmpty():
            break
        active = active.join(more, "slot", "left_semi").withColumn("slot", slot(depth + 1))
        depth += 1
    buckets = done[0]
    for x in done[1:]:
        buckets = buckets.unionByName(x)
    splits = (
        buckets.filter((F.col("depth") > first) | (F.col("pages") > 1))
        .withColumn("slot", F.shiftright("start", KEY_BITS - first))
        .groupBy("slot")
        .agg(F.sort_array(F.collect_list(F.struct("start", "pages"))).alias("x"))
        .select("slot", F.col("x.start").alias("starts"), F.col("x.pages").alias("pages"))
    )
    return buckets, first, total, splits


def _owned(entries: DataFrame, capacity: int) -> DataFrame:
    """One round: each entry with the leader of its text in its page."""
    spread = max(2, int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    _, first, total, splits = directory(entries.select("key", "n_bytes"), capacity, spread)
    slot = F.shiftright("key", KEY_BITS - first)
    at = F.size(F.filter("starts", lambda s: s <= F.col("key")))
    placed = (
        # bounded: see the module's text
        entries.withColumn("slot", slot)
        .join(F.broadcast(splits.withColumnRenamed("pages", "each")), "slot", "left")
        .withColumn("bucket", F.when(F.col("starts").isNull(), F.shiftleft("slot", KEY_BITS - first)).otherwise(F.element_at("starts", at)))
        .withColumn("pages", F.when(F.col("starts").isNull(), 1).otherwise(F.element_at("each", at)))
        .withColumn("page", F.pmod(F.xxhash64("entry"), F.col("pages")))
        .select("bucket", "page", "pages", "key", "entry", "doc_id", "n", "text")
    )
    owners = max(spread, -(-total // capacity))
    dealt = placed.repartition(owners, "bucket", "page").sortWithinPartitions("bucket", "page", "key")
    return written(dealt.mapInArrow(_chain, _OWNED), "index-owned")


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Owner task: the entries of a key are chained by comparing bytes. Held
    are the different texts of one key and the numbers of its entries."""
    now, chains, out, size = None, {}, [], 0

    def close() -> None:
        nonlocal size
        for links in chains.values():
            for text, members in links:
                least = min(m[0] for m in members)
                n, keep, pages = sum(m[1] for m in members), None if least[0] else least[1], now[3]
                for order, _ in members:
                    leads = order == least
                    out.append((order[2], least[2], keep, n, now[2], pages, len(text), text if leads and pages > 1 else None))
                size += len(text) * (pages > 1) + 64 * len(members)
        chains.clear()

    def batch() -> pa.RecordBatch:
        kinds = [pa.int64()] * 5 + [pa.int32(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["entry", "leader", "keep_id", "n", "key", "pages", "n_bytes", "text"])

    for b in pieces(batches):
        columns = [b.column(c).to_pylist() for c in ("bucket", "page", "key", "pages", "entry", "doc_id", "n", "text")]
        for bucket, page, key, pages, entry, doc, n, text in zip(*columns):
            if (bucket, page, key, pages) != now:
                close()
                now = (bucket, page, key, pages)
                if size >= HELD:
                    yield batch()
                    out, size = [], 0
            links = chains.setdefault(len(text), [])  # texts of another length need no comparison
            for known, members in links:
                if known == text:
                    members.append((_order(doc, entry), n))
                    break
            else:
                links.append((text, [(_order(doc, entry), n)]))
    close()
    if out:
        yield batch()


def duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, key_bits: int = KEY_BITS) -> DataFrame:
    """One row per row of ``df``: doc_id, keep_id (of the row that stays),
    group_size, kept, text_sha256 (of the normalised text). ``key_bits`` under
    63 makes keys collide (for tests); results stay the same."""
    prepare(df.sparkSession)
    rows = written(text_bytes(df, id_col, text_col).mapInArrow(_entries(key_bits), _ROWS), "index-rows")
    entries = rows.filter("row = entry")
    out = _owned(entries.select("entry", "doc_id", "key", "n_bytes", "n", "text"), capacity)
    found = out.select("entry", "leader", "keep_id", "n")
    while not out.filter("pages > 1").isEmpty():
        left, capacity = out.filter("pages > 1 and entry = leader"), 4 * capacity
        out = _owned(left.select("entry", F.col("keep_id").alias("doc_id"), "key", "n_bytes", "n", "text"), capacity)
        last = out.select(F.col("entry").alias("leader"), F.col("leader").alias("l"), F.col("keep_id").alias("k"), F.col("n").alias("m"))
        found = found.join(last, "leader", "left").select("entry", F.coalesce("l", "leader").alias("leader"), F.when(F.col("l").isNull(), F.col("keep_id")).otherwise(F.col("k")).alias("keep_id"), F.coalesce("m", "n").alias("n"))
    found = found.join(entries.select("entry", "sha"), "entry")
    return rows.select("row", "doc_id", "entry").join(found, "entry").select(
        "doc_id", "keep_id", F.col("n").alias("group_size"), (F.col("row") == F.col("leader")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256")
    )
