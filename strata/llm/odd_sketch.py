"""MinHash near-dedup with odd sketches.

A document's set is its distinct 2-word shingles (A-Z lower-cased, words
between white space; the whole sequence if it has fewer words). Documents are
linked if ``100 * |A & B| >= 80 * |A | B|``, and a group is a connected
component of the links.

1. Equal sets (by a 128-bit sum of their hashes) become one class.
2. Each class has ``BANDS`` bands of ``ROWS`` MinHash samples. A pair at the
   threshold misses all bands with probability (1 - 0.8**4)**48, about 1e-11.
3. The same samples are folded into a parity bitmap, the odd sketch: the XOR
   of two has a bit for (nearly) each sample in which they differ, and its
   population count estimates high similarities precisely. Pairs that share
   a band and whose estimate reaches ``ESTIMATE`` are checked on their full
   sets. A pair at the threshold that the star round does not check is lost
   by the bands or here with probability 1.2e-11 together.
4. Before that, a second parity bitmap, of the whole set, drops pairs without
   loss: the population count of the XOR never exceeds |A ^ B|, and linked
   sets have 9 * |A ^ B| <= |A| + |B|. It has 4 bits a shingle (512 to 65,536
   in all), so pairs a little below the threshold go here already.
5. Star round: each class is checked against the least class of the bucket
   that it shares most often; the links found already join most of a group.
   Then only buckets that still hold several components are searched, in
   blocks of bounded size: first the best pair of each class, and at last
   every pair across components that was not checked yet. So no link is lost
   and no group is expanded into all pairs.

Sets may be large and are never moved except for classes that share a band.

A document is a row: its node is a row number that is written with the
features, and its text is found again by 128 bits of (id, text). So an id that
repeats with another text is another document.

Edge cases: null and empty texts, and texts without words, have the empty set
and are linked with nothing; they are all kept. Rows that repeat an id with
the same text get the same result; with different texts, each is judged by its
own links, and ``component_id`` is the least id reachable from that row. A row
with a null id takes part: its component is the least id reachable (null if
there is none), and it is kept if that is null. ``deduplicated`` leaves one row
of each group whatever its ids. Extra columns are not read by
``near_duplicates`` and kept by ``deduplicated``. An id that is no number is
an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import SPACE_WORDS, mix64, pieces, raw, text_bytes, tidied, word_hashes, word_spans, written
from strata.llm.components import components

BANDS, ROWS = 48, 4
SAMPLES = BANDS * ROWS
BITS = 1024
THRESHOLD = 80
ESTIMATE = 0.55
BLOCK = 256
_rng = np.random.default_rng(1009)
_XOR = _rng.integers(1, 1 << 63, SAMPLES, dtype=np.uint64)
_ODD = _rng.integers(1, 1 << 62, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MULT = np.uint64(0xD1342543DE82EF95)
_SLICE = 1 << 14
#: XOR counts up to this are similar enough to be checked.
MOST_BITS = int(BITS / 2 * (1 - np.exp(-4 * SAMPLES * (1 - ESTIMATE) / BITS)))


def shingle_sets(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all rows, one after the other, and
    where each row's begin (one entry more)."""
    starts, ends, first = word_spans(data, off, SPACE_WORDS)
    h = word_hashes(data, starts, ends, lower=True)
    pair = mix64(h[:-1] * _MULT + h[1:]) if len(h) > 1 else h[:0]
    out, at = [], np.zeros(len(off), np.int64)
    for row, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
        if b - a > 1:
            s = np.sort(pair[a : b - 1])
            keep = np.ones(len(s), bool)
            keep[1:] = s[1:] != s[:-1]
            s = s[keep]
        else:
            s = mix64(h[a:b] ^ _MULT)
        out.append(s)
        at[row + 1] = at[row] + len(s)
    return (np.concatenate(out) if out else h[:0]), at


def samples(sets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """MinHash samples, (rows, SAMPLES); every row has a shingle."""
    n = len(at) - 1
    out = np.empty((SAMPLES, n), np.uint64)
    row = 0
    while row < n:
        to = max(row + 1, int(np.searchsorted(at, at[row] + _SLICE, "right")) - 1)
        part, where = sets[at[row] : at[to]], at[row:to] - at[row]
        x = np.empty_like(part)
        for k in range(SAMPLES):
            np.bitwise_xor(part, _XOR[k], out=x)
            np.multiply(x, _ODD[k], out=x)
            out[k, row:to] = np.minimum.reduceat(x, where)
        row = to
    return out.T


def band_keys(mins: np.ndarray) -> np.ndarray:
    """(rows, BANDS) bucket keys; a key is of one band only."""
    m = mins.reshape(len(mins), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), m.shape[:2]).copy()
    for r in range(ROWS):
        key = mix64(key * _MULT + m[:, :, r])
    return key.view(np.int64)


def odd_sketches(mins: np.ndarray) -> np.ndarray:
    """(rows, BITS / 8) bytes: the parity of the samples that hash to each bit."""
    bit = (mix64(mins + np.arange(1, SAMPLES + 1, dtype=np.uint64) * _MULT) >> np.uint64(54)).astype(np.int64)
    cell = bit + np.arange(len(mins))[:, None] * BITS
    return np.packbits((np.bincount(cell.ravel(), minlength=len(mins) * BITS) & 1).astype(np.uint8)).reshape(len(mins), BITS // 8)


def parity_bits(n: int) -> int:
    """Size of the bitmap of a whole set: a power of two."""
    return 1 << min(16, max(9, (4 * n - 1).bit_length()))


def parity(s: np.ndarray) -> bytes:
    """The parity of the shingles that hash to each bit. A bitmap folded in
    half (XOR of the halves) is that of half the size."""
    n = parity_bits(len(s))
    bit = (mix64(s ^ np.uint64(0x5851F42D4C957F2D)) & np.uint64(n - 1)).astype(np.int64)
    return np.packbits((np.bincount(bit, minlength=n) & 1).astype(np.uint8)).tobytes()


def folded(bitmap: bytes, size: int) -> np.ndarray:
    """A bitmap as 64-bit words, folded to ``size`` bits."""
    x = np.frombuffer(bitmap, np.uint64)
    while len(x) * 64 > size:
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return x


def likeness(different_bits) -> float:
    """Estimated Jaccard likeness from the population count of the XOR."""
    x = np.minimum(np.asarray(different_bits, float), BITS / 2 - 0.5)
    return 1 + BITS / (4 * SAMPLES) * np.log(1 - 2 * x / BITS)


def linked(a: np.ndarray, b: np.ndarray, threshold: int = THRESHOLD) -> bool:
    """The exact rule on two full sets (sorted, distinct)."""
    if not len(a) or not len(b) or 100 * min(len(a), len(b)) < threshold * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort()
    common = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * common >= threshold * (len(both) - common)


def row_key(id_col: str, text_col: str) -> tuple:
    """Two 64-bit hashes of (id, text)."""
    both = F.col(id_col).cast("long"), F.col(text_col).cast("string").cast("binary")
    return F.xxhash64(*both), F.xxhash64(F.lit(1), *both)


def _keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    key1, key2 = row_key(id_col, text_col)
    return df.select(F.col(id_col).cast("long").alias("doc_id"), key1.alias("key1"), key2.alias("key2"), F.col(text_col).cast("string").cast("binary").alias("text"))


def features(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """node (a row number), doc_id, key1, key2, n_shingles, two sums that stand
    for the set, band keys, sketch. The numbers are to be written at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            sets, at = shingle_sets(*raw(b.column("text")))
            total = np.zeros((2, len(sets) + 1), np.uint64)
            np.cumsum(sets, out=total[0, 1:])
            np.cumsum(mix64(sets ^ _MULT), out=total[1, 1:])
            sums = (total[:, at[1:]] - total[:, at[:-1]]).view(np.int64)
            n = np.diff(at)
            some = np.flatnonzero(n)
            mins = samples(sets, np.append(at[:-1][some], at[-1])) if len(some) else np.zeros((0, SAMPLES), np.uint64)
            size = np.zeros(len(n) + 1, np.int32)
            size[1:] = np.cumsum((n > 0) * BANDS)
            sketch = [None] * len(n)
            for row, s in zip(some.tolist(), odd_sketches(mins)):
                sketch[row] = s.tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    *(b.column(c) for c in ("node", "doc_id", "key1", "key2")), pa.array(n, pa.int64()), pa.array(sums[0]), pa.array(sums[1]),
                    pa.ListArray.from_arrays(pa.array(size, pa.int32()), pa.array(band_keys(mins).ravel(), pa.int64())),
                    pa.array(sketch, pa.binary()),
                ],
                names=["node", "doc_id", "key1", "key2", "n_shingles", "sum1", "sum2", "bands", "sketch"],
            )

    rows = _keyed(df, id_col, text_col).withColumn("node", F.monotonically_increasing_id())
    return rows.mapInArrow(run, "node long, doc_id long, key1 long, key2 long, n_shingles long, sum1 long, sum2 long, bands array<long>, sketch binary")


def _checked(pairs: DataFrame, texts: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a, b) whose full sets are linked."""
    t = lambda x: texts.select(F.col("node").alias(x), F.col("text").alias(f"text_{x}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple = (None, None)
        for b in batches:
            keep = []
            for i, (x, y) in enumerate(zip(b.column("text_a").to_pylist(), b.column("text_b").to_pylist())):
                if last[0] != y:
                    last = (y, _set(y))
                keep.append(linked(_set(x), last[1], threshold))
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(t("a"), "a").join(t("b"), "b").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(run, "a long, b long")


def _with_parity(rows: DataFrame) -> DataFrame:
    """(node, text) with the bitmap of the whole set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            sets, at = shingle_sets(*raw(b.column("text")))
            bitmaps = [parity(sets[x:y]) for x, y in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(bitmaps, pa.binary())], names=["node", "text", "parity"])

    return rows.mapInArrow(run, "node long, text binary, parity binary")


def _set(text: bytes) -> np.ndarray:
    data = np.frombuffer(text, np.uint8)
    return shingle_sets(data, np.array([0, len(data)]))[0]


def _across(rows: DataFrame, best_only: bool) -> DataFrame:
    """Pairs across components inside a bucket that both bitmaps let pass.
    ``rows``: key, own_block, i, j (a pair of blocks), node, component,
    n_shingles, sketch, parity, dealt and sorted by (key, i, j)."""

    def pairs(group: list[pa.RecordBatch]) -> pa.RecordBatch | None:
        t = pa.Table.from_batches(group)
        ids, comp, n = (t.column(c).to_numpy() for c in ("node", "component", "n_shingles"))
        bits = np.frombuffer(b"".join(t.column("sketch").to_pylist()), np.uint64).reshape(len(ids), BITS // 64)
        bitmaps = t.column("parity").to_pylist()
        size = np.array([8 * len(x) for x in bitmaps])
        levels: dict[int, np.ndarray] = {}
        side, i, j = t.column("own_block").to_numpy(), t.column("i")[0].as_py(), t.column("j")[0].as_py()
        left = np.flatnonzero(side == i)
        right = left if i == j else np.flatnonzero(side == j)
        out: set[tuple[int, int]] = set()
        rest = np.full(len(ids), BITS + 1), np.zeros(len(ids), np.int64)
        for x in left.tolist():
            ok = right[(comp[right] != comp[x]) & (100 * np.minimum(n[right], n[x]) >= THRESHOLD * np.maximum(n[right], n[x]))]
            if not len(ok):
                continue
            d = np.bitwise_count(bits[ok] ^ bits[x]).sum(axis=1)
            ok, d = ok[d <= MOST_BITS], d[d <= MOST_BITS]
            keep = np.zeros(len(ok), bool)
            common = np.minimum(size[ok], size[x])
            for n_bits in np.unique(common).tolist():
                if n_bits not in levels:
                    zero = np.zeros(n_bits // 64, np.uint64)
                    levels[n_bits] = np.stack([folded(y, n_bits) if 8 * len(y) >= n_bits else zero for y in bitmaps])
                at = np.flatnonzero(common == n_bits)
                apart = np.bitwise_count(levels[n_bits][ok[at]] ^ levels[n_bits][x]).sum(axis=1, dtype=np.int64)
                keep[at] = apart * (100 + THRESHOLD) <= (100 - THRESHOLD) * (n[ok[at]] + n[x])
            ok, d = ok[keep], d[keep]
            if not len(ok):
                continue
            if best_only:
                better = d < rest[0][ok]
                rest[0][ok[better]], rest[1][ok[better]] = d[better], x
                out.add((x, int(ok[d.argmin()])))
            else:
                out.update((x, y) for y in ok.tolist())
        if best_only:
            out.update((int(rest[1][y]), int(y)) for y in np.flatnonzero(rest[0] <= BITS))
        if not out:
            return None
        p = ids[np.array(sorted(out))]
        return pa.RecordBatch.from_arrays([pa.array(p.max(axis=1)), pa.array(p.min(axis=1))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for b in batches:
            if not b.num_rows:
                continue
            at = np.stack([b.column(c).to_numpy() for c in ("key", "i", "j")], 1)
            cuts = [0, *(np.flatnonzero((at[1:] != at[:-1]).any(axis=1)) + 1).tolist(), len(at)]
            for x, y in zip(cuts[:-1], cuts[1:]):
                now = tuple(at[x])
                if held and now != last:
                    if (found := pairs(held)) is not None:
                        yield found
                    held = []
                last = now
                held.append(b.slice(x, y - x))
        if held and (found := pairs(held)) is not None:
            yield found

    return rows.mapInArrow(run, "a long, b long").distinct()


def _buckets_to_search(members: DataFrame, labels: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """The rows of buckets with several components, in pairs of blocks. The
    classes of the pivot's component need not meet each other: blocks of
    theirs meet the blocks of the others, and those meet among themselves."""
    own = F.coalesce("component", "node")
    rows = members.join(labels, "node", "left").select("key", "node", "pivot", own.alias("component"))
    rows = written(rows, "near-rows")
    per = rows.groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high"),
        F.max(F.when(F.col("node") == F.col("pivot"), F.col("component"))).alias("main"),
    ).filter("low <> high").select("key", "main")
    per = written(per, "near-keys")
    rows = written(rows.join(per, "key").select("key", "node", "component", (F.col("component") == F.col("main")).alias("is_main")), "near-open")
    count = rows.groupBy("key").agg(F.sum(F.col("is_main").cast("long")).alias("n1"), F.sum((~F.col("is_main")).cast("long")).alias("n2"))
    count = written(count.select("key", F.ceil(F.col("n1") / BLOCK).alias("b1"), F.ceil(F.col("n2") / BLOCK).alias("b2")), "near-count")
    rows = rows.join(count, "key")
    # blocks 0 .. b1-1 are of the main component, b1 .. b1+b2-1 of the others
    h = F.xxhash64("node")
    own_block = F.when(F.col("is_main"), F.pmod(h, F.col("b1"))).otherwise(F.col("b1") + F.pmod(h, F.greatest("b2", F.lit(1))))
    rows = rows.withColumn("own_block", own_block.cast("long"))
    others = F.sequence(F.col("b1"), F.col("b1") + F.col("b2") - 1)
    all_ = F.sequence(F.lit(0).cast("long"), F.col("b1") + F.col("b2") - 1)
    rows = rows.withColumn("with", F.explode(F.when(F.col("is_main"), others).otherwise(all_)))
    rows = rows.select("key", "own_block", F.least("own_block", "with").alias("i"), F.greatest("own_block", "with").alias("j"), "node", "component")
    rows = rows.join(bitmaps, "node")
    return rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")


def _judged(df: DataFrame, id_col: str, text_col: str, threshold: int) -> DataFrame:
    """One row a document: doc_id, key1, key2, n_shingles, the node that stands
    for its group, component_id, kept. Reads two tables in the shared folder."""
    if threshold < THRESHOLD:
        raise ValueError(f"the bands are set for thresholds of {THRESHOLD} or more")
    with tidied(df.sparkSession) as keep:
        feats = written(features(df, id_col, text_col), "near-features")
        some = feats.filter("n_shingles > 0")
        classes = written(some.groupBy("sum1", "sum2").agg(F.min("node").alias("node"), F.min("doc_id").alias("least")), "near-classes")
        first = some.join(classes.select("node"), "node", "left_semi")
        buckets = written(first.select("node", F.explode("bands").alias("key")), "near-buckets")
        pivots = written(buckets.groupBy("key").agg(F.min("node").alias("pivot"), F.max("node").alias("most")).filter("pivot < most").select("key", "pivot"), "near-pivots")
        members = written(buckets.join(pivots, "key"), "near-members")

        near = first.select("node", "key1", "key2").join(members.select("node").distinct(), "node", "left_semi")
        found = _keyed(df, id_col, text_col).join(near, ["key1", "key2"]).dropDuplicates(["key1", "key2"])
        texts = written(_with_parity(found.select("node", "text")), "near-texts")
        bitmaps = written(first.select("node", "n_shingles", "sketch").join(texts.select("node", "parity"), "node"), "near-bitmaps")

        star = members.filter("node <> pivot").groupBy("node", "pivot").agg(F.count(F.lit(1)).alias("n"))
        star = star.groupBy("node").agg(F.max_by("pivot", F.struct("n", -F.col("pivot"))).alias("pivot"))
        tested = written(star.select(F.col("node").alias("a"), F.col("pivot").alias("b")), "near-star")
        edges = written(_checked(tested, texts, threshold), "near-edges")
        labels = written(components(edges), "near-labels")
        for best_only in (True, False):
            rows = _buckets_to_search(members, labels, bitmaps)
            pairs = written(_across(rows, best_only).join(tested, ["a", "b"], "left_anti"), "near-pairs")
            if pairs.take(1):
                new = written(_checked(pairs, texts, threshold), "near-edges")
                tested, edges = tested.unionByName(pairs), edges.unionByName(new)
                labels = written(components(edges), "near-labels")

        low = labels.join(classes.select("node", "least"), "node").groupBy("component").agg(F.min("least").alias("low"))
        low = labels.join(written(low, "near-low"), "component")
        of = classes.join(low, "node", "left")
        of = written(of.select("sum1", "sum2", F.coalesce("component", "node").alias("group"), F.coalesce("low", "least").alias("component_id")), "near-of")
        keep += [feats, of]
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    out = feats.select("doc_id", "key1", "key2", "n_shingles", "sum1", "sum2").join(of, ["sum1", "sum2"], "left")
    return out.withColumn("component_id", component).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))).drop("sum1", "sum2")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id, kept."""
    return _judged(df, id_col, text_col, threshold).select("doc_id", "n_shingles", "component_id", "kept")


def deduplicated(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """The rows of ``df`` (all columns), one of each group: one with the least
    id (a null is the greatest). Where that id repeats in the group, the text
    with the least hash stays, and of rows that repeat id and text any one."""
    rows = written(_judged(df, id_col, text_col, threshold).filter("n_shingles > 0").select("group", "key1", "key2", "kept"), "near-judged")
    kept = rows.filter("kept")
    # groups of which several rows would stay: only where ids repeat or are null
    several = kept.groupBy("group").agg(F.min("key1").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("group", "least")
    several = written(several, "near-several")
    key1, key2 = row_key(id_col, text_col)
    out = df.withColumns({"_near_key1": key1, "_near_key2": key2})
    name = lambda x: x.select(F.col("key1").alias("_near_key1"), F.col("key2").alias("_near_key2"))
    on = ["_near_key1", "_near_key2"]
    gone = rows.filter("not kept").select("key1", "key2")
    if several.take(1):
        open_ = written(kept.join(several, "group").select("key1", "key2", (F.col("key1") == F.col("least")).alias("stays")).distinct(), "near-open-rows")
        gone = gone.unionByName(open_.filter("not stays").select("key1", "key2"))
        once = name(open_.filter("stays"))
        left = out.join(name(gone), on, "left_anti")
        out = left.join(once, on, "left_anti").unionByName(left.join(once, on, "left_semi").dropDuplicates(on))
    else:
        out = out.join(name(gone), on, "left_anti")
    return out.select(*df.columns)
