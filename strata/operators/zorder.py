"""Clustered layouts: rows ordered so that files cover small ranges of several
columns at once (Parquet row-group min/max then skip more files).

Each column is cut into quantile buckets. Numbers, dates and times are mapped
to numbers (``approxQuantile``: a few numbers a column reach the driver);
strings and binaries are compared whole with boundaries from a sample of at
most about ``SAMPLE`` values, so a common prefix does no harm. The buckets are
combined into one long, in Z-order (their bits interleaved) or along a Hilbert
curve (neighbouring values of the curve are neighbouring cells, so a file
never jumps across the space), and the data is range-partitioned and sorted by
it. There are about four cells a file, so the layout follows the table's size.
A hash of the row is a secondary range key, so one very common cell can still
spread over several files. NULLs go to the first bucket; no row is changed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Values sampled for the boundaries of a string or binary column, and bytes of each.
SAMPLE = 20_000
SAMPLE_BYTES = 256


def order_key(df: DataFrame, name: str) -> Column:
    """A double (for strings and binaries: their bytes) that orders as the column does."""
    kind, c = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return c.cast("double")
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        origin = F.lit("1970-01-01").cast("timestamp_ntz")
        return F.timestamp_diff("MICROSECOND", origin, c.cast("timestamp_ntz")).cast("double")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return c.cast("binary")
    raise TypeError(f"column {name} of type {kind.simpleString()} has no order")


def bits_for(num_files: int, columns: int) -> int:
    """Bits a column, so that there are about four Z cells a file."""
    return max(1, min(62 // columns, math.ceil((math.log2(max(1, num_files)) + 2) / columns)))


def _byte_bounds(df: DataFrame, keys: list[str], n: int) -> dict[str, list[bytes]]:
    """Sampled quantiles of binary columns, n - 1 of them at most."""
    if not keys:
        return {}
    heads = df.select(*[F.substring(k, 1, SAMPLE_BYTES).alias(k) for k in keys])
    rows = heads.sample(min(1.0, SAMPLE / max(1, df.count())), seed=7).collect()
    out = {}
    for k in keys:
        values = sorted(bytes(r[k]) for r in rows if r[k] is not None)
        out[k] = sorted({values[len(values) * i // n] for i in range(1, n)}) if values else []
    return out


def buckets(df: DataFrame, cols: list[str], bits: int, rel_error: float | None = None) -> list[Column]:
    """The quantile bucket of each column, below 2**bits. ``df`` holds the
    order keys as ``_k0``, ``_k1`` ... (NULL: bucket 0)."""
    n = 1 << bits
    keys = [f"_k{i}" for i in range(len(cols))]
    binary = [k for k in keys if isinstance(df.schema[k].dataType, T.BinaryType)]
    plain = [k for k in keys if k not in binary]
    found: dict = dict(zip(plain, df.approxQuantile(plain, [i / n for i in range(1, n)], rel_error or 1 / (4 * n)))) if plain else {}
    found |= _byte_bounds(df, binary, n)
    out = []
    for key in keys:
        bounds = sorted(set(found[key]))
        kind = "binary" if key in binary else "double"
        cuts = F.array(*[F.lit(q if key in binary else float(q)) for q in bounds]) if bounds else F.array().cast(f"array<{kind}>")
        below = F.filter(cuts, lambda q: q < F.col(key))  # noqa: B023  (built at once)
        out.append(F.when(F.col(key).isNull(), 0).otherwise(F.size(below)).cast("long"))
    return out


def z_value(cells: list[Column], bits: int) -> Column:
    z = F.lit(0).cast("long")
    for j, cell in enumerate(cells):
        for bit in range(bits):
            z = z.bitwiseOR(F.shiftleft(F.shiftright(cell, bit).bitwiseAND(1), bit * len(cells) + j))
    return z


def _xor(a: Column, b: Column) -> Column:
    return a.bitwiseXOR(b)


def hilbert_value(cells: list[Column], bits: int) -> Column:
    """Place on the Hilbert curve through 2**bits cells a column (Skilling's
    transposition, 2004): axes are exchanged or inverted bit by bit, then Gray
    coded and interleaved. All inside array functions, so that the expression
    grows with bits x columns only."""
    n = len(cells)
    long = lambda x: F.lit(x).cast("long")
    pairs = lambda order: F.array(*[F.struct(long(q).alias("q"), F.lit(i).alias("i")) for q, i in order])

    def turn(x: Column, s: Column) -> Column:
        low = s["q"] - 1
        swap = _xor(F.get(x, F.lit(0)), F.get(x, s["i"])).bitwiseAND(low)
        inverted = F.transform(x, lambda v, k: F.when(k == 0, _xor(v, low)).otherwise(v))
        exchanged = F.transform(x, lambda v, k: F.when((k == 0) | (k == s["i"]), _xor(v, swap)).otherwise(v))
        return F.when(F.get(x, s["i"]).bitwiseAND(s["q"]) != 0, inverted).otherwise(exchanged)

    x = F.array(*cells)
    if bits > 1:
        x = F.aggregate(pairs([(1 << b, i) for b in range(bits - 1, 0, -1) for i in range(n)]), x, turn)
    # Gray code: each axis takes the exclusive or of those before it
    none = F.array().cast("array<long>")
    x = F.aggregate(x, none, lambda done, v: F.concat(done, F.array(_xor(F.coalesce(F.get(done, F.size(done) - 1), long(0)), v))))

    def placed(x: Column) -> Column:
        top = F.get(x, F.lit(n - 1))
        flip = F.aggregate(F.array(*[long(1 << b) for b in range(bits - 1, 0, -1)]), long(0), lambda t, q: F.when(top.bitwiseAND(q) != 0, _xor(t, q - 1)).otherwise(t)) if bits > 1 else long(0)
        steps = pairs([(1 << b, i) for b in range(bits - 1, -1, -1) for i in range(n)])
        return F.aggregate(steps, long(0), lambda h, s: h * 2 + F.when(_xor(F.get(x, s["i"]), flip).bitwiseAND(s["q"]) != 0, long(1)).otherwise(long(0)))

    # one element: its value is named once and used often
    return F.get(F.transform(F.array(x), placed), F.lit(0))


def _layout(df: DataFrame, cols: list[str], num_files: int, bits: int | None, within: list[str], curve) -> DataFrame:
    if not cols:
        raise ValueError("a clustered layout needs at least one column")
    bits = bits or bits_for(num_files, len(cols))
    keyed = df.withColumns({f"_k{i}": order_key(df, c) for i, c in enumerate(cols)})
    return (
        keyed.withColumn("_z", curve(buckets(keyed, cols, bits), bits))
        .withColumn("_h", F.xxhash64(*[F.col(c) for c in df.columns]))
        .repartitionByRange(num_files, *within, "_z", "_h")
        .sortWithinPartitions(*within, "_z", *cols)
        .select(*df.columns)
    )


def zorder_layout(df: DataFrame, cols: list[str], num_files: int, bits: int | None = None, within: list[str] = []) -> DataFrame:  # noqa: B006
    return _layout(df, cols, num_files, bits, within, z_value)


def hilbert_layout(df: DataFrame, cols: list[str], num_files: int, bits: int | None = None, within: list[str] = []) -> DataFrame:  # noqa: B006
    """``within``: columns that come first in the order (of table partitions)."""
    return _layout(df, cols, num_files, bits, within, hilbert_value)
