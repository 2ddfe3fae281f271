"""The prefix trie of conversations, by digests of blocks of turns.

Conversations are cut into blocks of ``block`` turns, and what is grouped
first is the digest of all turns up to a block's end: two conversations share
a block's nodes if and only if they share it. Where all conversations that
came to a block go on through the same one, its nodes follow from the block
alone. Turns are looked at one by one only in blocks where siblings diverge.

A prefix's digest is the exclusive or of its turns' digests, each mixed with
the turn's position: two lanes of 64 bits, from 120 bits of the SHA-256 of
role and text. So a running digest is an aggregate like a sum. Running values
take two steps, within slots of a conversation's turns and over the slots, so
no task sorts a whole long conversation, and every count is combined before
its shuffle, so a first turn that all share costs a row a task.

Subtree sums need no walk over the trie. For a node u, the sum over its
subtree of (members - 1) x bytes is, over u's members, the bytes of their turns
from u on, less each node once: a node counts as its smallest member's own, and
a conversation owns the nodes from some depth on. With E(c) the bytes before
that depth (all, if it owns none) it is the sum over members of
max(0, E(c) - bytes before u). Leaves are counted through their smallest member.

``ends_sha256`` hashes sorted ids in order, which can't be split: ids are
joined by slots of 1,024 ids first, and a task streams the slots of a node
through the hash, one batch in memory.

Edge cases: rows with a null conv_id belong to no conversation; a null role or
text is empty; turns that tie are ordered by role and text, equal rows are turns
of their own; a conversation without turns is a member of the root; an empty
table has no node; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import prepare, written

BLOCK = 4
#: Turns of a conversation that are sorted together; blocks likewise.
SLOT = 512
_IDS = 1024
_NODE = ["depth", "x", "y"]


def _digest(role: Column, text: Column, part: int) -> Column:
    """60 bits of SHA-256 over the role's length, the role and the text."""
    h = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    return F.conv(F.substring(h, 1 + 15 * part, 15), 16, 10).cast("long")


def _lanes(pos: Column) -> tuple[Column, Column]:
    return F.xxhash64(pos, F.col("a"), F.col("b")), F.xxhash64(F.col("b"), F.lit(17), pos, F.col("a"))


def _before(df: DataFrame, key: list[str], order: list[Column], slot: Column, **sums: tuple[str, Column]) -> DataFrame:
    """``df`` with running values over the earlier rows of its key (exclusive):
    each of ``sums`` is ("sum" or "bit_xor", value). ``slot`` must not fall
    within the order; slots are sorted apart and their totals run over the key."""
    agg = {"sum": F.sum, "bit_xor": F.bit_xor}
    df = df.withColumn("_slot", slot).withColumns({f"_v_{n}": v for n, (_, v) in sums.items()})
    inner = Window.partitionBy(*key, "_slot").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy(*key).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    slots = df.groupBy(*key, "_slot").agg(*[agg[how](f"_v_{n}").alias(f"_t_{n}") for n, (how, _) in sums.items()])
    slots = slots.select(*key, "_slot", *[F.coalesce(agg[how](f"_t_{n}").over(outer), F.lit(0).cast("long")).alias(f"_o_{n}") for n, (how, _) in sums.items()])
    out = df.withColumns({f"_i_{n}": F.coalesce(agg[how](f"_v_{n}").over(inner), F.lit(0).cast("long")) for n, (how, _) in sums.items()}).join(slots, [*key, "_slot"])
    joined = {n: F.col(f"_i_{n}") + F.col(f"_o_{n}") if how == "sum" else F.col(f"_i_{n}").bitwiseXOR(F.col(f"_o_{n}")) for n, (how, _) in sums.items()}
    return out.withColumns(joined).select(*[c for c in df.columns if c[0] != "_"], *sums)


def own_turns(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, pos (from 1), a and b (the turn's digest), n_bytes of its text."""
    t = df.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    ).filter("conv_id is not null")
    t = t.select("*", _digest(F.col("role"), F.col("text"), 0).alias("a"), _digest(F.col("role"), F.col("text"), 1).alias("b"), F.octet_length("text").cast("long").alias("n_bytes"))
    order = [F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("text").asc()]
    slot = F.coalesce(F.floor(F.col("turn") / SLOT).cast("long"), F.lit(-(1 << 62)))
    out = _before(t, ["conv_id"], order, slot, pos=("sum", F.lit(1).cast("long")))
    return out.select("conv_id", (F.col("pos") + 1).alias("pos"), "a", "b", "n_bytes")


def rebuilt_turns(own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations: conv_id, n turns; their turns). Conversation c starts
    with the first h own turns of c - c % 5 and goes on with its own after h,
    h = crc32(decimal c) % 9. A start has at most eight turns and five users."""
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    n_own = own.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_own")).withColumns({"h": h, "base": F.col("conv_id") - F.col("conv_id") % 5})
    n_base = n_own.select(F.col("conv_id").alias("base"), F.col("n_own").alias("n_base"))
    convs = n_own.join(n_base, "base", "left").withColumn("start", F.least("h", F.coalesce("n_base", F.lit(0)))).select("conv_id", "base", "h", "start", (F.col("start") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))).alias("n"))
    convs = written(convs, "trie-convs")
    starts = own.filter("pos <= 8").withColumnRenamed("conv_id", "base").join(convs.select("conv_id", "base", "start"), "base").filter("pos <= start").select("conv_id", "pos", "a", "b", "n_bytes")
    rest = own.join(convs.select("conv_id", "h", "start"), "conv_id").filter("pos > h").select("conv_id", (F.col("pos") - F.col("h") + F.col("start")).alias("pos"), "a", "b", "n_bytes")
    return convs.select("conv_id", "n"), starts.unionByName(rest)


def blocks_of(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """A row a block: conv_id, j (from 0), ``turns`` (x, y, n_bytes in order),
    the digest (px, py) and bytes (pb) before it, and the digest (ex, ey) at its end."""
    x, y = _lanes(F.col("pos"))
    t = turns.select("conv_id", F.floor((F.col("pos") - 1) / block).cast("long").alias("j"), F.struct("pos", x.alias("x"), y.alias("y"), "n_bytes").alias("t"))
    # at most ``block`` turns a group
    g = t.groupBy("conv_id", "j").agg(F.sort_array(F.collect_list("t")).alias("turns"), F.bit_xor("t.x").alias("bx"), F.bit_xor("t.y").alias("by"), F.sum("t.n_bytes").alias("bb"))
    out = _before(g, ["conv_id"], [F.col("j")], F.floor(F.col("j") / SLOT).cast("long"), px=("bit_xor", F.col("bx")), py=("bit_xor", F.col("by")), pb=("sum", F.col("bb")))
    return out.select("conv_id", "j", "turns", "px", "py", "pb", F.col("px").bitwiseXOR(F.col("bx")).alias("ex"), F.col("py").bitwiseXOR(F.col("by")).alias("ey"), (F.col("pb") + F.col("bb")).alias("eb"))


def _steps(block: int) -> Column:
    """Of a block's turns: depth, digest before and at it, bytes of the turn, before it, and in the block from it on."""
    def step(i: int) -> Column:
        seen, left = F.slice("turns", 1, i), F.slice("turns", i + 1, block)
        lane = [F.aggregate(seen, F.col("px"), lambda s, t: s.bitwiseXOR(t["x"])), F.aggregate(seen, F.col("py"), lambda s, t: s.bitwiseXOR(t["y"]))]
        now = F.element_at("turns", i + 1)
        size = lambda of: F.aggregate(of, F.lit(0).cast("long"), lambda s, t: s + t["n_bytes"])
        return F.struct(
            (F.col("j") * block + i + 1).alias("depth"), lane[0].alias("ux"), lane[1].alias("uy"), lane[0].bitwiseXOR(now["x"]).alias("x"), lane[1].bitwiseXOR(now["y"]).alias("y"),
            now["n_bytes"].alias("n_bytes"), (F.col("pb") + size(seen)).alias("before"), size(left).alias("rest"),
        )

    return F.explode(F.slice(F.array(*[F.when(F.size("turns") > i, step(i)) for i in range(block)]), F.lit(1), F.size("turns")))


def nodes(df: DataFrame, block: int = BLOCK, **names: str) -> DataFrame:
    """One row per node, see the module's text."""
    prepare(df.sparkSession)
    own = written(own_turns(df, **names), "trie-own")
    convs, turns = rebuilt_turns(own)
    blocks = written(blocks_of(turns, block), "trie-blocks")

    # 1. blocks by the digest at their end; a block's siblings share the digest before it
    family = ["j", "px", "py"]
    whole = [*family, "ex", "ey"]
    # equal digests at a block's end mean equal turns in it, so any member's will do
    groups = written(blocks.groupBy(*whole, F.size("turns").alias("m")).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("pb").alias("pb"), F.min("turns").alias("turns")), "trie-groups")
    forks = written(groups.groupBy(*family).agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select(*family), "trie-forks")

    # 2. nodes: of lone blocks from the group, else turn by turn
    lone = groups.join(forks, family, "left_anti").select("conv_id", "n_convs", "j", "ex", "ey", _steps(block).alias("s")).select("conv_id", "n_convs", "j", "ex", "ey", "s.*")
    split = (
        blocks.join(forks, family, "left_semi").select("conv_id", _steps(block).alias("s")).select("conv_id", "s.*")
        .groupBy(*_NODE).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), *[F.min(c).alias(c) for c in ("ux", "uy", "n_bytes", "before")])
    )
    columns = ["conv_id", "n_convs", *_NODE, "ux", "uy", "n_bytes", "before"]
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0").select("conv_id", "n_convs", *[F.lit(0).cast("long").alias(c) for c in columns[2:]])
    lone = lone.select(*columns, "j", "ex", "ey", "rest", F.lit(True).alias("lone"))
    none = [F.lit(None).cast("long").alias(c) for c in ("j", "ex", "ey", "rest")]
    trie = lone.unionByName(split.select(*columns, *none, F.lit(False).alias("lone"))).unionByName(root.select(*columns, *none, F.lit(False).alias("lone")))
    trie = written(trie, "trie-nodes")
    up = trie.filter("depth > 0").select((F.col("depth") - 1).alias("depth"), F.col("ux").alias("x"), F.col("uy").alias("y"))
    children = written(up.groupBy(*_NODE).agg(F.count(F.lit(1)).alias("n_children")), "trie-children")

    # 3. of each conversation: the bytes before the first node it owns, and whether it owns a leaf
    owned = trie.groupBy("conv_id").agg(F.min("before").alias("first"))
    leaf = trie.join(children, _NODE, "left_anti").groupBy("conv_id").agg(F.lit(1).cast("long").alias("leaf"))
    total = blocks.groupBy("conv_id").agg(F.max("eb").alias("total"))
    per = convs.join(total, "conv_id", "left").join(owned, "conv_id", "left").join(leaf, "conv_id", "left")
    per = written(per.select("conv_id", F.coalesce("first", "total", F.lit(0)).cast("long").alias("e"), F.coalesce("leaf", F.lit(0)).cast("long").alias("leaf")), "trie-per")

    # 4. sums over members: at the end of lone blocks, and at each turn of the others
    told = written(blocks.join(per, "conv_id"), "trie-told")
    over = lambda at: F.sum(F.greatest(F.col("e") - F.col(at), F.lit(0).cast("long")))
    at_end = told.join(forks, family, "left_anti").groupBy("j", "ex", "ey").agg(over("eb").alias("after"), F.sum("leaf").alias("n_leaves"))
    at_turn = told.join(forks, family, "left_semi").select("e", "leaf", _steps(block).alias("s")).select("e", "leaf", "s.*").groupBy(*_NODE).agg(over("before").alias("saved_tokens"), F.sum("leaf").alias("n_leaves"))
    at_root = per.agg(F.lit(0).cast("long").alias("depth"), F.sum("e").alias("saved_tokens"), F.sum("leaf").alias("n_leaves"))
    kept = [*columns, "saved_tokens", "n_leaves"]
    saved = trie.filter("lone").join(at_end, ["j", "ex", "ey"]).withColumn("saved_tokens", F.col("after") + (F.col("n_convs") - 1) * F.col("rest")).select(*kept)
    saved = saved.unionByName(trie.filter("not lone and depth > 0").join(at_turn, _NODE).select(*kept)).unionByName(trie.filter("depth = 0").join(at_root, "depth").select(*kept))

    # 5. parents, children, ends
    parents = trie.select(F.col("depth").alias("_d"), F.col("x").alias("_x"), F.col("y").alias("_y"), F.col("conv_id").alias("parent_conv_id"))
    up = (F.col("depth") - 1 == F.col("_d")) & (F.col("ux") == F.col("_x")) & (F.col("uy") == F.col("_y"))
    ends = _ends(convs, blocks, block)
    return (
        saved.join(parents, up, "left").join(children, _NODE, "left").join(ends, _NODE, "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        )
    )


def _ends(convs: DataFrame, blocks: DataFrame, block: int) -> DataFrame:
    """The hash of the sorted ids of the conversations that end at a node."""
    final = blocks.select("conv_id", (F.col("j") * block + F.size("turns")).alias("depth"), "ex", "ey")
    at = convs.join(final, (convs["conv_id"] == final["conv_id"]) & (convs["n"] == final["depth"]), "left")
    at = at.select(convs["conv_id"], *[F.coalesce(c, F.lit(0)).cast("long").alias(n) for c, n in (("depth", "depth"), ("ex", "x"), ("ey", "y"))])
    # a conversation ends once, so a slot has at most _IDS of them
    slots = at.groupBy(*_NODE, F.floor(F.col("conv_id") / _IDS).cast("long").alias("slot")).agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))
    return slots.repartition(*_NODE).sortWithinPartitions(*_NODE, "slot").mapInArrow(_hashed, "depth long, x long, y long, ends_sha256 string")


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, h = None, None
    for b in batches:
        out = []
        for d, x, y, ids in zip(*(b.column(c).to_pylist() for c in (*_NODE, "ids"))):
            if (d, x, y) == now:
                h.update(b"," + ids.encode())
                continue
            if now:
                out.append((*now, h.hexdigest()))
            now, h = (d, x, y), hashlib.sha256(ids.encode())
        if out:
            yield _ended(out)
    if now:
        yield _ended([(*now, h.hexdigest())])


def _ended(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64()] * 3 + [pa.string()])], names=[*_NODE, "ends_sha256"])
