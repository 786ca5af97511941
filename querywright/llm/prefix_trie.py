"""A trie of conversation prefixes from ROLLUP over positional turn columns.

1. Turns get their place in the conversation by a range sort and counts per conversation and range, so no task orders a whole
   conversation. A turn's id is a digest of role and text, with the words of the text beside it.
2. Conversations are laid out in blocks of WIDTH positional turn-id columns. A block is keyed by the node that the block
   before it ended in; a node's 128-bit id is the exclusive-or of the hashes of its (place, turn id) pairs, so the key of any
   block is an aggregate and needs no block before it. Equal blocks are counted first, then GROUP BY key, ROLLUP(t1 .. t8) makes
   all prefixes of all blocks together; grouping_id names the depth, and a prefix whose last column is null is no node.
3. Sums over subtrees are a second ROLLUP over the nodes of a block. Between blocks the totals go up the tree of block keys
   by doubling: the number of rounds is the logarithm of the number of blocks of the longest conversation.
4. The ids of conversations that end in a node are sorted by range, joined to chunks where they lie, and the chunks of a
   node are hashed in order as a stream, so that a node in which a third of all conversations end holds no task's memory.

Edge cases: a null conversation id belongs to no conversation and its rows are left out; null turns come first, ties of a
turn go by role and text; null role or text is empty; repeated rows are turns of their own; a conversation without turns
is a member of the root alone; an empty table has no nodes; other columns take no part whatever their names."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from querywright.llm.storage import stored

WIDTH = 8
GRAFT_EVERY = 20          # conversations that share the first turns of one
GRAFT_MOST = 4
CHUNK_IDS = 1 << 14       # conversation ids in a piece of text
SUPER = 1024              # blocks that a running total covers in one task
WORDS = r"[^\x20\x09-\x0D]+"

_T = [f"t{j + 1}" for j in range(WIDTH)]
_KEY = ["block", "x1", "x2"]


def turns(convs: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, pos, t): every turn with its place from 1 on and its id ``digest:words``."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = convs.filter(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv"), F.col(turn).alias("turn"), said(role).alias("role"), said(text).alias("text"))
    rows = rows.select("conv", "turn", "role", "text", F.monotonically_increasing_id().alias("tie"), F.concat_ws(
        ":", F.md5(F.concat(F.length("role"), F.lit(":"), "role", "text")), F.regexp_count("text", F.lit(WORDS)).cast("string")).alias("t"))
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "text", "tie"]
    held = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv", "t", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row"))
    held = stored(held)
    spans = held.groupBy("conv", "part").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select("conv", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first") + 1).alias("shift"))
    return held.join(spans, ["conv", "part"]).select("conv", (F.col("row") + F.col("shift")).alias("pos"), "t")


def grafted(rows: DataFrame, every: int = GRAFT_EVERY, most: int = GRAFT_MOST) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns (conv, pos, t) and all conversations (conv): the first h turns of conversation ``c - c % every``, then what
    follows the own first h; h is the checksum of the decimal id modulo ``most``."""
    sizes = stored(rows.groupBy("conv").agg(F.count(F.lit(1)).alias("n")))
    heads = rows.filter((F.col("conv") % every == 0) & (F.col("pos") < most)).select(F.col("conv").alias("p"), "pos", "t")
    known = sizes.withColumn("p", F.col("conv") - F.col("conv") % every).withColumn("h", F.crc32(F.col("conv").cast("string").cast("binary")) % most)
    known = known.join(sizes.select(F.col("conv").alias("p"), F.col("n").alias("np")), "p", "left").select(
        "conv", "p", "h", F.least("h", F.coalesce("np", F.lit(0))).alias("base"))
    own = rows.join(known, "conv").filter(F.col("pos") > F.col("h")).select("conv", (F.col("pos") - F.col("h") + F.col("base")).alias("pos"), "t")
    taken = known.filter("base > 0").join(heads, "p").filter(F.col("pos") <= F.col("base")).select("conv", "pos", "t")
    return own.unionByName(taken), sizes.select("conv")


def _hashes(pos: Column, t: Column) -> list[Column]:
    return [F.xxhash64(F.lit(seed), pos, t) for seed in (1, 2)]


def _xor(values: list[Column]) -> Column:
    out = values[0]
    for v in values[1:]:
        out = out.bitwiseXOR(v)
    return out


def blocks(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv, block, x1, x2, t1 .. t8): the turns in blocks of WIDTH columns with the key of the node before; a conversation without
    turns has one block of nulls."""
    place = F.col("pos") - 1
    h1, h2 = _hashes(F.col("pos"), F.col("t"))
    wide = rows.groupBy("conv", F.floor(place / WIDTH).alias("block")).agg(
        *[F.max(F.when(place % WIDTH == j, F.col("t"))).alias(name) for j, name in enumerate(_T)],
        F.bit_xor(h1).alias("h1"), F.bit_xor(h2).alias("h2"))
    wide = stored(wide.withColumn("super", F.floor(F.col("block") / SUPER)))
    prior = (Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    before = lambda w, c: F.coalesce(F.bit_xor(c).over(w), zero)
    outer, inner = Window.partitionBy("conv").orderBy("super").rowsBetween(*prior), Window.partitionBy("conv", "super").orderBy("block").rowsBetween(*prior)
    totals = wide.groupBy("conv", "super").agg(F.bit_xor("h1").alias("h1"), F.bit_xor("h2").alias("h2"))
    totals = totals.select("conv", "super", before(outer, "h1").alias("s1"), before(outer, "h2").alias("s2"))
    keyed = wide.withColumn("b1", before(inner, "h1")).withColumn("b2", before(inner, "h2")).join(totals, ["conv", "super"])
    keyed = keyed.select("conv", "block", _xor([F.col("b1"), F.col("s1")]).alias("x1"), _xor([F.col("b2"), F.col("s2")]).alias("x2"), *_T)
    bare = convs.join(wide.filter("block = 0").select("conv"), "conv", "left_anti").select(
        "conv", zero.alias("block"), zero.alias("x1"), zero.alias("x2"), *[F.lit(None).cast("string").alias(t) for t in _T])
    return keyed.unionByName(bare)


_ROLLUP = "SELECT block, x1, x2, {names}, {width} - bit_count(grouping_id()) AS d, {sums} FROM {{rows}} GROUP BY block, x1, x2, ROLLUP ({names})"


def _rollup(rows: DataFrame, sums: str) -> DataFrame:
    """All prefixes of all blocks in one grouping; ``d`` columns of a prefix are set, and the last one is a turn."""
    sql = _ROLLUP.format(names=", ".join(_T), width=WIDTH, sums=sums)
    made = rows.sparkSession.sql(sql, rows=rows)
    last = F.element_at(F.array(*_T), F.greatest("d", F.lit(1)).cast("int"))
    return made.filter(F.when(F.col("d") == 0, F.col("block") == 0).otherwise(last.isNotNull())).withColumn("last", F.when(F.col("d") > 0, last))


def nodes(laid: DataFrame) -> DataFrame:
    """One row per node: its block and columns, depth, id (i1, i2), parent's id (p1, p2), members, least member, words of the last text."""
    whole = laid.groupBy(*_KEY, *_T).agg(F.count(F.lit(1)).alias("c"), F.min("conv").alias("m"))
    made = _rollup(whole, "sum(c) AS n_convs, min(m) AS conv_id")
    out = {}
    zero = F.lit(0).cast("long")
    for k, x in enumerate(("x1", "x2")):
        parts = [_hashes(F.col("block") * WIDTH + j + 1, F.col(t))[k] for j, t in enumerate(_T)]
        out[f"i{k + 1}"] = _xor([F.col(x), *[F.when(F.col("d") > j, p).otherwise(zero) for j, p in enumerate(parts)]])
        out[f"p{k + 1}"] = _xor([F.col(x), *[F.when(F.col("d") > j + 1, p).otherwise(zero) for j, p in enumerate(parts)]])
    words = F.coalesce(F.substring_index("last", ":", -1).cast("long"), zero)
    return made.select(*_KEY, *_T, "d", (F.col("block") * WIDTH + F.col("d")).alias("depth"), "n_convs", "conv_id", words.alias("words"),
                       *[v.alias(k) for k, v in out.items()])


def _deeper(own: DataFrame) -> DataFrame | None:
    """(block, x1, x2, leaves, saved): totals of each block key over its own block and all blocks below it, by doubling."""
    most = own.agg(F.max("block")).first()[0] or 0
    if not most:
        return None
    sums = [F.sum("leaf").alias("leaves"), F.sum("own").alias("saved")]
    up = own.filter(F.col("d") == WIDTH).select((F.col("block") + 1).alias("block"), F.col("i1").alias("x1"), F.col("i2").alias("x2"),
                                                F.struct(*_KEY).alias("up"))
    tree = stored(own.filter("d > 0").groupBy(*_KEY).agg(*sums).join(up, _KEY, "left").select(F.struct(*_KEY).alias("key"), "up", "leaves", "saved"))
    for _ in range(int(most).bit_length()):
        more = tree.filter(F.col("up").isNotNull()).groupBy(F.col("up").alias("key")).agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        far = tree.select(F.col("key").alias("up"), F.col("up").alias("far"))
        tree = stored(tree.join(more, "key", "left").join(far, "up", "left").select(
            "key", F.col("far").alias("up"), (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved")))
    return tree.select("key.*", "leaves", "saved")


_CHUNK = "depth long, i1 long, i2 long, first long, ids string"
_ENDS = "depth long, i1 long, i2 long, ends_sha256 string"


def _chunks(batches):
    """The ids of a node that lie in one range, joined; rows come sorted by node and id."""
    for batch in batches:
        out, held, ids = [], None, []
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[:3] != held or len(ids) >= CHUNK_IDS:
                if ids:
                    out.append((*held, ids[0], ",".join(map(str, ids))))
                held, ids = row[:3], []
            ids.append(row[3])
        if ids:
            out.append((*held, ids[0], ",".join(map(str, ids))))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*out)], names=["depth", "i1", "i2", "first", "ids"])


def _digests(batches):
    held, state = None, None

    def done():
        return pa.RecordBatch.from_arrays([pa.array([v]) for v in (*held, state.hexdigest())], names=["depth", "i1", "i2", "ends_sha256"])

    for batch in batches:
        for depth, i1, i2, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if (depth, i1, i2) != held:
                if held is not None:
                    yield done()
                held, state = (depth, i1, i2), hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
    if held is not None:
        yield done()


def ends(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """(depth, i1, i2, ends_sha256): digest of the ids of the conversations that end in a node."""
    h1, h2 = _hashes(F.col("pos"), F.col("t"))
    last = rows.groupBy("conv").agg(F.max("pos").alias("depth"), F.bit_xor(h1).alias("i1"), F.bit_xor(h2).alias("i2"))
    zero = F.lit(0).cast("long")
    last = stored(convs.join(last, "conv", "left").select(*[F.coalesce(c, zero).alias(c) for c in ("depth", "i1", "i2")], "conv"))
    order = ["depth", "i1", "i2", "conv"]
    pieces = last.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_chunks, _CHUNK)
    return pieces.repartition("i1", "i2").sortWithinPartitions("depth", "i1", "i2", "first").mapInArrow(_digests, _ENDS)


def trie(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node of the trie over ``rows`` (conv, pos, t) and the members ``convs`` (conv)."""
    made = stored(nodes(blocks(rows, convs)))
    parent = [(F.col("depth") - 1).alias("depth"), F.col("p1").alias("i1"), F.col("p2").alias("i2")]
    children = made.filter("depth > 0").groupBy(*parent).agg(F.count(F.lit(1)).alias("n_children"))
    node = ["depth", "i1", "i2"]
    zero = F.lit(0).cast("long")
    own = stored(made.join(children, node, "left").withColumn("n_children", F.coalesce("n_children", zero)).withColumn(
        "leaf", (F.col("n_children") == 0).cast("long")).withColumn("own", (F.col("n_convs") - 1) * F.col("words")))
    below = _deeper(own)
    inside = own.select(*_KEY, *_T, "d", *node, "leaf", "own")
    if below is not None:
        below = below.select((F.col("block") * WIDTH).alias("depth"), F.col("x1").alias("i1"), F.col("x2").alias("i2"), "leaves", "saved")
        below = below.filter("depth > 0")
        inside = inside.join(below, node, "left").withColumn("leaf", F.col("leaf") + F.coalesce("leaves", zero)).withColumn(
            "own", F.col("own") + F.coalesce("saved", zero))
    sums = _rollup(inside.select(*_KEY, *_T, "leaf", "own"), "sum(leaf) AS n_leaves, sum(own) AS saved_tokens")
    same = F.lit(True)
    a, b = own.alias("a"), sums.alias("b")
    for c in (*_KEY, "d", *_T):
        same = same & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    out = a.join(b, same).select(*[f"a.{c}" for c in (*node, "p1", "p2", "conv_id", "n_convs", "n_children")], "n_leaves", "saved_tokens")
    above = made.select((F.col("depth") + 1).alias("depth"), F.col("i1").alias("p1"), F.col("i2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    out = out.join(above, ["depth", "p1", "p2"], "left").join(ends(rows, convs), node, "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))


def prefix_trie(convs: DataFrame, graft: bool = True, **columns) -> DataFrame:
    """The trie of all conversations of a table, rebuilt on shared first turns (``graft``) or as they are."""
    rows = turns(convs, **columns)
    if graft:
        rows, known = grafted(stored(rows))
    else:
        known = rows.select("conv").distinct()
    return trie(stored(rows), known)
