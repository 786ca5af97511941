"""Sharding by balanced label propagation, under the law ``rows``: shard sizes differ by one row at most.

Links join documents of equal text. Every document starts in the shard its id hashes to. In each round a linked document
looks at how many of its neighbours each shard holds and asks to move to the fullest one that still has room, unless its own
holds more; movers are admitted in the order of their gain until the shard's quota is used up. A group too
large for a shard fills it and goes on to the next. At the end the shards are levelled: the surplus of the fuller ones,
singles first, takes the free places of the others one for one.

Neighbours are counted per group and shard, never as pairs, so a group of a third of all rows costs one row per shard and
task. Quotas are met by counts of movers per (shard, gain, hash bucket), a table of at most shards * 64 * BUCKETS rows;
ranks inside a shard come from counts per hash bucket and a rank inside the bucket, so no task sees a whole shard.

Edge cases: a null text has size 1 and equals other null texts and empty ones; null ids are dealt by their text and a
number; repeated rows are linked like copies; an empty table gives an empty result. Other columns are not read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from querywright.llm.storage import settle

SHARDS = 16
ROUNDS = 8               # a group fills about one shard a round; rounds without a move end the loop
BUCKETS = 64              # hash buckets that quotas are cut by
RANK_ROWS = 20_000        # rows per bucket of the ranking
LOAD_BOUND = 1 << 16      # most shards; their loads are the only thing the driver sees


def _nodes(docs: DataFrame, id_col: str, text: str, shards: int) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(body) + 1).cast("long").alias("size"),
                       F.crc32(body.cast("binary")).alias("text_crc32"), F.unhex(F.md5(body.cast("binary"))).alias("grp"))
    # a number for rows that nothing else tells apart; rows are written before it is used
    rows = rows.withColumn("node", F.monotonically_increasing_id())
    spread = F.xxhash64(F.coalesce(F.col("doc_id"), F.col("node")), "text_crc32")
    return rows.withColumn("h", spread).withColumn("shard", F.pmod("h", F.lit(shards)).cast("int"))


def _loads(nodes: DataFrame, shards: int) -> list[int]:
    held = {r["shard"]: r["count"] for r in nodes.groupBy("shard").count().collect()}  # one row per shard
    return [held.get(s, 0) for s in range(shards)]


def _at(values: list, index: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), index + 1)


def _bucket() -> Column:
    return F.pmod(F.shiftright("h", 20), F.lit(BUCKETS)).cast("int")


def quotas(total: int, shards: int) -> list[int]:
    return [total // shards + (s < total % shards) for s in range(shards)]


def propagate(linked: DataFrame, loads: list[int], quota: list[int]) -> tuple[DataFrame, list[int]]:
    """One round over the linked documents; (their new shards, their new loads). Singles cut no link wherever they are, so
    they make way at the end and only linked documents count against a quota here."""
    room = [max(q - n, 0) for q, n in zip(quota, loads)]
    counts = linked.groupBy("grp", "shard").agg(F.count(F.lit(1)).alias("n"))
    open_here = F.when(_at(room, F.col("shard")) > 0, F.struct("n", (-F.col("shard")).alias("s")))
    best = counts.groupBy("grp").agg(F.max(open_here).alias("best"))
    view = counts.join(best, "grp").select(
        "grp", "shard", (-F.col("best.s")).alias("target"), (F.col("best.n") - F.col("n")).alias("gain"))
    # documents of one group and shard share target and gain
    asks = view.filter("target <> shard AND gain >= 0").select(
        "grp", "shard", "target", F.least(F.floor(F.log2(F.col("gain") + 1)), F.lit(63)).cast("int").alias("gain"))
    movers = linked.join(asks, ["grp", "shard"], "left").withColumn("bucket", _bucket())
    table = movers.filter("target IS NOT NULL").groupBy("target", "gain", "bucket").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("target").orderBy(F.desc("gain"), "bucket")
    admitted = (table.withColumn("upto", F.sum("n").over(order)).filter(F.col("upto") <= _at(room, F.col("target")))
                .select("target", "gain", "bucket", F.lit(True).alias("moves")))
    moved = settle(movers.join(F.broadcast(admitted), ["target", "gain", "bucket"], "left").select(
        *[c for c in linked.columns if c != "shard"], "shard",
        F.when(F.col("moves"), F.col("target")).otherwise(F.col("shard")).alias("to")))
    flow = moved.filter("`to` <> shard").groupBy("shard", "to").count().collect()  # at most shards * shards rows
    loads = list(loads)
    for r in flow:
        loads[r["shard"]] -= r["count"]
        loads[r["to"]] += r["count"]
    return moved.drop("shard").withColumnRenamed("to", "shard"), loads


def ranked(nodes: DataFrame, buckets: int) -> DataFrame:
    """Add ``rank``: gapless from 0 in each shard, linked documents before singles."""
    bucket = F.pmod(F.shiftright("h", 8), F.lit(buckets)).cast("int")
    rows = nodes.withColumn("b", bucket)
    sizes = rows.groupBy("shard", "single", "b").count()
    before = Window.partitionBy("shard").orderBy("single", "b").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("shard", "single", "b", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("shard", "single", "b").orderBy("h", "doc_id", "node")
    return (rows.withColumn("r", F.row_number().over(inside) - 1).join(sizes, ["shard", "single", "b"])
            .withColumn("rank", (F.col("first") + F.col("r")).cast("long")).drop("b", "r", "first"))


def level(nodes: DataFrame, loads: list[int], shards: int) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) with shard sizes at most one apart."""
    total = sum(loads)
    quota = quotas(total, shards)
    surplus_before, n_surplus = [], 0
    free, starts, first_slots, n_free = [], [], [], 0
    for s in range(shards):
        surplus_before.append(n_surplus)
        n_surplus += max(loads[s] - quota[s], 0)
        if quota[s] > loads[s]:
            free.append(s)
            starts.append(n_free)
            first_slots.append(loads[s])
            n_free += quota[s] - loads[s]
    rows = ranked(nodes, max(1, -(-total // (shards * RANK_ROWS))))
    over = F.col("rank") - _at(quota, F.col("shard"))
    rows = rows.withColumn("turn", F.when(over >= 0, over + _at(surplus_before, F.col("shard"))))
    if not free:
        return rows.select("doc_id", "size", "text_crc32", "shard", F.col("rank").alias("slot"))
    # the turn of a surplus row names the free place it takes
    here = F.size(F.filter(F.array(*map(F.lit, starts)), lambda s: s <= F.col("turn"))) - 1
    moves = F.col("turn").isNotNull()
    return rows.withColumn("here", F.when(moves, here)).select(
        "doc_id", "size", "text_crc32",
        F.when(moves, _at(free, F.col("here"))).otherwise(F.col("shard")).cast("int").alias("shard"),
        F.when(moves, F.col("turn") - _at(starts, F.col("here")) + _at(first_slots, F.col("here")))
        .otherwise(F.col("rank")).cast("long").alias("slot"))


def shard_rows(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shards: int = SHARDS,
               rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot)."""
    if not 0 < shards <= LOAD_BOUND:
        raise ValueError(f"shards must be between 1 and {LOAD_BOUND}")
    nodes = settle(_nodes(docs, id_col, text, shards))
    groups = nodes.groupBy("grp").agg((F.count(F.lit(1)) == 1).alias("single"))
    nodes = settle(nodes.join(groups, "grp"))
    linked, singles = nodes.filter("NOT single"), nodes.filter("single")
    loads, rest = _loads(linked, shards), _loads(singles, shards)
    quota = quotas(sum(loads) + sum(rest), shards)
    for _ in range(rounds):
        before = loads
        linked, loads = propagate(linked, loads, quota)
        if loads == before:
            break
    return level(linked.unionByName(singles), [a + b for a, b in zip(loads, rest)], shards)


def cut_links(placed: DataFrame) -> DataFrame:
    """(linked, cut): of (grp, shard) rows, the links of a chain through each group and those that a shard border cuts,
    when each shard's members are chained first."""
    per = placed.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("shard").alias("k"))
    return per.agg(F.sum(F.col("n") - 1).alias("linked"), F.sum(F.col("k") - 1).alias("cut"))
