"""Near-duplicate detection with an LSH forest.

1. One pass over the texts: the distinct word shingles of each document, a MinHash signature, and a fingerprint of the
   whole set. Documents with equal sets become one class at once, so thousands of exact copies cost one row.
2. Each class is a leaf in ORDERS sorted signature orders (trees). The first DEPTH hashes of an order name a region. A
   region with more than REGION classes is divided by the next hashes of its order, and again until it fits: the depth adapts
   to each region, and the number of orders makes up for it.
3. In a region the leaves lie in signature order. Neighbours with a long common prefix are candidates, in windows of NEAR
   leaves; in a region wider than the window every leaf also meets the medoid of the region, and of the undivided one: the
   leaf that agrees best with the majority hash of every place (the original of a group of edited copies). Leaves whose neighbours are all but equal are
   linked to the next one only, so a group of n near copies gives a few times n candidates, never n squared.
4. Candidates with a plausible signature agreement are checked on their full shingle sets, in two rounds: first the pairs
   with a medoid and the next neighbours in narrow regions, then those of the others whose ends are still in different
   components. Links are joined to components by minimum labels with pointer jumping.
5. Dividing, windows and medoids only make links early; they decide nothing. In each region of first depth that they did not
   cover pair by pair, all pairs of leaves in different components are compared by sketch and by a fine sketch of BINS
   bytes, in tiles of TILE x TILE leaves. A tile names its leaves with a plausible partner; their full sets come to the tile,
   which checks the pairs, best first, and gives the links that join what it has not joined yet: fewer rows than leaves.

At the threshold of 0.75 a pair misses all 16 regions of two hashes with probability (1 - 0.75 ** 2) ** 16 < 2e-6; a sketch
refuses it with the chance of four standard errors, 3e-5.

Skew: equal sets are pre-aggregated; no task holds more than a divided region or a tile, whose blocks hold TILE leaves and ITEMS
shingles or one document; the joins are equi-joins that adaptive execution can split. The tiles of a family of k documents that
share much text and are no copies grow with k squared in time (not in memory or rows): that is the price of missing none of
its pairs. Nothing is collected to the driver but counts.

Edge cases: null, empty and blank texts have an empty set, link with nothing and are kept; a null id takes part in nothing
and is kept; repeated rows of an id are one document with the largest of its sets; other columns pass through unchanged."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from querywright.llm.storage import settle
from querywright.llm.words import mix, shingles, word_hashes

WIDTH = 5
SIMILAR = 75              # percent
ORDERS = 16
DEPTH = 2                 # hashes that name a region at first
PLACES = 64               # hashes per signature
DEPTHS = (DEPTH, 3, 4, 6, 8, 12, 16, 32, PLACES)
REGION = 8192             # classes a region may hold
NEAR = 8                  # leaves a leaf looks ahead
PLAUSIBLE = 0.53          # estimated similarity of a candidate: the threshold less four standard errors
CERTAIN = 0.92            # neighbours of this estimate need no further partners in their window
CHUNK = 1 << 13
TILE = 2048               # leaves in a block of a wide region
ITEMS = 1 << 21           # shingles in such a block
BINS = 512                # bytes of a fine sketch
BROADCAST_IDS = 500_000   # documents in question that are sent to the scan; more meet the texts in a join

_rng = np.random.default_rng(7)
_FACTORS = _rng.integers(1, 1 << 63, PLACES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _rng.integers(0, 1 << 63, PLACES, dtype=np.uint64)
# order k starts with places 2k and 2k + 1 (mod PLACES), then takes the others in a shuffled order of its own
_LEAD = [[(DEPTH * k + d) % PLACES for d in range(DEPTH)] for k in range(ORDERS)]
PERMUTED = np.array([[*lead, *(p for p in _rng.permutation(PLACES).tolist() if p not in lead)] for lead in _LEAD])

FEATURES = "struct<n long, sum long, fold long, sketch binary, heads array<long>>"
_FEATURES = pa.struct([("n", pa.int64()), ("sum", pa.int64()), ("fold", pa.int64()), ("sketch", pa.binary()),
                       ("heads", pa.list_(pa.int64()))])


def signature(items: np.ndarray) -> np.ndarray:
    """The minima of PLACES hash functions over a non-empty set."""
    low = np.full(PLACES, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(items), CHUNK):
        part = items[start:start + CHUNK]
        np.minimum(low, (part[None, :] * _FACTORS[:, None] + _SHIFTS[:, None]).min(axis=1), out=low)
    return low


def shingle_sets(texts: list, width: int) -> list[np.ndarray]:
    return [shingles(w, width) for w in word_hashes([(t or "").encode() for t in texts], lower=True)]


def _features(width: int):
    def run(texts: pa.Array) -> pa.Array:
        out = []
        for start in range(0, len(texts), 256):
            for items in shingle_sets(texts.slice(start, 256).to_pylist(), width):
                if not len(items):
                    out.append((0, 0, 0, None, None))
                    continue
                low = mix(signature(items))
                heads = mix(low[PERMUTED[:, 0]] * np.uint64(3) + low[PERMUTED[:, 1]]).view(np.int64)
                out.append((len(items), int(items.sum().view(np.int64)),
                            int(np.bitwise_xor.reduce(mix(items)).view(np.int64)),
                            (low & np.uint64(255)).astype(np.uint8).tobytes(), heads.tolist()))
        columns = list(zip(*out)) or [()] * 5
        return pa.StructArray.from_arrays([pa.array(list(c), t.type) for c, t in zip(columns, _FEATURES)],
                                          fields=list(_FEATURES))

    return F.arrow_udf(run, FEATURES).asNondeterministic()  # evaluated once, whatever stands above it


def features(docs: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """(doc_id, n, sum, fold, sketch, heads): size and fingerprint of each shingle set, one byte of every signature place,
    and the names of the regions at first depth."""
    return docs.select(F.col(id_col).alias("doc_id"), _features(width)(F.col(text)).alias("f")).select("doc_id", "f.*")


def forest(classes: DataFrame) -> DataFrame:
    """(region, label, id): the leaves of all orders in their regions of first depth. ``label`` is the sketch in the order's
    sequence. The orders of a class are made in one place, so a class is stored once per order and no more."""
    def run(batches):
        for batch in batches:
            ids = batch["id"].to_numpy(zero_copy_only=False)
            heads = np.array(batch["heads"].to_pylist(), np.int64).reshape(-1, ORDERS)
            sketch = np.frombuffer(b"".join(batch["sketch"].to_pylist()), np.uint8).reshape(-1, PLACES)
            for k in range(ORDERS):
                labels = sketch[:, PERMUTED[k]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(mix(heads[:, k].view(np.uint64) + np.uint64(k)).view(np.int64)),
                     pa.array([x.tobytes() for x in labels], pa.binary()), pa.array(ids, pa.int64())],
                    names=["region", "label", "id"])

    # the classes are stored; their leaves follow from them and are cheaper to make again than to keep
    return classes.select("id", "sketch", "heads").mapInArrow(run, "region long, label binary, id long")


def leaves(classes: DataFrame, region: int = REGION) -> DataFrame:
    """The leaves of all orders, in regions of bounded size. What a border parts is left to ``hubs`` and ``remainder``."""
    rows = forest(classes)
    for depth, deeper in zip(DEPTHS, DEPTHS[1:]):
        wide = rows.groupBy("region").count().filter(F.col("count") > region).select("region", F.lit(True).alias("wide"))
        wide = settle(wide)
        if wide.isEmpty():
            return rows
        # the next hashes of the order divide what is too wide
        rows = settle(rows.join(wide, "region", "left").select(
            F.when(F.col("wide"), F.xxhash64("region", F.substring("label", depth + 1, deeper - depth)))
            .otherwise(F.col("region")).alias("region"), "label", "id"))
    # leaves with one label throughout are divided by number
    hold = Window.partitionBy("region").orderBy("id")
    return rows.withColumn("region", F.xxhash64("region", F.floor(F.row_number().over(hold) / region)))


def _agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated similarity of two blocks of sketches; one byte agrees by chance in one of 256 places."""
    return ((a == b).mean(axis=-1) - 1 / 256) * (256 / 255)


def region_pairs(labels: np.ndarray, ids: np.ndarray, region: np.ndarray, near: int = NEAR) -> tuple[np.ndarray, ...]:
    """Candidates (a, b, turn) among whole regions whose leaves lie in label order; turn 0 is checked first."""
    left, right, turn = [], [], []
    n = len(ids)
    edges = np.flatnonzero(np.append(True, region[1:] != region[:-1])) if n else np.zeros(0, int)
    ends = np.append(edges[1:], n)[:len(edges)]
    wide = ends - edges > near + 1
    in_wide = np.repeat(wide, ends - edges)
    linked = np.ones(n, bool)                   # a chain of all but equal leaves links both ends already
    for ahead in range(1, min(near, n - 1) + 1):
        same = region[ahead:] == region[:-ahead]
        likeness = np.where(same, _agreement(labels[ahead:], labels[:-ahead]), 0)
        ask = likeness >= PLAUSIBLE
        if ahead == 1:
            chained = likeness >= CERTAIN
        linked = linked[:n - ahead] & chained[ahead - 1:]
        at = np.flatnonzero(ask if ahead == 1 else ask & ~linked)
        left.append(ids[at])
        right.append(ids[at + ahead])
        turn.append(np.where(in_wide[at], 1, min(ahead - 1, 1)))
    for start, stop in zip(edges[wide], ends[wide]):
        block = labels[start:stop]
        votes = np.bincount((block + np.arange(PLACES) * 256).ravel(), minlength=256 * PLACES).reshape(PLACES, 256)
        medoid = int((block == votes.argmax(axis=1)).sum(axis=1).argmax())
        at = np.flatnonzero(_agreement(block, block[medoid]) >= PLAUSIBLE)
        at = at[at != medoid]
        left.append(ids[start + at])
        right.append(np.full(len(at), ids[start + medoid]))
        turn.append(np.zeros(len(at), np.int64))
    a = np.concatenate(left) if left else ids[:0]
    b = np.concatenate(right) if right else ids[:0]
    return np.minimum(a, b), np.maximum(a, b), np.concatenate(turn) if turn else ids[:0]


def candidates(rows: DataFrame, near: int = NEAR) -> DataFrame:
    """(a, b, turn): distinct candidate pairs of classes, a < b."""
    def run(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            region = held["region"].to_numpy()
            cut = int(np.searchsorted(region == region[-1], True)) if len(region) else 0  # the last region may go on
            if cut:
                yield from _pairs(held.slice(0, cut), near)
                held = held.slice(cut).combine_chunks()
        if held is not None and held.num_rows:
            yield from _pairs(held, near)

    ordered = rows.repartition("region").sortWithinPartitions("region", "label", "id")
    return ordered.mapInArrow(run, "a long, b long, turn long").groupBy("a", "b").agg(F.min("turn").alias("turn"))


def _pairs(table: pa.Table, near: int):
    labels = np.frombuffer(b"".join(table["label"].to_pylist()), np.uint8).reshape(-1, PLACES)
    found = region_pairs(labels, table["id"].to_numpy(), table["region"].to_numpy(), near)
    yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in found], names=["a", "b", "turn"])


def wide_regions(classes: DataFrame, near: int = NEAR) -> DataFrame:
    """(region, n): the regions of first depth in which not every pair of leaves is a candidate."""
    return forest(classes).groupBy("region").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > near + 1)


def _likeness(a: pa.Array, b: pa.Array) -> pa.Array:
    x, y = (np.frombuffer(b"".join(v.to_pylist()), np.uint8).reshape(-1, PLACES) for v in (a, b))
    return pa.array(_agreement(x, y), pa.float64())


def hubs(rows: DataFrame, wide: DataFrame, region: int = REGION) -> DataFrame | None:
    """(a, b, turn): every leaf of an undivided region above ``region`` leaves with the region's medoid. The majority is taken
    over an even part of the leaves, the medoid over all of them."""
    big = settle(wide.filter(F.col("n") > region))
    if big.isEmpty():
        return None

    def majority(table: pa.Table) -> pa.Table:
        block = np.frombuffer(b"".join(table["label"].to_pylist()), np.uint8).reshape(-1, PLACES)
        votes = np.bincount((block + np.arange(PLACES) * 256).ravel(), minlength=256 * PLACES).reshape(PLACES, 256)
        return pa.table({"region": table["region"][:1], "most": pa.array([votes.argmax(axis=1).astype(np.uint8).tobytes()])})

    likeness = F.arrow_udf(_likeness, "double")
    held = settle(rows.join(big, "region"))
    part = held.filter(F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / region)) == 0).select("region", "label")
    most = settle(part.groupBy("region").applyInArrow(majority, "region long, most binary"))
    medoids = settle(held.join(most, "region").select("region", "id", "label", likeness("label", "most").alias("like"))
                     .groupBy("region").agg(F.max(F.struct("like", "id", "label")).alias("m"))
                     .select("region", F.col("m.id").alias("hub"), F.col("m.label").alias("most")))
    return (held.join(medoids, "region").filter(F.col("id") != F.col("hub"))
            .select("id", "hub", likeness("label", "most").alias("like")).filter(F.col("like") >= PLAUSIBLE)
            .select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b"), F.lit(0).cast("long").alias("turn")).distinct())


def fine_sketch(items: np.ndarray) -> bytes:
    """One byte for the least hash in each of BINS parts of the hash range; zero for a part without any."""
    hashes = np.sort(mix(items))
    parts, first = np.unique(hashes >> np.uint64(64 - BINS.bit_length() + 1), return_index=True)
    out = np.zeros(BINS, np.uint8)
    out[parts.astype(np.int64)] = (hashes[first] % np.uint64(255) + np.uint64(1)).astype(np.uint8)
    return out.tobytes()


def fine_sketches(docs: DataFrame, asked: DataFrame, id_col: str, text: str, width: int) -> DataFrame:
    """(id, size, fine) of the asked ids."""
    def run(texts: pa.Array) -> pa.Array:
        n, fine = [], []
        for start in range(0, len(texts), 256):
            sets = shingle_sets(texts.slice(start, 256).to_pylist(), width)
            n += [len(s) for s in sets]
            fine += [fine_sketch(s) for s in sets]
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(fine, pa.binary())], names=["n", "fine"])

    asked = F.broadcast(asked) if asked.count() <= BROADCAST_IDS else asked
    found = docs.select(F.col(id_col).alias("id"), F.col(text).alias("_text")).join(asked, "id", "left_semi")
    made = found.select("id", F.arrow_udf(run, "struct<n long, fine binary>").asNondeterministic()("_text").alias("f"))
    return made.groupBy("id").agg(F.max("f").alias("f")).select("id", F.col("f.n").alias("size"), "f.fine")


class Block(NamedTuple):
    """Leaves of one region, row by row."""

    label: np.ndarray
    fine: np.ndarray
    component: np.ndarray
    size: np.ndarray
    heads: np.ndarray

    def at(self, rows) -> Block:
        return Block(*(v[rows] for v in self))


LEAF = "id long, label binary, fine binary, component long, size long, heads array<long>"


def block_of(table: pa.Table) -> tuple[Block, int]:
    """The leaves of a table and the number of their order, which the name of their region tells."""
    heads = table["heads"].combine_chunks().flatten().to_numpy().reshape(-1, ORDERS)
    names = mix(heads[0].view(np.uint64) + np.arange(ORDERS, dtype=np.uint64)).view(np.int64)
    order = int(np.flatnonzero(names == table["region"][0].as_py())[0])
    return Block(np.frombuffer(b"".join(table["label"].to_pylist()), np.uint8).reshape(-1, PLACES),
                 np.frombuffer(b"".join(table["fine"].to_pylist()), np.uint8).reshape(-1, BINS),
                 table["component"].to_numpy(), table["size"].to_numpy(), heads), order


def tile_pairs(left: Block, right: Block | None, order: int = 0, similar: int = SIMILAR) -> tuple[np.ndarray, ...]:
    """Rows x of one block and y of another (or of the same: ``right`` is None), and the estimated similarity, of all pairs of different
    components with plausible sketches. A pair that shares a region of an earlier order meets there."""
    one = right is None
    right = left if one else right
    share, out = similar / 100, []
    step = max(1, (1 << 23) // (PLACES * max(len(right.size), 1)))
    for start in range(0, len(left.size), step):
        stop = min(start + step, len(left.size))
        ask = _agreement(left.label[start:stop, None], right.label[None]) >= PLAUSIBLE
        ask &= left.component[start:stop, None] != right.component[None]
        if one:
            ask &= np.arange(len(right.size))[None] > np.arange(start, stop)[:, None]
        i, j = np.nonzero(ask)
        i += start
        for at in range(0, len(i), CHUNK):
            x, y = i[at:at + CHUNK], j[at:at + CHUNK]
            first = ~(left.heads[x, :order] == right.heads[y, :order]).any(axis=1)
            x, y = x[first], y[first]
            f, g = left.fine[x], right.fine[y]
            used = np.maximum(((f > 0) | (g > 0)).sum(axis=1), 1)
            same = ((f == g) & (f > 0)).sum(axis=1) / used
            # the used parts are a draw without replacement from the union, which has at most so many shingles in a pair
            # that is similar enough: a sketch of most of the union hardly errs
            n, m = left.size[x], right.size[y]
            union = np.maximum((n + m) / (1 + share), 2)
            spread = share * (1 - share) / used * np.maximum(union - used, 0) / (union - 1)
            good = (same >= share - 4 * np.sqrt(spread) - 1e-9) & (np.minimum(n, m) >= share * np.maximum(n, m))
            out.append((x[good], y[good], same[good]))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(c) for c in zip(*out))


def joining_links(x: np.ndarray, y: np.ndarray, component: np.ndarray, items: np.ndarray, first: np.ndarray,
                  similar: int = SIMILAR) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of components that similar pairs among (x[k], y[k]) join, checked on their full sets in the given order; a pair whose ends
    are joined already is not checked. Set i is items[first[i]:first[i + 1]]."""
    names, number = np.unique(component, return_inverse=True)
    top, size, items, out = np.arange(len(names)), np.diff(first), numbered(items), []
    at, step = 0, CHUNK
    while at < len(x):
        i, j = x[at:at + step], y[at:at + step]
        at, step = at + step, min(2 * step, 1 << 20)
        apart = top[number[i]] != top[number[j]]
        i, j = i[apart], j[apart]
        common = common_counts(i, j, items, first)
        linked = np.flatnonzero(100 * common >= similar * (size[i] + size[j] - common))
        for a, b in zip(number[i[linked]].tolist(), number[j[linked]].tolist()):
            if top[a] != top[b]:
                top[top == top[b]] = top[a]
                out.append((names[a], names[b]))
    a, b = np.array(out, np.int64).reshape(-1, 2).T
    return np.minimum(a, b), np.maximum(a, b)


def remainder(docs: DataFrame, rows: DataFrame, wide: DataFrame, named: DataFrame, id_col: str, text: str, width: int,
              similar: int, tile: int | None = None, load: int | None = None) -> DataFrame | None:
    """(ca, cb): the components joined by links of wide regions that windows and medoids left out: all pairs of leaves of one region
    of first depth that lie in different components so far (``named``: id, n, heads, component). A region is dealt into blocks and
    every two blocks meet in a task; blocks of one large component do not meet each other, and a region with one component is done."""
    tile, load = tile or TILE, load or ITEMS
    held = settle(rows.join(wide.select("region"), "region", "left_semi").join(named, "id"))
    counts = settle(held.groupBy("region", "component").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("load")))
    mixed = counts.groupBy("region").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("region")
    group = F.when(F.col("c") > tile, F.col("component").cast("string")).otherwise("")
    counts = settle(counts.join(mixed, "region").withColumn("group", group))
    if counts.isEmpty():
        return None
    parts = counts.groupBy("region", "group").agg(F.greatest(F.ceil(F.sum("c") / tile), F.ceil(F.sum("load") / load)).cast("int").alias("parts"))
    held = settle(held.join(counts.select("region", "component", "group"), ["region", "component"]).join(parts, ["region", "group"])
                  .select("region", F.struct("group", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part")).alias("block"),
                          "id", "label", "component", "heads"))
    blocks = parts.select("region", F.explode(F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1), lambda n: F.struct(F.col("group"), n.alias("part")))).alias("x"))
    meet = blocks.join(blocks.withColumnRenamed("x", "y"), "region").filter(
        (F.col("x") <= F.col("y")) & ((F.col("x.group") != F.col("y.group")) | (F.col("x.group") == "")))
    sides = (meet.select("region", "x", "y", F.col("x").alias("block"), F.lit(0).alias("side"))
             .unionByName(meet.filter("x <> y").select("region", "x", "y", F.col("y").alias("block"), F.lit(1).alias("side"))))
    fine = fine_sketches(docs, settle(held.select("id").distinct()), id_col, text, width)

    def pairs(table: pa.Table):
        block, order = block_of(table)
        left, right = (np.flatnonzero(table["side"].to_numpy() == k) for k in (0, 1))
        paired = table["paired"][0].as_py()
        x, y, same = tile_pairs(block.at(left), block.at(right) if paired else None, order, similar)
        return left[x], (right if paired else left)[y], same

    def ask(table: pa.Table) -> pa.Table:
        x, y, _ = pairs(table)
        return table.take(pa.array(np.unique(np.append(x, y)))).select(columns)

    def check(table: pa.Table) -> pa.Table:
        x, y, same = pairs(table)
        best = np.argsort(-same, kind="stable")
        lists = table["items"].combine_chunks()
        items, first = lists.flatten().to_numpy(), np.append(0, np.cumsum(lists.value_lengths().to_numpy()))
        found = joining_links(x[best], y[best], table["component"].to_numpy(), items, first, similar)
        return pa.table([pa.array(v, pa.int64()) for v in found], names=["ca", "cb"])

    columns = ["region", "tile", "side", "paired", "id", "label", "fine", "component", "size", "heads"]
    met = held.join(fine, "id").join(sides, ["region", "block"]).select(
        "region", F.xxhash64("x", "y").alias("tile"), "side", (F.col("x") != F.col("y")).alias("paired"), *columns[4:])
    asked = settle(met.groupBy("region", "tile").applyInArrow(ask, f"region long, tile long, side int, paired boolean, {LEAF}"))
    sets = full_sets(docs, settle(asked.select(F.col("id").alias("_id")).distinct()), id_col, text, width)
    whole = asked.join(sets.withColumnRenamed("_id", "id"), "id").select(*columns, "items")
    return whole.groupBy("region", "tile").applyInArrow(check, "ca long, cb long").distinct()


def full_sets(docs: DataFrame, asked: DataFrame, id_col: str, text: str, width: int) -> DataFrame:
    """(_id, items): the shingle sets of the asked ``_id``."""
    def run(texts: pa.Array) -> pa.Array:
        out = []
        for start in range(0, len(texts), 256):
            out += [s.view(np.int64) for s in shingle_sets(texts.slice(start, 256).to_pylist(), width)]
        return pa.array(out, pa.list_(pa.int64()))

    asked = F.broadcast(asked) if asked.count() <= BROADCAST_IDS else asked
    found = docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_text")).join(asked, "_id", "left_semi")
    sets = found.select("_id", F.arrow_udf(run, "array<long>").asNondeterministic()("_text").alias("items"))
    return sets.groupBy("_id").agg(F.max_by("items", F.struct(F.size("items"), "items")).alias("items"))


def links(docs: DataFrame, pairs: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = WIDTH,
          similar: int = SIMILAR) -> DataFrame:
    """The pairs whose full shingle sets are similar enough. Sets are made again for the documents in question only."""
    asked = settle(pairs.select(F.explode(F.array("a", "b")).alias("_id")).distinct())
    n_asked = asked.count()
    sets = full_sets(docs, asked, id_col, text, width)
    blocks = -(-n_asked // TILE)
    if pairs.count() > n_asked * (blocks + 1):   # a set travels once per pair of blocks instead of once per pair
        return _links_by_block(pairs, sets, blocks, similar)
    both = (pairs.join(sets.select(F.col("_id").alias("a"), F.col("items").alias("x")), "a")
            .join(sets.select(F.col("_id").alias("b"), F.col("items").alias("y")), "b"))
    common = F.size(F.array_intersect("x", "y"))
    union = F.size("x") + F.size("y") - common
    return both.filter(100 * common >= similar * union).select(*pairs.columns)


def numbered(items: np.ndarray) -> np.ndarray:
    return np.unique(items, return_inverse=True)[1]


def common_counts(left: np.ndarray, right: np.ndarray, number: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets left[k] and right[k]; set i is number[first[i]:first[i + 1]], never empty, its items
    ``numbered``. The partners of one set are counted together."""
    mark, out = np.zeros(int(number.max(initial=-1)) + 1, np.int64), np.empty(len(left), np.int64)
    order = np.argsort(left, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(left[order])) + 1):
        for at in range(0, len(rows), 1024):
            part = rows[at:at + 1024]
            own = number[first[left[part[0]]]:first[left[part[0]] + 1]]
            size = first[right[part] + 1] - first[right[part]]
            begin = np.cumsum(size) - size
            mark[own] = 1
            out[part] = np.add.reduceat(mark[number[np.arange(size.sum()) + np.repeat(first[right[part]] - begin, size)]], begin)
            mark[own] = 0
    return out


def _links_by_block(pairs: DataFrame, sets: DataFrame, blocks: int, similar: int) -> DataFrame:
    """``links`` where pairs are many times the documents: ids are dealt into blocks, and the sets of two blocks meet their pairs."""
    block = lambda c: F.pmod(F.xxhash64(c), F.lit(blocks))
    placed = pairs.withColumn("x", F.least(block("a"), block("b"))).withColumn("y", F.greatest(block("a"), block("b")))
    tiles = placed.select("x", "y").distinct()
    sides = tiles.select("x", "y", F.explode(F.array_distinct(F.array("x", "y"))).alias("block"))
    held = sets.withColumn("block", block("_id")).join(sides, "block").select(
        F.col("x").alias("hx"), F.col("y").alias("hy"), "_id", "items")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        wanted = left.select(names)
        if not left.num_rows or not right.num_rows:
            return wanted.slice(0, 0)
        order = np.argsort(right["_id"].to_numpy())
        ids = right["_id"].to_numpy()[order]
        lists = right["items"].combine_chunks().take(pa.array(order))
        items, first = lists.flatten().to_numpy(), np.append(0, np.cumsum(lists.value_lengths().to_numpy()))
        x, y = (np.searchsorted(ids, left[c].to_numpy()) for c in ("a", "b"))
        common = common_counts(x, y, numbered(items), first)
        size = np.diff(first)
        return wanted.filter(pa.array(100 * common >= similar * (size[x] + size[y] - common)))

    names = pairs.columns
    return placed.groupBy("x", "y").cogroup(held.groupBy("hx", "hy")).applyInArrow(run, pairs.schema)


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable, for every id in a link. Labels take the minimum of their neighbours and
    then of their label's label, so long chains shrink by halves; a step is one written table."""
    arcs = settle(edges.select(F.inline(F.array(F.struct(F.col("a").alias("a"), F.col("b").alias("b")), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))))
    step = settle(arcs.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("id"), F.col("a").alias("label"), F.least("a", "m").alias("next")))
    while not step.filter("label <> next").isEmpty():
        labels = step.select("id", F.col("next").alias("label"))
        near = arcs.join(labels.select(F.col("id").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("m"))
        far = labels.select(F.col("id").alias("next"), F.col("label").alias("far"))
        step = settle(labels.join(near.withColumnRenamed("a", "id"), "id").select("id", "label", F.least("label", "m").alias("next"))
                      .join(far, "next").select("id", "label", F.least("next", "far").alias("next")))
    return step.select("id", F.col("label").alias("component"))


def joined(docs: DataFrame, pairs: DataFrame, reach: DataFrame | None, id_col: str, text: str, width: int,
           similar: int) -> DataFrame | None:
    """(id, component) after the candidate ``pairs`` are checked: the table so far, brought up to date. A pair whose ends are in one
    component already is not checked, and new links join components, not documents, so each round works on what is new."""
    if reach is None:
        asked = pairs.select("a", "b", F.col("a").alias("ca"), F.col("b").alias("cb"))
    else:
        of = lambda end: reach.select(F.col("id").alias(end), F.col("component").alias(f"c{end}"))
        asked = (pairs.select("a", "b").join(of("a"), "a", "left").join(of("b"), "b", "left")
                 .select("a", "b", F.coalesce("ca", "a").alias("ca"), F.coalesce("cb", "b").alias("cb")).filter("ca <> cb"))
    asked = settle(asked)
    if asked.isEmpty():
        return reach
    return united(links(docs, asked, id_col, text, width, similar), reach)


def united(found: DataFrame, reach: DataFrame | None) -> DataFrame:
    """(id, component) after the links ``found`` between the components ca and cb."""
    new = components(found.select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).distinct())
    if reach is None:
        return new
    moved = reach.join(new.select(F.col("id").alias("component"), F.col("component").alias("to")), "component", "left")
    single = new.join(reach.select("id"), "id", "left_anti")
    return settle(moved.select("id", F.coalesce("to", "component").alias("component")).unionByName(single))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = WIDTH,
                    similar: int = SIMILAR) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per document; rows without an id have no component and are kept."""
    made = settle(features(docs, id_col, text, width))
    known = made.filter(F.col("doc_id").isNotNull())
    single = known.groupBy("doc_id").agg(F.max(F.struct("n", "sum", "fold", "sketch", "heads")).alias("f")).select("doc_id", "f.*")
    full = single.filter("n > 0")
    classes = settle(full.groupBy("n", "sum", "fold").agg(
        F.min("doc_id").alias("id"), F.first("sketch").alias("sketch"), F.first("heads").alias("heads")))
    rules = (id_col, text, width, similar)
    wide = settle(wide_regions(classes))
    pairs = candidates(leaves(classes))
    more = hubs(forest(classes), wide)
    if more is not None:
        pairs = pairs.unionByName(more).groupBy("a", "b").agg(F.min("turn").alias("turn"))
    pairs, reach = settle(pairs), None
    for turn in (0, 1):
        reach = joined(docs, pairs.filter(F.col("turn") == turn), reach, *rules)
    so_far = classes.select("id", "n", "heads", F.col("id").alias("component")) if reach is None else classes.join(
        reach, "id", "left").select("id", "n", "heads", F.coalesce("component", "id").alias("component"))
    rest = remainder(docs, forest(classes), wide, so_far, *rules)
    if rest is not None:
        reach = united(settle(rest), reach)
    if reach is None:
        reach = classes.select("id", F.col("id").alias("component")).limit(0)
    named = (classes.select("n", "sum", "fold", "id").join(reach, "id", "left")
             .select("n", "sum", "fold", F.coalesce("component", "id").alias("component")))
    out = (full.select("doc_id", "n", "sum", "fold").join(named, ["n", "sum", "fold"])
           .select("doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id")))
    empty = single.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    nameless = made.filter(F.col("doc_id").isNull()).select(
        "doc_id", F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"))
    return out.unionByName(empty).unionByName(nameless).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text", **rules) -> DataFrame:
    """The rows of ``docs`` whose document stays, columns unchanged."""
    gone = settle(near_duplicates(docs, id_col, text, **rules).filter("NOT kept").select(F.col("doc_id").alias(id_col)))
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone   # the texts stay where they are
    return docs.join(gone, id_col, "left_anti").select(*docs.columns)
