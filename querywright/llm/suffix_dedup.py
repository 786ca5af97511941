"""Removal of repeated passages with a sorted array of suffixes.

A byte goes when a string of SPAN bytes covers it that also starts elsewhere, in any document.

1. Sparse suffixes. Each window of SPAN bytes names one suffix that starts inside it: of the places 1 to WINDOW - 1 bytes
   after its start, the one whose leading GRAM bytes have the least hash; places where a token begins go before all others.
   The choice depends on the bytes of the window alone, so equal windows name the suffix at the same offset. Consecutive
   windows mostly name the same suffix: one row (start, n, at) stands for some 150 windows.
2. Leading tokens. All windows of a suffix share its first SPAN - WINDOW + 1 bytes, the core. Cores that occur once cannot
   belong to a repeated window and are dropped after a count of hashes. A context is all bytes of a row's windows; contexts
   with equal bytes (128 bits of hashes) are repeats of each other without further work, so exact copies collapse to one
   representative before any bytes move.
3. What is left, different contexts with one core, is written with its bytes and range-partitioned by leading bytes at
   sampled splitters. Equal leads never part, so no match lies across the border of a bucket. Buckets are worked through in
   slices of whole cores. The right-hand sides (the suffixes) and the reversed left-hand sides are sorted by multikey
   quicksort over 8-byte characters; the common prefixes of neighbours give, for every offset, the class of the left side and
   of the right side, and two windows are equal when both classes are.
4. A core with more than LIMIT different contexts would be a bucket of its own: there the lead grows instead. The offsets are
   dealt into runs of RUN, the SPAN - RUN + 1 bytes shared by a run's windows are its lead; leads that occur once are dropped,
   the windows of the others are counted by hash, so no task holds the group.

Memory: a slice of texts, or SLICE contexts and one core. Shuffled are some 50 bytes per 160 bytes of text, the compressed
texts of documents with undecided contexts, those contexts, and the compressed texts once more for the result. Written
tables in the shared folder cut the lineage.

Edge cases: null and empty texts have no bytes and no spans; texts shorter than SPAN lose nothing; a row repeated with the
same id is one more document, so both lose what they share; null ids are allowed; equal rows give equal results; matches may
overlap, within one document too; what is kept may end inside a character and is therefore binary; other columns come back
inside ``row`` whatever their names; an empty table gives an empty result."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from querywright.llm.storage import slices, stored, to_batch
from querywright.llm.words import BLANKS, mix

SPAN = 400
WINDOW = 320
GRAM = 16
LIMIT = 2048              # different contexts of one core that are sorted together
RUN = 16                  # offsets that share a lead in a larger core
SLICE = 20_000            # contexts that are sorted together
BUFFER = 1 << 20          # bytes of text that are hashed together
SEEN = 200_000            # recent documents of a task whose repetition is noticed before the shuffle

_rng = np.random.default_rng(11)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEPS = _rng.integers(1, 1 << 63, 5, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BLANK = np.zeros(256, bool)
_BLANK[list(BLANKS)] = True
_PLACE = np.uint64((1 << 22) - 1)
_LATE = np.uint64(1 << 63)

ROWS = "k1 long, k2 long, core long, ctx long, at long, start long, n long, m long"
_ROWS = pa.schema([(x.split()[0], pa.int64()) for x in ROWS.split(", ")])
CONTEXTS = ("lead long, core long, hot boolean, single boolean, k1 long, k2 long, at long, start long, n long, bytes binary, "
            "run int, key long, s int, hashes array<long>")
_CONTEXTS = pa.schema([("lead", pa.int64()), ("core", pa.int64()), ("hot", pa.bool_()), ("single", pa.bool_()), ("k1", pa.int64()),
                       ("k2", pa.int64()), ("at", pa.int64()), ("start", pa.int64()), ("n", pa.int64()), ("bytes", pa.binary()),
                       ("run", pa.int32()), ("key", pa.int64()), ("s", pa.int32()), ("hashes", pa.list_(pa.int64()))])
SPANS = "k1 long, k2 long, from long, to long"
_SPANS = pa.schema([(x.split()[0], pa.int64()) for x in SPANS.split(", ")])


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least value of every run of ``width`` places."""
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[:len(values) - (width - size)], values[width - size:]) if size < width else values


def named_suffixes(data: np.ndarray, span: int = SPAN, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(at, start, n): the suffixes that the windows of one buffer name, and the windows of each."""
    n = len(data)
    if n < span:
        return (np.zeros(0, np.int64),) * 3
    h, size = _BYTE[data], 1
    for step in _STEPS[:GRAM.bit_length() - 1]:
        h = h[:-size] * step + h[size:]
        size *= 2
    h = mix(h) >> np.uint64(1)
    blank = _BLANK[data[:len(h)]]
    h[1:][~(blank[:-1] & ~blank[1:])] |= _LATE
    h = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
    at = (_least(h[1:], window - 1)[:n - span + 1] & _PLACE).astype(np.int64)
    start = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    return at[start], start, np.diff(np.append(start, len(at)))


def suffix_rows(text: bytes, span: int = SPAN, window: int = WINDOW) -> list[np.ndarray]:
    """core, ctx, at, start, n, m of one text; ``m`` neighbouring rows with equal contexts are one."""
    core_size, parts = span - window + 1, []
    for first in range(0, max(len(text) - span + 1, 1), BUFFER):
        piece = text[first:first + BUFFER + span - 1]
        at, start, n = named_suffixes(np.frombuffer(piece, np.uint8), span, window)
        core = np.array([xxhash.xxh3_64_intdigest(piece[a:a + core_size]) for a in at.tolist()], np.uint64)
        ctx = np.array([xxhash.xxh3_64_intdigest(piece[a:b], 1) for a, b in zip(start.tolist(), (start + n - 1 + span).tolist())],
                       np.uint64)
        same = np.zeros(len(at), bool)
        same[1:] = (core[1:] == core[:-1]) & (ctx[1:] == ctx[:-1]) & (n[1:] == n[:-1])
        lead = np.flatnonzero(~same)
        parts.append([core.view(np.int64)[lead], ctx.view(np.int64)[lead], at[lead] + first, start[lead] + first, n[lead],
                      np.diff(np.append(lead, len(at)))])
    return [np.concatenate(c) for c in zip(*parts)]


def _rows(span: int, window: int):
    def run(batches):
        for batch in slices(batches):
            out = []
            for k1, k2, text in zip(*(c.to_pylist() for c in batch.columns)):
                found = suffix_rows((text or "").encode(), span, window)
                if len(found[0]):
                    out.append([np.full(len(found[0]), k1), np.full(len(found[0]), k2), *found])
            if out:
                yield to_batch(_ROWS, [np.concatenate(c) for c in zip(*out)])
    return run


def _packed(batches):
    """Compressed texts; of a document repeated in a task only the first is sent on."""
    pack, seen = zstandard.ZstdCompressor(level=1), set()
    for batch in slices(batches):
        out = []
        for k1, k2, text in zip(*(c.to_pylist() for c in batch.columns)):
            if (k1, k2) not in seen:
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add((k1, k2))
                out.append((k1, k2, pack.compress((text or "").encode())))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.binary()))]
                                         if out else [pa.array([], t) for t in (pa.int64(), pa.int64(), pa.binary())], names=["k1", "k2", "z"])


def _contexts(span: int, window: int):
    """The bytes of the undecided contexts; for cores with too many of them the leads and window hashes of their runs."""
    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in slices(batches, 64):
            out = []
            for k1, k2, z, asked in zip(*(c.to_pylist() for c in batch.columns)):
                text = unpack.decompress(z)
                for x in asked:
                    at, start, n, single = x["at"], x["start"], x["n"], x["single"]
                    lead = int.from_bytes(text[at:at + 8], "big") >> 1
                    if not x["hot"]:
                        out.append((lead, x["core"], False, single, k1, k2, at, start, n, text[start:start + n - 1 + span],
                                    None, None, None, None))
                        continue
                    low, high = at - (start + n - 1), at - start
                    for run_ in range(low // RUN, high // RUN + 1):
                        first, last = max(low, run_ * RUN), min(high, run_ * RUN + RUN - 1)
                        shared = at - run_ * RUN
                        key = xxhash.xxh3_64_intdigest(text[shared:shared + span - RUN + 1], 2)
                        hashes = [_signed(xxhash.xxh3_64_intdigest(text[at - s:at - s + span], 3)) for s in range(first, last + 1)]
                        out.append((lead, x["core"], True, single, k1, k2, at, start, n, None, run_, _signed(key), first, hashes))
            if out:
                yield to_batch(_CONTEXTS, zip(*out))
    return run


def multikey_order(words: np.ndarray, group: np.ndarray) -> np.ndarray:
    """The order of rows of 8-byte characters inside each group (rows of a group lie together): multikey quicksort, all
    segments at once. A round splits every open segment by the character of its middle row; the equal part goes on with
    the next character."""
    n, depth_end = words.shape
    order, place = np.arange(n), np.arange(n)
    segment = np.cumsum(np.append(False, group[1:] != group[:-1])) if n else group
    depth = np.zeros(n, np.int64)
    while len(place):
        first = np.flatnonzero(np.append(True, segment[1:] != segment[:-1]))
        size = np.diff(np.append(first, len(segment)))
        open_ = np.repeat(size > 1, size) & (depth < depth_end)
        place, segment, depth = place[open_], segment[open_], depth[open_]
        if not len(place):
            break
        first = np.flatnonzero(np.append(True, segment[1:] != segment[:-1]))
        size = np.diff(np.append(first, len(segment)))
        key = words[order[place], depth]
        pivot = np.repeat(key[first + size // 2], size)
        part = (key >= pivot).astype(np.int64) + (key > pivot)
        number = np.repeat(np.arange(len(first)), size) * 3 + part
        by = np.argsort(number, kind="stable")
        order[place] = order[place[by]]
        segment, depth = number[by], depth + (part[by] == 1)
    return order


def _common(rows: np.ndarray, order: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Bytes that each row in order shares with the one before; -1 where a group begins."""
    out = np.full(len(order), -1, np.int64)
    for at in range(1, len(order), 4096):
        stop = min(at + 4096, len(order))
        differ = rows[order[at:stop]] != rows[order[at - 1:stop - 1]]
        out[at:stop] = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    out[1:][group[1:] != group[:-1]] = -1
    return out


def repeated_windows(contexts: list[bytes], left: np.ndarray, n: np.ndarray, group: np.ndarray, span: int = SPAN,
                     window: int = WINDOW) -> np.ndarray:
    """Row and offset of the windows that another context of the group holds too. ``left``: bytes of a context before its
    suffix; its windows start ``left`` down to ``left - n + 1`` bytes before the suffix."""
    size, wide = len(contexts), -(-span // 8) * 8
    right, before = np.zeros((size, wide), np.uint8), np.zeros((size, wide), np.uint8)
    for i, (text, cut) in enumerate(zip(contexts, left.tolist())):
        row = np.frombuffer(text, np.uint8)
        right[i, :len(row) - cut] = row[cut:]
        before[i, :cut] = row[:cut][::-1]
    place, common = [], []
    for rows in (right, before):
        order = multikey_order(rows.view(">u8").astype(np.uint64), group)
        common.append(_common(rows, order, group))
        at = np.empty(size, np.int64)
        at[order] = np.arange(size)
        place.append(at)
    found = np.zeros((size, window), bool)
    for s in range(1, window):
        rows = np.flatnonzero((left >= s) & (left - n < s))
        if len(rows) < 2:
            continue
        code = np.cumsum(common[0] < span - s)[place[0][rows]] * (size + 1) + np.cumsum(common[1] < s)[place[1][rows]]
        by = np.argsort(code)
        same = np.append(False, code[by[1:]] == code[by[:-1]])
        same[:-1] |= same[1:]
        found[rows[by[same]], s] = True
    return found


def _solved(span: int, window: int):
    def solve(table: pa.Table):
        k1, k2, at, start, n, core = (table[c].to_numpy() for c in ("k1", "k2", "at", "start", "n", "core"))
        single = table["single"].to_numpy(zero_copy_only=False)
        found = repeated_windows(table["bytes"].to_pylist(), at - start, n, core, span, window) & single[:, None]
        edge = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        row, low = np.nonzero(edge == 1)
        high = np.nonzero(edge == -1)[1] - 1
        return to_batch(_SPANS, [k1[row], k2[row], at[row] - high, at[row] - low + span])

    def run(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            if held.num_rows < SLICE:
                continue
            core = held["core"].to_numpy()
            cut = int(np.flatnonzero(core != core[-1])[-1]) + 1 if core[0] != core[-1] else 0  # the last core may go on
            if cut:
                yield solve(held.slice(0, cut))
                held = held.slice(cut).combine_chunks()
        if held is not None and held.num_rows:
            yield solve(held)
    return run


def _crowded_spans(contexts: DataFrame, span: int) -> DataFrame:
    """Repeated windows of the cores with too many contexts, counted by lead and then by window."""
    runs = contexts.filter("hot")
    leads = runs.groupBy("core", "run", "key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").drop("c")
    windows = (runs.join(leads, ["core", "run", "key"])
               .select("core", "k1", "k2", "at", "s", "single", F.posexplode("hashes").alias("j", "hash"))
               .withColumn("s", F.col("s") + F.col("j")).drop("j"))
    often = windows.groupBy("core", "s", "hash").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").drop("c")
    first = F.col("at") - F.col("s")
    return windows.filter("single").join(often, ["core", "s", "hash"]).select(
        "k1", "k2", first.alias("from"), (first + span).alias("to"))


def repeated_spans(docs: DataFrame, text: str = "text", span: int = SPAN, window: int = WINDOW, limit: int = LIMIT) -> DataFrame:
    """(k1, k2, spans): the covered stretches of each document that has any, by its 128-bit key; ``docs`` holds k1, k2 and the text."""
    base = docs.select("k1", "k2", F.col(text).alias("_text"))
    rows = stored(base.mapInArrow(_rows(span, window), ROWS))
    cores = rows.groupBy("core").agg(F.sum("m").alias("c"), (F.min("ctx") != F.max("ctx")).alias("mixed")).filter("c > 1").drop("c")
    rows = stored(rows.join(cores, "core"))
    covered = [F.col("start").alias("from"), (F.col("start") + F.col("n") * F.col("m") - 1 + span).alias("to")]
    plain = rows.filter("NOT mixed").select("k1", "k2", *covered)
    mixed = rows.filter("mixed")
    contexts = stored(mixed.groupBy("core", "ctx").agg(
        F.sum("m").alias("c"), F.min(F.struct("k1", "k2", "at", "start", "n")).alias("r")))
    copies = mixed.join(contexts.filter("c > 1").select("core", "ctx"), ["core", "ctx"]).select("k1", "k2", *covered)
    crowded = contexts.groupBy("core").agg(F.count(F.lit(1)).alias("k")).filter(F.col("k") > limit).select("core", F.lit(True).alias("hot"))
    asked = (contexts.join(crowded, "core", "left")
             .select("r.k1", "r.k2", F.struct("core", "r.at", "r.start", "r.n", (F.col("c") == 1).alias("single"),
                                              F.coalesce("hot", F.lit(False)).alias("hot")).alias("x"))
             .groupBy("k1", "k2").agg(F.collect_list("x").alias("asked")))
    texts = base.mapInArrow(_packed, "k1 long, k2 long, z binary").join(asked, ["k1", "k2"])
    texts = texts.groupBy("k1", "k2").agg(F.first("z").alias("z"), F.first("asked").alias("asked"))
    held = stored(texts.mapInArrow(_contexts(span, window), CONTEXTS))
    bucketed = (held.filter("NOT hot").select("lead", "core", "single", "k1", "k2", "at", "start", "n", "bytes")
                .repartitionByRange("lead", "core").sortWithinPartitions("lead", "core"))
    sorted_ = bucketed.mapInArrow(_solved(span, window), SPANS)
    spans = plain.unionByName(copies).unionByName(sorted_).unionByName(_crowded_spans(held, span))
    return spans.groupBy("k1", "k2").agg(F.collect_set(F.struct("from", "to")).alias("spans"))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


OUT = "struct<n_bytes long, n_removed long, spans array<struct<from long, to long>>, kept binary>"
_OUT = pa.struct([("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                  ("spans", pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))), ("kept", pa.binary())])


def _cut(packed: pa.Array, spans: pa.Array) -> pa.Array:
    unpack, out = zstandard.ZstdDecompressor(), []
    for z, found in zip(packed.to_pylist(), spans.to_pylist()):
        text = unpack.decompress(z)
        gone = merged([(x["from"], x["to"]) for x in found or []])
        edges = [0, *(e for pair in gone for e in pair), len(text)]
        kept = b"".join(text[a:b] for a, b in zip(edges[0::2], edges[1::2]))
        out.append((len(text), len(text) - len(kept), [{"from": a, "to": b} for a, b in gone], kept))
    return pa.StructArray.from_arrays([pa.array(list(c), t.type) for c, t in zip(zip(*out) if out else [()] * 4, _OUT)], fields=list(_OUT))


def _pack(texts: pa.Array) -> pa.Array:
    pack = zstandard.ZstdCompressor(level=1)
    return pa.array([pack.compress((t or "").encode()) for t in texts.to_pylist()], pa.binary())


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", span: int = SPAN, window: int = WINDOW,
                    limit: int = LIMIT) -> DataFrame:
    """(row, out): each row of ``docs`` without its text, and ``out`` with n_bytes, n_removed, the removed spans and the kept bytes."""
    keyed = docs.select(F.struct(*[F.col(c) for c in docs.columns if c != text]).alias("row"), F.col(text).alias("_text"),
                        F.xxhash64(id_col, text).alias("k1"), F.xxhash64(text, id_col, F.lit(7)).alias("k2"))
    found = repeated_spans(keyed.select("k1", "k2", "_text"), "_text", span, window, limit)
    packed = keyed.select("row", "k1", "k2", F.arrow_udf(_pack, "binary").asNondeterministic()("_text").alias("z"))
    cut = F.arrow_udf(_cut, OUT).asNondeterministic()
    return packed.join(found, ["k1", "k2"], "left").select("row", cut("z", "spans").alias("out"))
