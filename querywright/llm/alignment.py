"""Alignment of two tokenizers through inverted pair bitmaps.

1. One pass over the texts: both tokenizers cut a text into bytes, the offsets where tokens of both end cut the tokens into
   groups, and the two tokens that end there are a link. A task numbers its documents inside blocks of at most BLOCK_DOCS
   documents and BLOCK_LINKS links.
2. Per block and id pair the documents that hold the pair become a compressed bitmap (a sorted array of places, or a bitset
   where that is smaller), with multiplicity planes beside it: plane i holds the documents whose number of further
   occurrences has bit i. Slices of documents are OR-merged as they come. A frequent pair costs a bit per document, so a pair
   that holds a third of all links is no hot key: it has as many rows as there are blocks.
3. Counts of a pair are popcounts: of the presence bitmap for documents, of the planes with their weights for links; sums over
   blocks are pre-aggregated before the shuffle. The best count per id of the second tokenizer is a table of at most one
   row per vocabulary entry and is broadcast.
4. The postings meet their pair's count and go back to their block, where count and best flag are added to every document in
   the bitmap: two totals per document of one block at a time.

The first step's rows are written to the shared folder before they are used, so the numbers of documents hold whatever
executor is lost later.

Edge cases: null and empty texts, and texts whose tokens of either tokenizer do not join to the blank and the text, have no
tokens: zeros and an empty group text; special strings inside texts are plain text; null ids, ties and repeated rows are counted
like any other row; other columns come back inside ``row`` whatever their names; an empty table gives an empty result."""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType

from querywright.llm.bpe import pretokens
from querywright.llm.packing import encoder
from querywright.llm.storage import SLICE_ROWS, slices, stored

BLOCK_DOCS = 1 << 16
BLOCK_LINKS = 4_000_000
ARRAY_DOCS = 4096         # places of two bytes up to here, a bitset of BLOCK_DOCS bits beyond
BATCH_ROWS = 50_000

_DOC = "n_a long, n_b long, n_groups long, groups string"
_POSTING = "a int, b int, plane int, n long, bitmap binary"
_NAMES = ["row", "block", "place", "n_a", "n_b", "n_groups", "groups", "a", "b", "plane", "n", "bitmap"]
_TYPES = {"block": pa.int64(), "place": pa.int32(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "groups": pa.string(),
          "a": pa.int32(), "b": pa.int32(), "plane": pa.int32(), "n": pa.int64(), "bitmap": pa.binary()}


class Aligner:
    """Groups and links of a text under a byte-level BPE vocabulary (A, blank and text) and a piece model (B, text)."""

    def __init__(self, path_a: str, path_b: str):
        self.first = encoder(path_a)
        self.second = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a = self.first.vocabulary.tokens
        self.bytes_b = [self._piece(i) for i in range(self.second.get_piece_size())]
        if not all(self.bytes_a) or not all(self.bytes_b):
            raise ValueError("tokens without bytes are not handled")
        self.size_a, self.size_b = np.array(list(map(len, self.bytes_a))), np.array(list(map(len, self.bytes_b)))
        self.strings = [f"{i}{end}" for n, ends in ((len(self.bytes_a), ",|"), (len(self.bytes_b), ",;")) for end in ends for i in range(n)]

    def _piece(self, i: int) -> bytes:
        piece = self.second.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.second.is_byte(i) else piece.replace("▁", " ").encode()

    def align(self, text: str | None) -> tuple[np.ndarray, ...] | None:
        """ids_a, ids_b, last_a, last_b: the ids, and the places of the tokens that close a group."""
        if not text:
            return None
        whole = " " + text
        want = whole.encode()
        a = np.frombuffer(b"".join(map(self.first.known.__getitem__, pretokens(whole))), "<u4").astype(np.int64)
        ids_b = self.second.encode(text, num_threads=1)
        if b"".join(map(self.bytes_a.__getitem__, a.tolist())) != want or b"".join(map(self.bytes_b.__getitem__, ids_b)) != want:
            return None
        b = np.array(ids_b, np.int64)
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        marks = np.zeros(len(want) + 1, np.int8)
        marks[ends_a] += 1
        marks[ends_b] += 1
        return a, b, np.flatnonzero(marks[ends_a] == 2), np.flatnonzero(marks[ends_b] == 2)

    def groups(self, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> str:
        """``a1,a2|b1;a3|b2,b3``."""
        close_a, close_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        close_a[last_a] = close_b[last_b] = 1
        group_a, group_b = np.cumsum(close_a) - close_a, np.cumsum(close_b) - close_b
        codes = np.empty(len(a) + len(b), np.int64)
        codes[np.arange(len(a)) + np.append(0, last_b + 1)[group_a]] = a + len(self.bytes_a) * close_a
        codes[np.arange(len(b)) + (last_a + 1)[group_b]] = 2 * len(self.bytes_a) + b + len(self.bytes_b) * close_b
        return "".join(map(self.strings.__getitem__, codes.tolist()))[:-1]


@functools.lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def _binaries(places: np.ndarray, first: np.ndarray, size: np.ndarray) -> pa.Array:
    """The places of each run as the bytes of a sorted 16-bit array (runs lie end to end)."""
    offsets = np.append(first, first[-1] + size[-1]).astype(np.int32) * 2
    return pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(places.astype("<u2").tobytes())])


def bitmaps(code: np.ndarray, place: np.ndarray):
    """(codes, n, bitmap) of sorted postings, one row per code, arrays and bitsets apart."""
    if not len(code):
        return
    first = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
    size = np.diff(np.append(first, len(code)))
    wide = size > ARRAY_DOCS
    small = np.flatnonzero(~np.repeat(wide, size))
    if len(small):
        n = size[~wide]
        at = np.cumsum(n) - n
        for start in range(0, len(n), BATCH_ROWS):
            stop = min(start + BATCH_ROWS, len(n))
            base, end = at[start], at[stop - 1] + n[stop - 1]
            yield code[first[~wide]][start:stop], n[start:stop], _binaries(place[small][base:end], at[start:stop] - base, n[start:stop])
    for f, n in zip(first[wide], size[wide]):
        bits = np.zeros(BLOCK_DOCS, np.uint8)
        bits[place[f:f + n]] = 1
        yield code[f:f + 1], np.array([n]), pa.array([np.packbits(bits).tobytes()], pa.binary())


def places_of(n: int, bitmap: bytes) -> np.ndarray:
    """The documents of one bitmap."""
    if n > ARRAY_DOCS:
        return np.flatnonzero(np.unpackbits(np.frombuffer(bitmap, np.uint8)))
    return np.frombuffer(bitmap, "<u2").astype(np.int64)


class _Block:
    """The postings of one block: sorted (code, place) keys with their numbers of occurrences."""

    def __init__(self):
        self.docs, self.links, self.keys, self.times = 0, 0, [], []

    def add(self, keys: np.ndarray):
        found, times = np.unique(keys, return_counts=True)
        self.keys.append(found)
        self.times.append(times)

    def planes(self):
        """(plane, codes, n, bitmap): presence is plane -1."""
        keys, times = np.concatenate(self.keys), np.concatenate(self.times) - 1
        order = np.argsort(keys, kind="stable")  # merges the sorted slices
        keys, times = keys[order], times[order]
        for plane in range(-1, int(times.max(initial=0)).bit_length()):
            held = keys if plane < 0 else keys[(times >> plane) & 1 == 1]
            for row in bitmaps(held >> 16, held & (BLOCK_DOCS - 1)):
                yield plane, *row


def _indexed(path_a: str, path_b: str, digest: bool, row_type: pa.DataType):
    def batch(size: int, **columns):
        return pa.RecordBatch.from_arrays([columns[c] if isinstance(columns.get(c), pa.Array) else pa.array(columns[c], _TYPES[c])
                                           if c in columns else pa.nulls(size, row_type if c == "row" else _TYPES[c]) for c in _NAMES], names=_NAMES)

    def run(batches):
        one = aligner(path_a, path_b)
        n_b = len(one.bytes_b)
        number, block = TaskContext.get().partitionId() << 24, _Block()

        def postings():
            for plane, code, n, bitmap in block.planes() if block.keys else ():
                yield batch(len(n), block=np.full(len(n), number), a=code // n_b, b=code % n_b, plane=np.full(len(n), plane), n=n, bitmap=bitmap)

        for part in slices(batches):
            out, first, keys = [], block.docs, []
            for place, text in enumerate(part.column(1).to_pylist(), first):
                found = one.align(text)
                if found is None:
                    out.append((0, 0, 0, ""))
                    continue
                a, b, last_a, last_b = found
                groups = one.groups(*found)
                out.append((len(a), len(b), len(last_a), hashlib.sha256(groups.encode()).hexdigest() if digest else groups))
                keys.append((a[last_a] * n_b + b[last_b]) << 16 | place)
                block.links += len(last_a)
            block.docs += len(out)
            names = ("n_a", "n_b", "n_groups", "groups")
            yield batch(len(out), row=part.column(0), block=np.full(len(out), number), place=np.arange(first, block.docs),
                        **{name: list(c) for name, c in zip(names, zip(*out))})
            if keys:
                block.add(np.concatenate(keys))
            if block.links >= BLOCK_LINKS or block.docs > BLOCK_DOCS - SLICE_ROWS:
                yield from postings()
                number, block = number + 1, _Block()
        yield from postings()

    return run


def pair_counts(postings: DataFrame) -> DataFrame:
    """(a, b, n_docs, n_links, best): popcounts of each id pair over all blocks; ``best``: no pair of the same b has more links."""
    weight = F.expr("shiftleft(1L, greatest(plane, 0))")
    counts = postings.groupBy("a", "b").agg(F.sum(F.when(F.col("plane") < 0, F.col("n"))).alias("n_docs"), F.sum(F.col("n") * weight).alias("n_links"))
    most = counts.groupBy("b").agg(F.max("n_links").alias("most"))  # at most one row per vocabulary entry
    return counts.join(F.broadcast(most), "b").select("a", "b", "n_docs", "n_links", (F.col("n_links") == F.col("most")).alias("best"))


_SCORES = "block long, place int, n_best long, count_sum long"


def _scores(batches):
    """Add count and best flag of every posting to the documents of its bitmap; rows come block by block."""
    held, totals = None, np.zeros((2, BLOCK_DOCS), np.int64)

    def flush():
        at = np.flatnonzero(totals[1])
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(at), held), pa.int64()), pa.array(at, pa.int32()),
                                           pa.array(totals[0][at], pa.int64()), pa.array(totals[1][at], pa.int64())],
                                          names=["block", "place", "n_best", "count_sum"])

    for batch in slices(batches, 1 << 14):
        block = batch["block"].to_numpy()
        for first, stop in zip(*(lambda e: (e[:-1], e[1:]))(np.append(np.flatnonzero(np.append(True, block[1:] != block[:-1])), len(block)))):
            if block[first] != held:
                if held is not None:
                    yield flush()
                held, totals[:] = block[first], 0
            n, plane, count = (batch[c].to_numpy()[first:stop] for c in ("n", "plane", "n_links"))
            best = batch["best"].to_numpy(zero_copy_only=False)[first:stop]
            weight = np.where(plane < 0, 1, np.int64(1) << np.maximum(plane, 0))
            maps = batch["bitmap"].slice(first, stop - first).to_pylist()
            small = n <= ARRAY_DOCS
            places = np.frombuffer(b"".join([m for m, s in zip(maps, small.tolist()) if s]), "<u2").astype(np.int64)
            np.add.at(totals[1], places, np.repeat((count * weight)[small], n[small]))
            np.add.at(totals[0], places, np.repeat((best * weight)[small], n[small]))
            for i in np.flatnonzero(~small):
                places = places_of(int(n[i]), maps[i])
                totals[1][places] += count[i] * weight[i]
                totals[0][places] += best[i] * weight[i]
    if held is not None:
        yield flush()


def index(docs: DataFrame, path_a: str, path_b: str, text: str = "text", digest: bool = False) -> DataFrame:
    """The written index: document rows (``row`` set) with their group text (or its SHA-256), and posting rows (``bitmap`` set)."""
    keyed = docs.select(F.struct(*[F.col(c) for c in docs.columns if c != text]).alias("row"), F.col(text).alias("_text"))
    schema = StructType([StructField("row", keyed.schema["row"].dataType), *StructType.fromDDL(f"block long, place int, {_DOC}, {_POSTING}")])
    row_type = to_arrow_type(keyed.schema["row"].dataType)
    return stored(keyed.mapInArrow(_indexed(path_a, path_b, digest, row_type), schema))


def align(docs: DataFrame, path_a: str, path_b: str, text: str = "text", digest: bool = False) -> DataFrame:
    """(row, n_a, n_b, n_groups, n_links, n_best, count_sum, groups), one row per row of ``docs``."""
    made = index(docs, path_a, path_b, text, digest)
    postings = made.filter(F.col("bitmap").isNotNull()).select("block", "a", "b", "plane", "n", "bitmap")
    counted = pair_counts(postings).select("a", "b", "n_links", "best")
    returned = (postings.join(counted, ["a", "b"]).select("block", "plane", "n", "bitmap", "n_links", "best")
                .repartition("block").sortWithinPartitions("block").mapInArrow(_scores, _SCORES))
    rows = made.filter(F.col("bitmap").isNull()).select("row", "block", "place", "n_a", "n_b", "n_groups", "groups")
    zero = F.lit(0).cast("long")
    return rows.join(returned, ["block", "place"], "left").select(
        "row", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups")
