"""Incremental, reversible line dedup: exact reference counts with sharded cuckoo filters in front.

State: a log of references (shard, digest, doc_id, delta), one row per document and distinct line key; an insertion appends
+1 rows, a deletion appends the -1 rows of the documents that leave. The sum of the deltas is the exact reference count of
a key in a document, so nothing is lost by deleting and inserting again. ``frequent`` folds the log into the keys that
enough documents hold, with the largest document of each. ``filters`` keeps the digests of those keys in one cuckoo filter
per shard; cuckoo filters can forget, so a key that falls below the threshold is deleted from its shard's filter alone.

Dropping lines: the filters answer "certainly not frequent" inside the scan of the texts, so only lines of frequent keys
(and a few false positives) are shuffled to the exact table, which has the last word. The filters are sent to the tasks
only while their total size, which is summed first, is within FILTER_BYTES; beyond that all long lines meet the exact table
in the join. Both ways give the same rows.

Skew: copies of a key inside one document are folded in the task; counts are pre-aggregated before the shuffle; the join
with the exact table is a plain equi-join that adaptive execution can split.

Edge cases: a null or empty text is one empty line; documents without an id are never counted and keep all their lines; a
repeated doc_id counts once per key, and all its rows lose the same lines; ties cannot occur, since the largest id is kept.
Other columns pass through unchanged, whatever their names."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from querywright.llm.storage import settle
from querywright.llm.words import BLANKS

MIN_CHARS = 40
MIN_DOCS = 5
SHARDS = 64
FILTER_BYTES = 32 << 20
SLOTS = 4                 # fingerprints per bucket
KICKS = 500
DIGEST_BYTES = 16


def key_digest(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """128-bit digest of a line's key, or None when the key is too short."""
    key = line.strip(BLANKS)
    if len(key) < min_chars or (not key.isascii() and len(key.decode()) < min_chars):
        return None
    return hashlib.blake2b(key.lower(), digest_size=DIGEST_BYTES).digest()  # bytes.lower changes A-Z only


def _digests(min_chars: int) -> Column:
    def run(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts:
            found = {key_digest(line, min_chars) for line in (text.as_py() or "").encode().split(b"\n")}
            found.discard(None)
            out.append(sorted(found))
        return pa.array(out, pa.list_(pa.binary()))

    return F.arrow_udf(run, "array<binary>")


def _shard(digest: Column, shards: int) -> Column:
    return F.conv(F.hex(F.substring(digest, 1, 4)), 16, 10).cast("long") % shards


class CuckooFilter:
    """Sixteen-bit fingerprints in buckets of four; holds keys, forgets keys, and never denies a key it holds."""

    def __init__(self, capacity: int, table: np.ndarray | None = None):
        if table is None:
            buckets = 1 << max(1, int(np.ceil(np.log2(max(capacity, 1) / SLOTS / 0.85))))
            table = np.zeros((buckets, SLOTS), np.uint16)
        self.table = table

    @classmethod
    def load(cls, data: bytes) -> CuckooFilter:
        return cls(0, np.frombuffer(data, np.uint16).reshape(-1, SLOTS).copy())

    def dump(self) -> bytes:
        return self.table.tobytes()

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(digest[4:6], "little") or 1
        first = int.from_bytes(digest[6:14], "little") & (len(self.table) - 1)
        return mark, first, self._other(first, mark)

    def _other(self, place: int, mark: int) -> int:
        return place ^ (mark * 0x5BD1E995 >> 7 & (len(self.table) - 1))

    def add(self, digest: bytes) -> bool:
        """False when the filter is too full; what was held before is held still."""
        mark, first, second = self._places(digest)
        for place in (first, second):
            free = np.flatnonzero(self.table[place] == 0)
            if len(free):
                self.table[place, free[0]] = mark
                return True
        place, path = first, []
        for kick in range(KICKS):
            slot = kick % SLOTS
            path.append((place, slot))
            mark, self.table[place, slot] = int(self.table[place, slot]), mark
            place = self._other(place, mark)
            free = np.flatnonzero(self.table[place] == 0)
            if len(free):
                self.table[place, free[0]] = mark
                return True
        for place, slot in reversed(path):
            mark, self.table[place, slot] = int(self.table[place, slot]), mark
        return False

    def remove(self, digest: bytes) -> bool:
        """Forget one copy of a key that was added."""
        mark, first, second = self._places(digest)
        for place in (first, second):
            held = np.flatnonzero(self.table[place] == mark)
            if len(held):
                self.table[place, held[0]] = 0
                return True
        return False

    def holds(self, digest: bytes) -> bool:
        mark, first, second = self._places(digest)
        return mark in self.table[first] or mark in self.table[second]

    def rows(self) -> list[frozenset]:
        """The buckets for fast look-ups."""
        return [frozenset(r) - {0} for r in self.table.tolist()]


def build_filter(digests: list[bytes]) -> CuckooFilter:
    room = len(digests)
    while True:
        out = CuckooFilter(room)
        if all(map(out.add, digests)):
            return out
        room = 2 * max(room, 1)


def references(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS,
               shards: int = SHARDS, delta: int = 1) -> DataFrame:
    """(shard, digest, doc_id, delta): one row per row of ``docs`` and distinct key."""
    rows = docs.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("doc_id"), F.explode(_digests(min_chars)(F.col(text))).alias("digest"))
    return rows.select(_shard(F.col("digest"), shards).alias("shard"), "digest", "doc_id", F.lit(delta).alias("delta"))


def frequent(log: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(digest, n_docs, keeper) of the keys that at least ``min_docs`` documents hold."""
    held = log.groupBy("digest", "doc_id").agg(F.sum("delta").alias("refs")).filter("refs > 0")
    return (held.groupBy("digest").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("keeper"))
            .filter(F.col("n_docs") >= min_docs))


def filters(keys: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(shard, n, filter): one cuckoo filter per shard over the digests of ``keys``. The number of shards is raised with
    the number of keys by the caller, so that a shard stays a task's work."""
    def build(table: pa.Table) -> pa.Table:
        digests = sorted(table["digest"].to_pylist())
        return pa.table({"shard": [table["shard"][0].as_py()], "n": [len(digests)],
                         "filter": pa.array([build_filter(digests).dump()], pa.binary())})

    return (keys.select(_shard(F.col("digest"), shards).alias("shard"), "digest").groupBy("shard")
            .applyInArrow(build, "shard long, n long, filter binary"))


def changed_filters(old: DataFrame, came: DataFrame, went: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The filters after keys became frequent (``came``) or ceased to be (``went``). Shards without a change stay as they
    are; a shard that overflows is rebuilt by the caller from the exact table (its row has a null filter)."""
    moves = (came.select("digest", F.lit(1).alias("move"))
             .unionByName(went.select("digest", F.lit(-1).alias("move")))
             .select(_shard(F.col("digest"), shards).alias("shard"), "digest", "move"))

    def change(held: pa.Table, moves: pa.Table) -> pa.Table:
        shard = (held if held.num_rows else moves)["shard"][0].as_py()
        n = held["n"][0].as_py() if held.num_rows else 0
        todo = sorted(zip(moves["move"].to_pylist(), moves["digest"].to_pylist()))
        one = CuckooFilter.load(held["filter"][0].as_py()) if held.num_rows else CuckooFilter(len(todo))
        ok = True
        for move, digest in todo:                      # deletions first
            ok = (one.add(digest) if move > 0 else one.remove(digest)) and ok
            n += move
        return pa.table({"shard": [shard], "n": [n], "filter": pa.array([one.dump() if ok else None], pa.binary())})

    return (old.groupBy("shard").cogroup(moves.groupBy("shard"))
            .applyInArrow(change, "shard long, n long, filter binary"))


def _probe(spark: SparkSession, table: DataFrame, min_chars: int, shards: int) -> Column:
    """The digests of a text's lines that may be frequent."""
    size = table.agg(F.sum(F.length("filter"))).first()[0] or 0
    if size > FILTER_BYTES:
        return _digests(min_chars)
    held = spark.sparkContext.broadcast({r["shard"]: bytes(r["filter"]) for r in table.collect()})  # within FILTER_BYTES
    opened: dict = {}

    def run(texts: pa.Array) -> pa.Array:
        if not opened:
            opened.update((s, (f := CuckooFilter.load(d), f.rows())) for s, d in held.value.items())
            opened[None] = None
        out = []
        for text in texts:
            found = set()
            for line in (text.as_py() or "").encode().split(b"\n"):
                digest = key_digest(line, min_chars)
                if digest and (shard := opened.get(int.from_bytes(digest[:4], "big") % shards)):
                    mark, first, second = shard[0]._places(digest)
                    if mark in shard[1][first] or mark in shard[1][second]:
                        found.add(digest)
            out.append(sorted(found))
        return pa.array(out, pa.list_(pa.binary()))

    return F.arrow_udf(run, "array<binary>")


def drops(docs: DataFrame, keys: DataFrame, table: DataFrame, id_col: str = "doc_id", text: str = "text",
          min_chars: int = MIN_CHARS, shards: int = SHARDS) -> DataFrame:
    """(doc_id, lost): the digests whose lines a document loses, for the documents that lose any."""
    probe = _probe(docs.sparkSession, table, min_chars, shards)
    hits = docs.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("doc_id"), F.explode(probe(F.col(text))).alias("digest"))
    lost = hits.join(keys.select("digest", "keeper"), "digest").filter("doc_id <> keeper")
    # a document's own long lines bound the list
    return lost.groupBy("doc_id").agg(F.collect_set("digest").alias("lost"))


def _strip(min_chars: int) -> Column:
    def run(texts: pa.Array, lost: pa.Array) -> pa.Array:
        kept, total, dropped = [], [], []
        for text, gone in zip(texts, lost):
            lines, gone = (text.as_py() or "").split("\n"), gone.as_py()
            total.append(len(lines))
            if gone:
                gone = set(gone)
                stay = [x for x in lines if len(x) < min_chars or key_digest(x.encode(), min_chars) not in gone]
            else:
                stay = lines
            dropped.append(len(lines) - len(stay))
            kept.append("\n".join(stay))
        return pa.StructArray.from_arrays([pa.array(kept, pa.string()), pa.array(total, pa.int64()),
                                           pa.array(dropped, pa.int64())], names=["text", "n_lines", "n_dropped"])

    return F.arrow_udf(run, "struct<text string, n_lines long, n_dropped long>").asNondeterministic()


def without_lines(docs: DataFrame, lost: DataFrame, id_col: str = "doc_id", text: str = "text",
                  min_chars: int = MIN_CHARS) -> DataFrame:
    """(row, out): every row of ``docs`` as a struct, and the text that stays with its line counts."""
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("_id"), F.col(text).alias("_text"))
    joined = rows.join(lost.select(F.col("doc_id").alias("_id"), "lost"), "_id", "left")
    return joined.select("row", _strip(min_chars)(F.col("_text"), F.col("lost")).alias("out"))


@dataclass
class LineIndex:
    """The state after any number of insertions and deletions. Frames in it are settled, so a change costs what it adds."""

    log: DataFrame
    keys: DataFrame
    table: DataFrame
    min_chars: int = MIN_CHARS
    min_docs: int = MIN_DOCS
    shards: int = SHARDS

    @classmethod
    def build(cls, docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS,
              min_docs: int = MIN_DOCS, shards: int = SHARDS) -> LineIndex:
        log = settle(references(docs, id_col, text, min_chars, shards))
        keys = settle(frequent(log, min_docs))
        return cls(log, keys, settle(filters(keys, shards)), min_chars, min_docs, shards)

    def _moved(self, change: DataFrame) -> LineIndex:
        log = settle(self.log.unionByName(change))
        keys = settle(frequent(log, self.min_docs))
        table = settle(changed_filters(self.table, keys.join(self.keys, "digest", "left_anti"),
                                       self.keys.join(keys, "digest", "left_anti"), self.shards))
        full = table.filter("filter IS NULL").select("shard")
        again = filters(keys.join(full, _shard(keys["digest"], self.shards) == full["shard"], "left_semi"), self.shards)
        table = settle(table.filter("filter IS NOT NULL").unionByName(again))
        return LineIndex(log, keys, table, self.min_chars, self.min_docs, self.shards)

    def insert(self, docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> LineIndex:
        return self._moved(references(docs, id_col, text, self.min_chars, self.shards))

    def delete(self, docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> LineIndex:
        """Take back documents that were inserted, given with the texts they had."""
        return self._moved(references(docs, id_col, text, self.min_chars, self.shards, -1))

    def clean(self, docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
        """``without_lines`` under this state."""
        lost = drops(docs, self.keys, self.table, id_col, text, self.min_chars, self.shards)
        return without_lines(docs, lost, id_col, text, self.min_chars)


def snapshot(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS,
             min_docs: int = MIN_DOCS, shards: int = SHARDS) -> DataFrame:
    """``without_lines`` for a corpus that is given once: the log is folded as it is made and never stored."""
    log = references(docs, id_col, text, min_chars, shards)
    keys = settle(frequent(log, min_docs))
    lost = drops(docs, keys, settle(filters(keys, shards)), id_col, text, min_chars, shards)
    return without_lines(docs, lost, id_col, text, min_chars)


def clean_rows(docs: DataFrame, id_col: str = "doc_id", text: str = "text", **rules) -> DataFrame:
    """The rows of ``docs`` with their text replaced by the lines that stay; other columns unchanged."""
    out = snapshot(docs, id_col, text, **rules)
    return out.select(*[(F.col("out.text") if c == text else F.col("row")[c]).alias(c) for c in docs.columns])
