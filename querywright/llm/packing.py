"""Best-fit packing by the sum-of-squares rule.

Documents become token ids followed by an end id; a document longer than a sequence is cut from its end, so that only its
first piece may be short. Full pieces are sequences of their own. The others are placed one by one, the longest first: of
all residual gaps that can take the piece, the one is taken after which the sum of the squared numbers of open sequences
per gap is smallest. That keeps no gap frequent, so gaps of all sizes stay at hand until the end. Of equal sums the
tightest gap wins; a new sequence is opened only when no open one can take the piece.

Encoding is one pass over the texts without a shuffle; only (id, piece, start, length, checksum) rows move. They are dealt
by hash into groups of about GROUP_PIECES pieces whatever the corpus size, and each group is packed alone: the state of a
task is one counter per gap and the numbers of the open sequences, and a group wastes a sequence or two of many thousand.

Edge cases: a null or empty text is the end id alone; null ids, ties and repeated rows are packed like other rows (rows
equal in every column stay apart, with a sequence place each); an empty table gives an empty result; columns beside the id
and the text take no part, so their names do not matter."""

from __future__ import annotations

import functools
import zlib

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from querywright.llm.bpe import Pieces, Vocabulary, pretokens
from querywright.llm.storage import settle

SEQUENCE = 2048
END_ID = 0
GROUP_PIECES = 50_000
LONG_PIECE = 256          # bytes; longer pre-tokens go to the tokenizer library's own merge queue

PIECE_TYPE = "array<struct<piece int, start long, length long, ids_crc32 long, ids binary>>"
_ARROW = pa.list_(pa.struct([("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                             ("ids_crc32", pa.int64()), ("ids", pa.binary())]))


class FastEncoder:
    """Ids of whole texts as the tokenizer library gives them. Pre-tokens are remembered; new ones are merged by a
    rank-table library, which equals the merge list because ids follow the ranks."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary.load(path)
        self.library = Tokenizer.from_file(path)
        made = [i for _, i in self.vocabulary.merges.values()]
        self.ranked = None
        if made == sorted(made) and max(self.vocabulary.byte_ids) < made[0]:
            plain = set(self.vocabulary.byte_ids) | set(made)
            self.ranked = tiktoken.Encoding(
                "pieces", pat_str=r"[\s\S]+", special_tokens={},
                mergeable_ranks={self.vocabulary.tokens[i]: i for i in plain})
        self.known = Pieces(self._merge)

    def _merge(self, piece: str) -> bytes:
        if self.ranked is None or len(piece) > LONG_PIECE:
            ids = self.library.encode(piece, add_special_tokens=False).ids
        else:
            ids = self.ranked.encode_ordinary(piece)
        return np.array(ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        out = []
        for k, part in enumerate(self.vocabulary.parts(text)):
            if k % 2:
                out.append(np.array([self.vocabulary.special[part]], "<u4").tobytes())
            else:
                out += map(self.known.__getitem__, pretokens(part))
        return b"".join(out)


@functools.lru_cache(maxsize=4)
def encoder(path: str) -> FastEncoder:
    return FastEncoder(path)


def cuts(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids."""
    first = n % size or size
    return [(0, min(first, n)), *((at, size) for at in range(first, n, size))]


def pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text", size: int = SEQUENCE,
           end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32, ids): every document's ids in pieces; ``ids`` is null unless asked for."""
    tail = np.array([end_id], "<u4").tobytes()

    def run(texts: pa.Array) -> pa.Array:
        one, out = encoder(path), []
        for value in texts:
            ids = one.encode(value.as_py() or "") + tail
            out.append([{"piece": k, "start": start, "length": length,
                         "ids_crc32": zlib.crc32(part := ids[4 * start:4 * (start + length)]),
                         "ids": part if with_ids else None}
                        for k, (start, length) in enumerate(cuts(len(ids) // 4, size))])
        return pa.array(out, _ARROW)

    cut = F.arrow_udf(run, PIECE_TYPE).asNondeterministic()  # evaluated once, whatever stands above it
    return docs.select(F.col(id_col).alias("doc_id"), cut(F.col(text)).alias("p")).select("doc_id", F.inline("p"))


def sum_of_squares(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each length, placed in the given order."""
    count = np.zeros(size + 1, np.int64)               # open sequences per gap; full ones are not open
    opened: list[list[int]] = [[] for _ in range(size + 1)]
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    used = 0
    for k, n in enumerate(lengths.tolist()):
        # change of the sum when gap g becomes g - n: 2 * (count[g - n] - count[g] + 1), without the first part at g = n
        after = count[n:size + 1] > 0
        change = 2 * (count[0:size + 1 - n] - count[n:size + 1] + 1)
        change[0] = 1 - 2 * count[n]
        gaps = np.flatnonzero(after)
        if len(gaps):
            gap = n + int(gaps[np.argmin(change[gaps])])
            place = opened[gap].pop()
            count[gap] -= 1
        else:
            gap, place = size, used
            used += 1
        sequence[k], offset[k] = place, size - gap
        if gap - n:
            opened[gap - n].append(place)
            count[gap - n] += 1
    return sequence, offset


def pack(cut: DataFrame, size: int = SEQUENCE, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces. The pieces are written first, so that their number is known and no
    text is encoded twice."""
    cut = settle(cut)
    groups = max(1, -(-cut.filter(F.col("length") < size).count() // group_pieces))
    columns = [f"{f.name} {f.dataType.simpleString()}" for f in cut.schema]
    schema = ", ".join([*columns, "sequence_id long", "offset long"])

    def place(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"),
                               ("ids_crc32", "ascending")])
        sequence, offset = sum_of_squares(table["length"].to_numpy(), size)
        group = table["_group"][0].as_py()
        return (table.drop_columns(["_group"])
                .append_column("sequence_id", pa.array((np.int64(group) << 40) + sequence))
                .append_column("offset", pa.array(offset)))

    part = F.pmod(F.xxhash64("doc_id", "piece", "length", "ids_crc32"), F.lit(groups)).cast("long")
    short = cut.filter(F.col("length") < size).withColumn("_group", part)
    packed = short.groupBy("_group").applyInArrow(place, schema)
    full = cut.filter(F.col("length") >= size).select(
        "*", (F.lit(-1) - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(full)
