"""Token counts by rank-synchronous array merging.

The pre-tokens of a batch lie end to end in one array of symbol ids with an array of owners beside it. Every round finds
the merge of the lowest rank in each sequence, applies it at all its places in all sequences at once, and closes the gaps;
a sequence without a merge left is finished, and its surviving symbols are its token count. Equal pre-tokens are merged
once.

Edge cases: null and empty texts have no tokens; special strings of the vocabulary count as one token each; a null id or
repeated rows are counted like any other row; other columns pass through untouched."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from querywright.llm.bpe import KNOWN_BYTES, KNOWN_PIECES, Vocabulary, pretokens

NO_RANK = np.iinfo(np.int32).max
ROUND_BYTES = 1 << 20     # bytes of pre-tokens merged together


class ArrayMerger:
    def __init__(self, vocabulary: Vocabulary):
        self.size = len(vocabulary.tokens)
        pairs = np.array(list(vocabulary.merges), np.int64)
        found = np.array(list(vocabulary.merges.values()), np.int32)
        keys = pairs[:, 0] * self.size + pairs[:, 1]
        order = np.argsort(keys)
        self.keys, self.rank, self.merged = keys[order], found[order, 0], found[order, 1]
        self.byte_ids = np.array(vocabulary.byte_ids, np.int32)
        every = np.arange(256)
        self.byte_rank, self.byte_merged = (x.reshape(256, 256) for x in self._look(
            self.byte_ids[np.repeat(every, 256)], self.byte_ids[np.tile(every, 256)]))

    def _look(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of the merge of each pair."""
        keys = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.rank[at], NO_RANK), self.merged[at]

    def counts(self, pieces: list[bytes]) -> np.ndarray:
        """Surviving symbols of each non-empty sequence."""
        out = np.zeros(len(pieces), np.int64)
        data = np.frombuffer(b"".join(pieces), np.uint8)
        owner = np.repeat(np.arange(len(pieces)), np.array([len(p) for p in pieces], np.int64))
        symbols = self.byte_ids[data]
        # rank and merged: of the pair that starts here; only pairs beside a new symbol are looked up again
        rank, merged = np.full(len(data), NO_RANK, np.int32), np.zeros(len(data), np.int32)
        rank[:-1], merged[:-1] = self.byte_rank[data[:-1], data[1:]], self.byte_merged[data[:-1], data[1:]]
        rank[:-1][owner[1:] != owner[:-1]] = NO_RANK
        while len(symbols):
            first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            sizes = np.diff(np.append(first, len(owner)))
            best = np.minimum.reduceat(rank, first)
            done = best == NO_RANK
            out[owner[first[done]]] = sizes[done]
            take = np.flatnonzero((rank == np.repeat(best, sizes)) & (rank != NO_RANK))
            # in a run of overlapping places (a a a) every second one is merged, from the left
            run = np.flatnonzero(np.append(True, np.diff(take) != 1)) if len(take) else take
            if len(run) < len(take):
                offset = np.arange(len(take)) - np.repeat(run, np.diff(np.append(run, len(take))))
                take = take[offset % 2 == 0]
            symbols[take] = merged[take]
            stays = ~np.repeat(done, sizes)
            stays[take + 1] = False
            new = np.cumsum(stays)[take] - 1
            symbols, owner, rank, merged = symbols[stays], owner[stays], rank[stays], merged[stays]
            beside = np.zeros(len(symbols) + 1, bool)
            beside[new] = beside[new - 1] = True  # -1 falls on the spare last place
            ask = np.flatnonzero(beside[:-1])
            rank[ask] = NO_RANK
            ask = ask[ask < len(symbols) - 1]
            ask = ask[owner[ask] == owner[ask + 1]]
            rank[ask], merged[ask] = self._look(symbols[ask], symbols[ask + 1])
        return out


class Counter:
    """Token counts of texts; remembers the counts of short pre-tokens up to a fixed number."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.merger, self.known = vocabulary, ArrayMerger(vocabulary), {}

    def _merge(self, pieces: list[str], into: dict):
        batch, filled = [], 0
        for place, piece in enumerate(pieces):
            batch.append(piece)
            filled += len(piece)
            if filled > ROUND_BYTES or place == len(pieces) - 1:
                into.update(zip(batch, self.merger.counts([p.encode() for p in batch]).tolist()))
                batch, filled = [], 0

    def counts(self, texts: list) -> list[int]:
        specials, cut = [], []
        for text in texts:
            parts = self.vocabulary.parts(text or "")
            specials.append(len(parts) // 2)
            cut.append([p for part in parts[::2] for p in pretokens(part)])
        known, fresh = self.known, {}
        self._merge([p for p in set().union(*cut) if p not in known], fresh)
        if len(known) < KNOWN_PIECES:
            known.update(kv for kv in fresh.items() if len(kv[0]) <= KNOWN_BYTES)
            if not any(len(p) > KNOWN_BYTES for p in fresh):
                return [n + sum(map(known.__getitem__, pieces)) for pieces, n in zip(cut, specials)]
        # what is not remembered serves this batch only
        return [n + sum([known[p] if p in known else fresh[p] for p in pieces]) for pieces, n in zip(cut, specials)]


@functools.lru_cache(maxsize=4)
def counter(path: str) -> Counter:
    return Counter(Vocabulary.load(path))


def with_token_counts(docs: DataFrame, path: str, text: str = "text", name: str = "n_tokens") -> DataFrame:
    """Add the token count of every whole text as column ``name`` (replacing one of that name)."""
    def count(texts: pa.Array) -> pa.Array:
        out = []
        for start in range(0, len(texts), 128):
            out += counter(path).counts(texts.slice(start, 128).to_pylist())
        return pa.array(out, pa.int64())

    return docs.withColumn(name, F.arrow_udf(count, "long")(F.col(text)))
