"""BPE encoding as a bounded-lookahead streaming transducer, and decoding as a byte-to-text state machine.

Every prefix of a pre-token has exactly one last token: the one whose seam with the token before it survives all merges.
The transducer therefore keeps one step per byte: the last token of the prefix that ends there. ``lookahead`` computes from
the merge list how many bytes after a place can still matter to it; a token with so many bytes behind it never changes
again: it is emitted and forgotten, which bounds the memory of the window. New pre-tokens of a batch are taken in byte order,
so that each starts from the steps of the one before it.

The decoder turns ids into bytes and bytes into text, holding back at most the bytes of one unfinished character.

Edge cases: a null or empty text has no ids and decodes to the empty text; special strings become their own id and come
back; repeated rows and null ids are treated like any other row; other columns pass through untouched."""

from __future__ import annotations

import codecs
import functools
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from querywright.llm.bpe import KNOWN_BYTES, Pieces, Vocabulary, pretokens

NEVER = 1 << 30
CHUNK = 1 << 16           # characters or ids fed at once
HOLD = 1 << 12            # a longer unfinished pre-token is streamed into the transducer
KNOWN_SEAMS = 1_000_000
KNOWN_TEXTS = 700_000     # pre-tokens a worker remembers; others are merged anew


class MergeRules:
    """What the transducer asks of a merge list."""

    def __init__(self, vocabulary: Vocabulary):
        self.merges, self.tokens = vocabulary.merges, vocabulary.tokens
        self.parts = {made: (left, right, rank) for (left, right), (rank, made) in vocabulary.merges.items()}
        self.seams: dict[int, bool] = {}
        self.ids = {vocabulary.tokens[i]: i for i in vocabulary.byte_ids}
        for made, (left, right, rank) in self.parts.items():
            if self._holds(left, right, rank):  # else its own bytes are merged differently, and it never comes out
                self.ids[self.tokens[made]] = made
        self.longest = max(map(len, self.ids))

    def _spine(self, token: int, side: int, until: int):
        """(symbol, rank at which it is absorbed) along one edge of a token."""
        yield token, until
        while token in self.parts:
            left, right, rank = self.parts[token]
            token = right if side else left
            yield token, rank

    def _holds(self, a: int, b: int, until: int) -> bool:
        """Whether no merge of a rank below ``until`` crosses the seam between two tokens. On equal ranks the left
        place goes first."""
        right_edge = list(self._spine(b, 0, until))
        for x, x_until in self._spine(a, 1, until):
            for y, y_until in right_edge:
                found = self.merges.get((x, y))
                if found and found[0] < x_until and found[0] <= y_until and found[0] < until:
                    return False
        return True

    def seam(self, a: int, b: int) -> bool:
        key = a << 32 | b
        known = self.seams.get(key)
        if known is None:
            known = self._holds(a, b, NEVER)
            if len(self.seams) < KNOWN_SEAMS:
                self.seams[key] = known
        return known

    def advance(self, data: bytes, last: list[int], before: int):
        """Find the last token of every further prefix of ``data``: the one token whose seam holds. ``last`` has those of
        the shorter prefixes, ``before`` is the token in front of the data or -1."""
        ids, seams, seam = self.ids.get, self.seams.get, self.seam
        for end in range(len(last) + 1, len(data) + 1):
            if before < 0 and (token := ids(data[:end])) is not None:
                last.append(token)              # a prefix that is one token has no seam
                continue
            start = end
            while start:
                start -= 1
                token = ids(data[start:end])
                if token is None:
                    continue
                previous = last[start - 1] if start else before
                if previous < 0 or (holds := seams(previous << 32 | token)) or (holds is None and seam(previous, token)):
                    last.append(token)
                    break
            else:
                raise ValueError("the vocabulary cannot express these bytes")

    @functools.cached_property
    def lookahead(self) -> int:
        """Bytes after a symbol that can decide what becomes of it: a merge (x, z) of a lower rank may take it, z may be
        taken by a still lower one before that, and so on. The ranks fall along such a chain, so one pass in rank order
        finds the longest."""
        reach: dict[int, int] = {}    # by left symbol: the furthest sight of a merge seen so far
        inside: dict[int, int] = {}   # by symbol: the furthest sight needed to know that it comes to be
        for (left, right), (_, made) in self.merges.items():
            inside[made] = max(reach.get(right, 0), inside.get(right, 0))
            sight = len(self.tokens[right]) + max(reach.get(right, 0), inside.get(right, 0))
            reach[left] = max(reach.get(left, 0), sight)
        return max([*reach.values(), *inside.values(), 0])


class Transducer:
    """Bytes of one pre-token in, ids out as soon as they are stable."""

    def __init__(self, rules: MergeRules):
        self.rules = rules
        self.data = b""        # the bytes from the last emitted place on
        self.last: list[int] = []      # by place: the last token of the prefix that ends there
        self.before = -1               # the token emitted last
        self.check = 2 * rules.lookahead
        self.widest = 0

    def _trace(self, place: int) -> list[int]:
        out = []
        while place:
            token = self.last[place - 1]
            out.append(token)
            place -= len(self.rules.tokens[token])
        return out[::-1]

    def _settle(self) -> list[int]:
        """Emit the tokens that nothing to come can change: those with at least ``lookahead`` bytes behind them."""
        out = self._trace(len(self.last))
        stable = len(self.last) - self.rules.lookahead
        shared = len(self.last)
        while out and shared > stable:
            shared -= len(self.rules.tokens[out.pop()])
        if out:
            self.before = out[-1]
            self.data = self.data[shared:]
            del self.last[:shared]
        self.widest = max(self.widest, len(self.last))
        self.check = len(self.last) + self.rules.lookahead
        return out

    def feed(self, data: bytes) -> list[int]:
        out = []
        for k in range(0, len(data), self.rules.longest):
            self.data += data[k:k + self.rules.longest]
            self.rules.advance(self.data, self.last, self.before)
            if len(self.last) >= self.check:
                out += self._settle()
        return out

    def finish(self) -> list[int]:
        out = self._trace(len(self.last))
        self.data, self.last, self.before, self.check = b"", [], -1, 2 * self.rules.lookahead
        return out


class StreamEncoder:
    """Text in pieces of any size in, ids out; what is held back is bounded by the lookahead and by HOLD."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.rules = vocabulary, merge_rules(vocabulary.path)
        self.known = Pieces(self._whole)
        self.pack = [struct.Struct(f"<{n}I").pack for n in range(33)]
        self.text = self.held = ""
        self.open: Transducer | None = None    # a pre-token too long to wait for
        self.kind = ""
        self.special_parts = {s[:k] for s in vocabulary.special for k in range(1, len(s))}

    def _whole(self, piece: str) -> bytes:
        return self._ids(piece.encode(), [])

    def _ids(self, data: bytes, last: list[int]) -> bytes:
        """The ids of a whole pre-token; ``last`` has the steps of a prefix and gets the others."""
        if len(data) > self.rules.longest:
            one = Transducer(self.rules)
            return _packed(one.feed(data) + one.finish())
        whole = self.rules.ids.get(data)
        if whole is not None:
            return self.pack[1](whole)
        self.rules.advance(data, last, -1)
        out, place = [], len(data)
        while place:
            out.append(last[place - 1])
            place -= len(self.rules.tokens[out[-1]])
        return self.pack[len(out)](*out[::-1]) if len(out) < len(self.pack) else _packed(out[::-1])

    def encode_many(self, texts: list) -> list[bytes]:
        """The ids of whole texts. New pre-tokens are taken in byte order, so that each starts from the steps it shares
        with the one before it."""
        cut = [[pretokens(p) if not k % 2 else p for k, p in enumerate(self.vocabulary.parts(t))]
               if len(t) <= CHUNK else None for t in texts]
        known, fresh = self.known, {}
        new = {p for parts in cut if parts for pieces in parts[::2] for p in pieces if p not in known}
        before, last = b"", []
        for data in sorted(p.encode() for p in new if len(p) <= KNOWN_BYTES):
            same = 0
            while same < len(last) and same < len(data) and data[same] == before[same]:
                same += 1
            del last[same:]
            before = data
            fresh[data.decode()] = self._ids(data, last)
        if len(known) < KNOWN_TEXTS:
            known.update(fresh)
            fresh = {}
        out, get = [], fresh.get
        for text, parts in zip(texts, cut):
            if parts is None:
                out.append(self.encode(text))
                continue
            done = []
            for k, part in enumerate(parts):
                if k % 2:
                    done.append(_packed([self.vocabulary.special[part]]))
                else:
                    done += [found if (found := get(p)) is not None else known[p] for p in part] if fresh else map(known.__getitem__, part)
            out.append(b"".join(done))
        return out

    @staticmethod
    def _kind(char: str) -> str:
        return next(k for k, c in (("S", " "), ("L", "a"), ("N", "1"), ("O", "!")) if pretokens(char + c)[0] == char + c)

    def _plain(self, text: str, final: bool) -> list[bytes]:
        """Ids of a stretch without special tokens. Unless it is final, its last two pre-tokens wait for what follows
        (an apostrophe and the letters after it may still become one)."""
        out: list[bytes] = []
        if self.open:
            run = len(text)
            for place, char in enumerate(text):
                if self._kind(char) != self.kind:
                    run = place
                    break
            ends = final or run < len(text)
            keep = 0
            if self.kind == "S" and not (final and run == len(text)):
                keep = min(1, run + len(self.held))     # the last blank belongs to what follows
            body = self.held + text[:run]
            self.held, rest = body[len(body) - keep:], text[run:]
            out.append(_packed(self.open.feed(body[:len(body) - keep].encode())))
            if not ends:
                return out
            out.append(_packed(self.open.finish()))
            self.open, text, self.held = None, self.held + rest, ""
        pieces = pretokens(text)
        if final:
            return out + list(map(self.known.__getitem__, pieces))
        wait = pieces[-2:]
        out += map(self.known.__getitem__, pieces[:-2])
        self.text = "".join(wait)
        if len(self.text) > HOLD and len(wait[-1]) > HOLD // 2:
            out += map(self.known.__getitem__, wait[:-1])
            self.open, self.kind = Transducer(self.rules), self._kind(wait[-1][-1])
            self.held = wait[-1][-1] if self.kind == "S" else ""
            out.append(_packed(self.open.feed(wait[-1][:len(wait[-1]) - len(self.held)].encode())))
            self.text = ""
        return out

    def feed(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        parts = self.vocabulary.parts(self.text + text)
        self.text = ""
        out = self._parts(parts[:-1])
        tail = parts[-1]
        cut = next((k for k in range(min(len(tail), max(map(len, self.special_parts), default=0)), 0, -1)
                    if tail[-k:] in self.special_parts), 0)
        out += self._plain(tail[:len(tail) - cut], False)
        self.text += tail[len(tail) - cut:]
        return b"".join(out)

    def _parts(self, parts: list[str]) -> list[bytes]:
        out = []
        for place, part in enumerate(parts):
            out += [_packed([self.vocabulary.special[part]])] if place % 2 else self._plain(part, True)
        return out

    def finish(self) -> bytes:
        out = self._parts(self.vocabulary.parts(self.text))
        self.text, self.open = "", None
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        if len(text) <= CHUNK:
            self.text = text
            return self.finish()
        return b"".join([self.feed(text[k:k + CHUNK]) for k in range(0, len(text), CHUNK)] + [self.finish()])


class StreamDecoder:
    """Ids in, text out; bytes that are no UTF-8 become U+FFFD."""

    def __init__(self, vocabulary: Vocabulary):
        self.tokens = vocabulary.tokens
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids) -> str:
        return self.state.decode(b"".join(map(self.tokens.__getitem__, ids)))

    def finish(self) -> str:
        out = self.state.decode(b"", True)
        self.state.reset()
        return out


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


@functools.lru_cache(maxsize=4)
def merge_rules(path: str) -> MergeRules:
    return MergeRules(Vocabulary.load(path))


@functools.lru_cache(maxsize=4)
def encoder(path: str) -> StreamEncoder:
    return StreamEncoder(Vocabulary.load(path))


def encode(docs: DataFrame, path: str, text: str = "text", name: str = "ids") -> DataFrame:
    """Add column ``name`` (replacing one of that name): the ids of the whole text, little-endian unsigned 32-bit."""
    def run(texts: pa.Array) -> pa.Array:
        out = []
        for start in range(0, len(texts), 256):
            out += encoder(path).encode_many([t or "" for t in texts.slice(start, 256).to_pylist()])
        return pa.array(out, pa.binary())

    return docs.withColumn(name, F.arrow_udf(run, "binary")(F.col(text)))


def decode(frame: DataFrame, path: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """Add column ``name``: the text of the ids; null ids give the empty text."""
    def run(rows: pa.Array) -> pa.Array:
        one, out = StreamDecoder(Vocabulary.load(path)), []
        for row in rows:
            values = np.frombuffer(row.as_py() or b"", "<u4")
            parts = [one.feed(values[k:k + CHUNK].tolist()) for k in range(0, len(values), CHUNK)]
            out.append("".join([*parts, one.finish()]))
        return pa.array(out, pa.string())

    return frame.withColumn(name, F.arrow_udf(run, "string")(F.col(ids)))
