"""A byte-level BPE vocabulary file and the rules that cut text before merging.

``Vocabulary.load(path)`` reads a tokenizer file once per Python worker; nothing of it is kept in the repository."""

from __future__ import annotations

import functools
import json
import re
import unicodedata

import regex
from tokenizers.pre_tokenizers import ByteLevel

# The byte-level pre-tokenizer's pattern, and its letters, digits and blanks among the first 256 characters
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LATIN_LETTERS = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
LATIN_NUMBERS = r"0-9\xb2\xb3\xb9\xbc-\xbe"
LATIN_BLANKS = r"\x09-\x0d\x20\x85\xa0"

_any = regex.compile(PATTERN)
_latin = re.compile(PATTERN.replace(r"[^\s\p{L}\p{N}]", f"[^{LATIN_BLANKS}{LATIN_LETTERS}{LATIN_NUMBERS}]")
                    .replace(r"\p{L}", f"[{LATIN_LETTERS}]").replace(r"\p{N}", f"[{LATIN_NUMBERS}]")
                    .replace(r"(?!\S)", f"(?![^{LATIN_BLANKS}])").replace(r"\s", f"[{LATIN_BLANKS}]"))
_beyond_latin = re.compile(r"[^\x00-\xff]")

KNOWN_PIECES = 400_000    # pre-tokens a worker remembers; others are merged anew
KNOWN_BYTES = 64          # only pre-tokens up to this size are remembered


@functools.lru_cache(maxsize=1 << 16)
def _unassigned(char: str) -> bool:
    return unicodedata.category(char) == "Cn"


@functools.lru_cache(maxsize=1)
def _library_cut():
    return ByteLevel(add_prefix_space=False, use_regex=True)


def pretokens(text: str) -> list[str]:
    """The pre-tokens of a text without special tokens. Libraries differ in which of the newest characters they know as
    letters; a text that holds one is cut by the tokenizer library itself."""
    if not _beyond_latin.search(text):
        return _latin.findall(text)
    if any(map(_unassigned, set(text))):
        return [text[a:b] for _, (a, b) in _library_cut().pre_tokenize_str(text)]
    return _any.findall(text)


def byte_symbols() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable Latin-1 stands for itself, the
    others follow from 256 on in their order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in plain else next(rest)) for b in range(256)]


class Vocabulary:
    """``tokens``: bytes by id. ``merges``: (left id, right id) to (rank, merged id), in rank order. ``special``: text to
    id of the added tokens, which are cut out before anything else."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        model, before = data["model"], data["pre_tokenizer"]
        if (model["type"], before["type"], data["normalizer"]) != ("BPE", "ByteLevel", None) or before["add_prefix_space"] \
                or not before.get("use_regex", True) or model.get("ignore_merges") or model.get("dropout"):
            raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
        self.path = path
        byte_of = {c: b for b, c in enumerate(byte_symbols())}
        ids = model["vocab"]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in data["added_tokens"]):
            raise ValueError("added tokens with own matching rules are not handled")
        size = 1 + max([*ids.values(), *self.special.values()])
        self.tokens: list[bytes] = [b""] * size
        for text, i in ids.items():
            self.tokens[i] = bytes(byte_of[c] for c in text)
        for text, i in self.special.items():
            self.tokens[i] = text.encode()
        self.byte_ids = [ids[c] for c in byte_symbols()]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.merges = {(ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    @staticmethod
    @functools.lru_cache(maxsize=4)
    def load(path: str) -> Vocabulary:
        return Vocabulary(path)

    def parts(self, text: str) -> list[str]:
        """Plain stretches at even places, special tokens at odd ones."""
        return self.cut.split(text) if self.cut else [text]


class Pieces(dict):
    """Values by pre-token, computed on demand and remembered up to a fixed number."""

    def __init__(self, compute):
        super().__init__()
        self.compute = compute

    def __missing__(self, piece: str):
        value = self.compute(piece)
        if len(self) < KNOWN_PIECES and len(piece) <= KNOWN_BYTES:
            self[piece] = value
        return value
