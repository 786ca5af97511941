"""Words of whole texts as numpy arrays of 64-bit hashes.

A word is a run of bytes other than the six ASCII blanks. Words are hashed in bulk: each byte is replaced by a random
64-bit number and the words are summed with powers of an odd base, then mixed."""

import numpy as np

BLANKS = b" \t\n\x0b\x0c\r"
PIECE = 1 << 21

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E6C63D0876A9A35)
_STEP = np.uint64(0xD1342543DE82EF95)
_NEAR = 1 << 16
_IS_BLANK = np.zeros(256, bool)
_IS_BLANK[list(BLANKS)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POW = _powers(_BASE, _NEAR)
_FAR_BASE = (_POW[-1:] * _BASE)[0]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the 64 output bits (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hash_runs(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every word of one buffer."""
    blank = np.ones(len(data) + 2, bool)
    blank[1:-1] = _IS_BLANK[data]
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    starts, ends = edges[0::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    sizes = ends - starts
    first = np.cumsum(sizes) - sizes
    place = np.arange(sizes.sum()) - np.repeat(first, sizes)
    value = _BYTE[data[np.repeat(starts, sizes) + place]] * _POW[place & (_NEAR - 1)]
    if sizes.max() > _NEAR:
        value *= _powers(_FAR_BASE, int(sizes.max()) // _NEAR + 1)[place >> 16]
    return mix(np.add.reduceat(value, first) + sizes.astype(np.uint64)), starts


def word_hashes(texts: list[bytes], lower: bool) -> list[np.ndarray]:
    """The word hashes of each text. Short texts share a buffer; a long one is cut at blanks."""
    out: list = [None] * len(texts)
    pending: list[int] = []
    filled = 0

    def flush():
        nonlocal filled
        if pending:
            data = np.frombuffer(b"\n".join(texts[i] for i in pending), np.uint8)
            hashes, starts = _hash_runs(LOWER[data] if lower else data)
            ends = np.cumsum([len(texts[i]) + 1 for i in pending])
            for i, part in zip(pending, np.split(hashes, np.searchsorted(starts, ends[:-1]))):
                out[i] = part
        pending.clear()
        filled = 0

    for i, text in enumerate(texts):
        if len(text) > PIECE:
            data, parts, at = np.frombuffer(text, np.uint8), [], 0
            while at < len(data):
                stop = min(at + PIECE, len(data))
                while stop < len(data) and not _IS_BLANK[data[stop]]:
                    more = np.flatnonzero(_IS_BLANK[data[stop:stop + PIECE]])
                    stop = stop + int(more[0]) if len(more) else min(stop + PIECE, len(data))
                piece = data[at:stop]
                parts.append(_hash_runs(LOWER[piece] if lower else piece)[0])
                at = stop
            out[i] = np.concatenate(parts)
            continue
        pending.append(i)
        filled += len(text) + 1
        if filled > PIECE:
            flush()
    flush()
    return out


def windows(words: np.ndarray, width: int) -> np.ndarray:
    """A hash for every run of ``width`` words, in order; none when there are fewer words."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k, factor in enumerate(_powers(_STEP, width)):
        total += words[k:k + n] * factor
    return mix(total)


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """The distinct windows; a shorter text counts as one window, a text without words has none."""
    if not len(words):
        return np.zeros(0, np.uint64)
    if len(words) < width:
        return mix(windows(words, len(words)) + np.uint64(len(words)))
    return np.unique(windows(words, width))
