"""Secret scan: exact patterns, and a battery of randomness tests on the other long tokens.

Patterns give the base spans (assignments, access keys, long hexadecimal numbers). Every other token of at least SHORTEST
symbols is tested for what a generated key has and a word has not. Its encoding is inferred from its symbols (decimal,
hexadecimal, base 32, base 64), and under the uniform distribution over that alphabet three statistics are taken:

* chi-squared of the symbol counts (mean and variance are exact for any length),
* runs above and below the middle of the alphabet,
* the serial correlation of neighbouring symbols.

Their tail probabilities are combined by Fisher's rule. High means: as good as random.

False discoveries are controlled by length. Tokens of letters in one case are words by construction and serve as decoys:
the share of them that passes a bound estimates how many natural tokens pass by chance. Per length band (a factor of two),
the lowest bound is taken whose estimated share of false discoveries is at most FALSE_SHARE; since longer words pass less
often, a band uses the decoys of all bands up to its own. The share is never taken below LEAST_PASS, a fixed prior, so scarce
decoys prove nothing, and a corpus given several times over is judged as it is given once. The counts cover all documents and
fit a table of BANDS x GRID x 2 rows.

Everything is a SQL expression over the row; only those counts are shuffled.

Edge cases: a null or empty text has no spans; null ids and repeated rows are scanned like other rows; a table without
candidates calls nothing; a token of any length is tested whole, in time linear in its length; other columns pass through ``scan`` as the struct ``row``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from querywright.llm.spans import found, let
from querywright.llm.storage import settle

# The base patterns, their kinds in order, and the least length of group 2 or of the match
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")
ASSIGN_LEAST = 6

CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
SHORTEST = 20
BANDS = 16
GRID = 64
FALSE_SHARE = 0.05
LEAST_PASS = 0.02         # of the natural tokens this share is taken to pass any bound, whatever the decoys say

ALPHABETS = {
    "decimal": ("^[0-9]+$", "0123456789"),
    "hex": ("^(?:[0-9a-f]+|[0-9A-F]+)$", "0123456789abcdef"),
    "base32": ("^[A-Z2-7]+=*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    "base64": ("^[A-Za-z0-9+/_-]+=*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
}
WORD = "^(?:[a-z]+|[A-Z]?[a-z]+|[A-Z]+)$"


def base_spans(text: Column) -> Column:
    """array of (start, kind, end), kinds by number, in order."""
    def shaped(kind: int, spans: Column) -> Column:
        return F.transform(spans, lambda s: F.struct(
            s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")))

    assigned = F.filter(found(text, ASSIGN), lambda s: F.char_length(F.regexp_extract(s["value"], ASSIGN, 2)) >= ASSIGN_LEAST)
    return F.array_sort(F.concat(shaped(0, assigned), shaped(1, found(text, ACCESS)), shaped(2, found(text, HEX))))


def upper_tail(z: Column) -> Column:
    """Normal tail probability (a rational approximation with an error below 1e-7)."""
    def tail(x: Column) -> Column:
        t = 1 / (1 + 0.2316419 * x)
        poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
        return F.exp(-x * x / 2) * 0.3989422804014327 * poly
    return let(z, lambda v: F.when(v >= 0, tail(v)).otherwise(1 - tail(-v)))


def _statistics(core: Column, chars: Column) -> Column:
    """(chi, runs, serial) as standard normal values, for a string over the alphabet ``chars``. The symbols are gone through once;
    sums of whole numbers give mean, spread and lagged products, so the work is linear in the length."""
    size = F.char_length(chars).cast("double")
    zero = F.lit(0).cast("long")

    def passed(symbols: Column) -> Column:
        start = F.struct(F.lit(-1).cast("long").alias("last"), *[zero.alias(k) for k in ("changes", "ups", "sum", "squares", "lagged")])
        high = lambda x: (x * 2 >= F.char_length(chars)).cast("long")
        return F.aggregate(symbols, start, lambda acc, x: F.struct(
            x.alias("last"),
            (acc["changes"] + F.when((acc["last"] >= 0) & (high(acc["last"]) != high(x)), 1).otherwise(0)).alias("changes"),
            (acc["ups"] + high(x)).alias("ups"), (acc["sum"] + x).alias("sum"), (acc["squares"] + x * x).alias("squares"),
            (acc["lagged"] + F.when(acc["last"] >= 0, acc["last"] * x).otherwise(zero)).alias("lagged")))

    def judged(symbols: Column, t: Column) -> Column:
        n = F.size(symbols).cast("double")
        times = lambda v: F.char_length(core) - F.char_length(F.replace(core, F.substr(chars, (v + 1).cast("int"), F.lit(1)), F.lit("")))
        counts = F.aggregate(F.array_distinct(symbols), F.lit(0.0), lambda acc, v: acc + F.pow(times(v).cast("double"), F.lit(2)))
        chi = size / n * counts - n
        chi_z = (chi - (size - 1)) / F.sqrt(2 * (size - 1) * (n - 1) / n)
        ups, mean = t["ups"].cast("double"), t["sum"] / n
        spread = (t["squares"] * n - t["sum"].cast("double") * t["sum"]) / n
        ends = F.element_at(symbols, 1) + F.element_at(symbols, -1)
        lagged = t["lagged"] - mean * (2 * t["sum"] - ends) + (n - 1) * mean * mean
        expected = 2 * ups * (n - ups) / n + 1
        variance = (expected - 1) * (expected - 2) / (n - 1)
        runs_z = F.when(variance > 0, (t["changes"] + 1 - expected) / F.sqrt(variance)).otherwise(F.lit(-6.0))
        serial_z = F.when(spread > 0, (lagged / spread + 1 / n) * F.sqrt(n)).otherwise(F.lit(6.0))
        return F.struct(chi_z.alias("chi"), runs_z.alias("runs"), serial_z.alias("serial"))

    numbers = F.transform(F.split(core, ""), lambda c: (F.call_function("locate", c, chars) - 1).cast("long"))
    return let(numbers, lambda s: let(passed(s), lambda t: judged(s, t)))


def randomness(token: Column) -> Column:
    """Combined tail probability of a token: near 0 for words, spread evenly over (0, 1) for random strings."""
    core = F.translate(F.regexp_replace(token, "=+$", ""), "-_", "+/")
    kind = F.lit(None).cast("string")
    chars = F.lit(None).cast("string")
    for name, (pattern, alphabet) in reversed(ALPHABETS.items()):
        here = token.rlike(pattern)
        kind, chars = F.when(here, F.lit(name)).otherwise(kind), F.when(here, F.lit(alphabet)).otherwise(chars)
    cased = F.when(kind == "hex", F.lower(core)).otherwise(core)

    def tested(t: Column) -> Column:
        return let(_statistics(t["core"], t["chars"]), combined)

    def combined(s: Column) -> Column:
        tails = (upper_tail(s["chi"]), 2 * upper_tail(F.abs(s["runs"])), 2 * upper_tail(F.abs(s["serial"])))
        half = -sum(F.log(F.greatest(p, F.lit(1e-300))) for p in tails)
        return let(half, lambda h: F.exp(-h) * (1 + h + h * h / 2))

    made = let(F.struct(cased.alias("core"), chars.alias("chars")), tested)
    return F.when(kind.isNotNull() & (F.char_length(core) >= SHORTEST // 2), made).otherwise(F.lit(0.0))


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """(row without the text, base, tokens): base spans, and the other long tokens with length band, place of their
    probability on the grid and whether they are decoys."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.struct(*[c for c in docs.columns if c != text]).alias("row") if len(docs.columns) > 1
                       else F.struct(F.lit(None).alias("none")).alias("row"), body.alias("body"))
    rows = rows.select("row", "body", base_spans(F.col("body")).alias("base"))
    free = F.filter(found(F.col("body"), CANDIDATE), lambda t: ~F.exists(
        "base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    band = lambda t: F.least(F.floor(F.log2((t["end"] - t["start"]).cast("double"))), F.lit(BANDS - 1)).cast("int")
    tokens = F.transform(free, lambda t: F.struct(
        t["start"].alias("start"), t["end"].alias("end"), band(t).alias("band"),
        F.least(F.floor(randomness(t["value"]) * GRID), F.lit(GRID - 1)).cast("int").alias("grid"),
        t["value"].rlike(WORD).alias("decoy")))
    return rows.select("row", "base", tokens.alias("tokens"))


def bounds(rows: DataFrame, false_share: float = FALSE_SHARE) -> list[int]:
    """The lowest grid place that is called random, by length band; GRID where nothing is called."""
    counts = (rows.select(F.explode("tokens").alias("t")).groupBy("t.band", "t.grid", "t.decoy")
              .agg(F.count(F.lit(1)).alias("n")).collect())  # at most BANDS * GRID * 2 rows
    words = [[0] * GRID for _ in range(BANDS)]
    others = [[0] * GRID for _ in range(BANDS)]
    for r in counts:
        (words if r["decoy"] else others)[r["band"]][r["grid"]] += r["n"]
    out, pool = [], [0] * GRID
    for band in range(BANDS):
        pool = [a + b for a, b in zip(pool, words[band])]
        total, found_at = sum(others[band]), GRID
        for place in range(GRID - 1, 0, -1):           # place 0 is never random
            passed, called = sum(pool[place:]), sum(others[band][place:])
            share = max(passed / max(sum(pool), 1), LEAST_PASS) * total / called if called else 1.0
            if called and share <= false_share:
                found_at = place
        out.append(found_at)
    return out


def spans_of(rows: DataFrame, limits: list[int]) -> DataFrame:
    """(row, base, spans): arrays of (start, kind, end); ``spans`` has the base and the called tokens."""
    limit = F.array(*map(F.lit, limits))
    called = F.filter("tokens", lambda t: ~t["decoy"] & (t["grid"] >= F.element_at(limit, t["band"] + 1)))
    more = F.transform(called, lambda t: F.struct(
        t["start"].alias("start"), F.lit(3).alias("kind"), t["end"].alias("end")))
    return rows.select("row", "base", F.array_sort(F.concat("base", more)).alias("spans"))


def find(docs: DataFrame, text: str = "text", false_share: float = FALSE_SHARE) -> DataFrame:
    """``spans_of`` for a corpus. The scanned rows, without texts, are written once and used twice."""
    rows = settle(scan(docs, text))
    return spans_of(rows, bounds(rows, false_share))


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")
