"""Quality rules as weak supervision.

Every rule looks at a whole text and votes good (1), bad (0) or abstains (null). The rules' accuracies are not given:
expectation-maximisation estimates them from how often the rules agree over the whole corpus (one set
of chances on good texts, one on bad ones). The posterior probability of good quality decides, so a text that breaks one
weak rule is kept when the stronger rules speak for it.

The corpus enters the estimation only as counts per vote pattern. There are at most 3 ** len(RULES) patterns (6,561 for
the eight rules here), whatever the size of the corpus, which bounds what is fetched and what is broadcast.

Edge cases: a null text has no words and fails the base rules; an empty table gives an empty result; repeated rows and
null ids are scored like any other row; columns of any name pass through ``keep_good`` unchanged.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from querywright.llm.words import BLANKS, windows, word_hashes

SYMBOLS = "#*$%&|<>"
BLANK_CHARS = BLANKS.decode()

FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "n_upper", "n_lower", "n_marks", "n_lines", "n_distinct", "n_function")

# Each rule: a share of two features; it votes good below ``good`` or bad from ``bad`` on, and abstains otherwise. With
# ``bad`` below ``good`` the sides are exchanged. None: the rule never casts that vote. A text without the base abstains.
RULES = (
    # name, share of, base, good, bad
    ("symbols", "n_symbols", "n_words", None, 0.10),
    ("shouting", "n_upper", "n_letters", None, 0.35),
    ("marks", "n_marks", "n_words", None, 0.20),
    ("copied_lines", "n_dup_lines", "n_lines", None, 0.50),
    ("repetition", "n_repeat_words", "n_words", 0.10, 0.30),
    ("word_length", "word_chars", "n_words", 3.5, 2.5),
    ("variety", "n_distinct", "n_words", 0.25, 0.10),
    ("function_words", "n_function", "n_words", 0.08, None),
)

# Frequent function words of four languages. Their lack is no vote.
FUNCTION_WORDS = ("the of and to in is that for with on as by at from or an be this was are it "
                  "der die und das von zu mit den ist im für des auf ein eine "
                  "le la de et les des en un du que une pour dans qui el los del y se por con para las").split()

ABSTAINS, BAD, GOOD = 0, 1, 2
PRIOR_GOOD = 0.85         # start value and prior mean of the share of good texts
# start values and prior means of (abstains, bad, good): a rule seldom calls a good text bad, and sees only some defects
ON_GOOD, ON_BAD = (0.49, 0.01, 0.50), (0.45, 0.35, 0.20)
MOST_FALSE_ALARMS = 0.02  # a rule belongs in the set only if it calls at most this share of the good texts bad
PRIOR_WEIGHT = 0.02       # weight of the priors as a share of all rows, so that every corpus size behaves alike
ROUNDS = 60


def features(text: str) -> tuple:
    """The features of one text, in the order of FEATURES."""
    return features_of([text])[0]


def features_of(texts: list) -> list[tuple]:
    texts = [t or "" for t in texts]
    out = []
    raw = [t.encode() for t in texts]
    for text, data, words in zip(texts, raw, word_hashes(raw, lower=False)):
        n = len(words)
        seen = windows(words, 3)
        repeated = 0
        if len(seen):
            _, place, count = np.unique(seen, return_inverse=True, return_counts=True)
            edge = np.zeros(n + 1, np.int64)
            twice = np.flatnonzero(count[place] > 1)
            np.add.at(edge, twice, 1)
            np.add.at(edge, twice + 3, -1)
            repeated = int((np.cumsum(edge)[:n] > 0).sum())
        lines = [x for x in text.split("\n") if x.strip(BLANK_CHARS)]
        codes = np.bincount(np.frombuffer(data, np.uint8), minlength=128)
        out.append((n, len(text) - sum(map(text.count, BLANK_CHARS)), sum(map(text.count, SYMBOLS)),
                    len(lines) - len(set(lines)), repeated, int(codes[65:91].sum()), int(codes[97:123].sum()),
                    int(codes[33] + codes[63]), len(lines), len(np.unique(words)), int(np.isin(words, _FUNCTION).sum())))
    return out


_FUNCTION = np.concatenate(word_hashes([w.encode() for w in FUNCTION_WORDS], lower=False))
_TYPE = T.StructType([T.StructField(n, T.LongType()) for n in FEATURES])


def _measure(texts: pa.Array) -> pa.Array:
    columns = [[] for _ in FEATURES]
    for start in range(0, len(texts), 256):
        for row in features_of(texts.slice(start, 256).to_pylist()):
            for column, value in zip(columns, row):
                column.append(value)
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names=list(FEATURES))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """(row, f): the whole row as a struct and its features."""
    measure = F.arrow_udf(_measure, _TYPE).asNondeterministic()  # evaluated once, whatever stands above it
    return docs.select(F.struct("*").alias("row"), measure(F.col(text)).alias("f"))


def vote(rule, f: str = "f") -> Column:
    """0 abstains, 1 bad, 2 good."""
    _, top, below, good, bad = rule
    base = F.col(f"{f}.n_upper") + F.col(f"{f}.n_lower") if below == "n_letters" else F.col(f"{f}.{below}")
    share = F.col(f"{f}.{top}") / F.when(base > 0, base)
    more_is_good = bad is None or (good is not None and good > bad)
    out = F.lit(None)
    if bad is not None:
        out = F.when(share < bad if more_is_good else share >= bad, F.lit(BAD))
    if good is not None:
        out = F.coalesce(out, F.when(share >= good if more_is_good else share < good, F.lit(GOOD)))
    return F.coalesce(out, F.lit(ABSTAINS))


def pattern(rules=RULES, f: str = "f") -> Column:
    """All votes as one number in base three."""
    code = F.lit(0)
    for rule in rules:
        code = code * 3 + vote(rule, f)
    return code.cast("int")


def base_failed(f: str = "f") -> Column:
    n = F.col(f"{f}.n_words")
    return (n < 50) | (100 * F.col(f"{f}.n_repeat_words") > 50 * n)


def fit(counts: dict[int, int], n_rules: int = len(RULES), rounds: int = ROUNDS) -> dict:
    """Class share and the rules' accuracies by expectation-maximisation over pattern counts.

    Returns ``share`` (of good texts), ``good`` and ``bad`` (chances of each rule to abstain, to vote bad and to vote good
    on good and on bad texts) and ``posterior`` for every possible pattern. The priors say which class is the good one."""
    votes = np.array(list(itertools.product(range(3), repeat=n_rules)), int).reshape(-1, n_rules)
    cast = votes[:, :, None] == np.arange(3)
    weight = np.zeros(len(votes))
    for code, n in counts.items():
        weight[code] = n
    pull = PRIOR_WEIGHT * max(weight.sum(), 1.0)
    share, good, bad = PRIOR_GOOD, np.tile(ON_GOOD, (n_rules, 1)), np.tile(ON_BAD, (n_rules, 1))

    def posterior():
        odds = math.log(share / (1 - share)) + (cast * np.log(good / bad)).sum((1, 2))
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))

    for _ in range(rounds):
        p = posterior()
        on_good, on_bad = weight * p, weight * (1 - p)
        share = (on_good.sum() + pull * PRIOR_GOOD) / (weight.sum() + pull)
        good = (np.tensordot(on_good, cast, 1) + pull * np.array(ON_GOOD)) / (on_good.sum() + pull)
        over = np.maximum(good[:, BAD] - MOST_FALSE_ALARMS, 0)
        good[:, BAD] -= over
        good[:, ABSTAINS] += over
        bad = (np.tensordot(on_bad, cast, 1) + pull * np.array(ON_BAD)) / (on_bad.sum() + pull)
    return {"share": float(share), "good": good.tolist(), "bad": bad.tolist(), "posterior": posterior().tolist()}


def _judged(rows: DataFrame, model: dict, rules) -> DataFrame:
    table = rows.sparkSession.createDataFrame(
        [(i, float(p)) for i, p in enumerate(model["posterior"])], "pattern int, posterior double")
    assert len(model["posterior"]) <= 3 ** len(rules)
    return (rows.withColumn("pattern", pattern(rules)).join(F.broadcast(table), "pattern", "left")
            .withColumn("base_failed", base_failed())
            .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= 0.5)))


def learn(rows: DataFrame, rules=RULES) -> dict:
    """Fit the model on all measured rows that the base rules leave open."""
    counts = rows.filter(~base_failed()).groupBy(pattern(rules).alias("pattern")).count()
    return fit({r["pattern"]: r["count"] for r in counts.collect()}, len(rules))  # at most 3 ** len(rules) rows


def score(rows: DataFrame, rules=RULES, model: dict | None = None) -> DataFrame:
    """Add ``pattern``, ``posterior``, ``base_failed`` and ``kept`` to measured rows."""
    return _judged(rows, model or learn(rows, rules), rules)


def keep_good(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """The rows of ``docs`` that the base rules and the posterior accept, columns unchanged. The texts are measured in
    both passes, so no copy of the corpus is written in between."""
    model = learn(measured(docs.select(text), text), rules)
    return score(measured(docs, text), rules, model).filter("kept").select("row.*")
