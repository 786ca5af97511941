"""Batch prompt building, routing, scoring and voting.

A question row carries its five strategies in an array, so nothing is crossed with anything and
most of the work needs no shuffle."""

import re
from functools import reduce
from itertools import product
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from querywright.functions import templates as tpl
from querywright.functions.sqltext import (DEFAULT_CATEGORIES, DEFAULT_TYPE, QUESTION_CATEGORIES, QUESTION_TYPES, col, contains_any,
                                           count_contained, normalise, occurrences, question_categories, text)
from querywright.scale import spread, top_k

# Word lists and weights of routing and scoring.
ROUTE_INDICATORS = (
    "average", "more than", "less than", "compare", "ratio", "between", "join", "across", "relationship", "combined",
    "multiple tables", "monthly", "yearly", "trend", "over time", "period", "growth", "classify", "categorize", "based on",
    "if", "when", "where")
ROUTES = (
    ("least_to_most", ("and", "or", "both", "either", "multiple", "various")),
    ("chain_of_thought", ("why", "how", "explain", "reason", "analyze", "breakdown")),
    ("self_consistency", ("best", "optimal", "most", "top", "highest", "lowest")),
    ("few_shot", ("show", "list", "find", "get", "what", "which", "who")),
)
DEFAULT_ROUTE = "chain_of_thought"
BUSINESS_TERMS = ("customer", "order", "product", "payment", "delivery", "category", "revenue")
HARD_INDICATORS = ("average", "compare", "multiple", "join", "across", "trend", "classify")
OVERALL_WEIGHTS = {"prompt_quality": 0.3, "business_relevance": 0.25, "complexity_handling": 0.25}
PARSABILITY = 0.8 * 0.2


def fill(template: str, values: dict) -> Column:
    """A text with ``{name}`` places as one concatenation; other braces stay as they are."""
    pieces = re.split("(" + "|".join(re.escape("{" + n + "}") for n in values) + ")", template)
    return F.concat(*[values[p[1:-1]] if p[1:-1] in values and p.startswith("{") else F.lit(p) for p in pieces if p])


def _example_text(picked) -> str:
    out = ""
    for number, (category, question, sql, explanation, complexity) in enumerate(picked, 1):
        out += (tpl.EXAMPLE.replace("{number}", str(number)).replace("{category}", category).replace("{complexity}", complexity)
                .replace("{question}", question).replace("{sql}", sql).replace("{explanation}", explanation))
    return out


def example_choices(question) -> list:
    """(condition, text) of up to three built-in examples per pair of categories; the last has no condition."""
    def pick(pair):
        order = sorted(range(len(tpl.EXAMPLES)), key=lambda i: (
            pair.index(tpl.EXAMPLES[i][0]) if tpl.EXAMPLES[i][0] in pair else len(pair), i))
        return _example_text([tpl.EXAMPLES[i] for i in order[:3]])

    q = F.lower(text(question))
    return [(contains_any(q, hints), pick(pair)) for pair, hints in QUESTION_CATEGORIES] + [(None, pick(DEFAULT_CATEGORIES))]


def type_choices(question) -> list:
    """(condition, name) of the question types, as ``question_type`` tells them."""
    q = F.lower(text(question))
    return [(contains_any(q, hints), name) for name, hints in QUESTION_TYPES] + [(None, DEFAULT_TYPE)]


CHOICES = {"examples": example_choices, "complexity_type": type_choices}


def chosen(choices, values=None) -> Column:
    """The text of the first choice that holds (or its entry in ``values``)."""
    out = F
    for (test, value), place in zip(choices, range(len(choices))):
        value = F.lit(value if values is None else values[place])
        out = out.when(test, value) if test is not None else (out.otherwise(value) if len(choices) > 1 else value)
    return out


class Strategy:
    """A way to prompt: ``render(question, schema)`` gives the prompt column. ``schema`` maps a
    style (typed, keys, graph) to its text."""

    def __init__(self, name, template, style):
        self.name, self.template, self.style = name, template, style

    def render(self, question: Column, schema: dict) -> Column:
        return fill(self.template, {"question": question, "schema": F.lit(schema[self.style]),
                                    **{n: chosen(made(question)) for n, made in CHOICES.items()}})

    def variants(self, question: Column, schema: dict) -> list:
        """[({choice: place}, literal texts around the questions)]: the prompt for every outcome of its choices."""
        names = [n for n in CHOICES if "{" + n + "}" in self.template]
        pieces = re.split("(" + "|".join(re.escape("{" + n + "}") for n in ("question", "schema", *CHOICES)) + ")", self.template)
        out = []
        for places in product(*[range(len(CHOICES[n](question))) for n in names]):
            known = {"{schema}": schema[self.style],
                     **{"{" + n + "}": CHOICES[n](question)[k][1] for n, k in zip(names, places)}}
            texts = [""]
            for piece in pieces:
                if piece == "{question}":
                    texts.append("")
                else:
                    texts[-1] += known.get(piece, piece)
            out.append((dict(zip(names, places)), texts))
        return out


class Seams:
    """A prompt that is searched without being built. Its constant texts are searched while the plan is made; per row only
    the question is, with as much of the constant text around it as a word can reach over a joint. Tests of the question
    are shared by all strategies: ``tests`` maps their columns to expressions, to be added to the rows first."""

    def __init__(self, variants, tests: dict, question: Column, lowered: bool):
        self.variants, self.tests, self.question, self.lowered = variants, tests, question, lowered
        if lowered:
            self.variants = [(places, [t.lower() for t in texts]) for places, texts in variants]

    def _per_variant(self, values):
        """A value by variant; equal values are one. Null for a null question, as the prompt is."""
        if len(set(values)) == 1:
            out = F.lit(values[0])
        else:
            out = F
            for (places, _), value in zip(self.variants, values):
                test = reduce(and_, [F.col(f"_{n}") == k for n, k in places.items()])
                out = out.when(test, F.lit(value))
        return F.when(self.question.isNotNull(), out)

    def _asked(self, word, before="", after="") -> Column:
        key = (word, before, after, self.lowered)
        if key not in self.tests:
            q = F.lower(self.question) if self.lowered else self.question
            self.tests[key] = (f"_t{len(self.tests)}", (F.concat(F.lit(before), q, F.lit(after)) if before or after else q).contains(word))
        return F.col(self.tests[key][0])

    def contains(self, word: str) -> Column:
        known = [any(word in t for t in texts) for _, texts in self.variants]
        if all(known):
            return self._per_variant(known)
        reach = len(word) - 1
        joints = set()
        for (_, texts), found in zip(self.variants, known):
            if not found:
                for left, right in zip(texts, texts[1:]):
                    left, right = left[-reach:] if reach else "", right[:reach]
                    touched = any(word.startswith(left[k:]) for k in range(len(left))) or any(word.endswith(right[:k]) for k in range(1, len(right) + 1))
                    joints.add((left, right) if touched else ("", ""))
        # a joint of one variant must not count for another: such words are rare, and searched in each by itself
        if joints - {("", "")} and len(self.variants) > 1:
            out = F
            for place, texts in self.variants:
                one = Seams([({}, texts)], self.tests, self.question, False)
                one.lowered = self.lowered
                out = out.when(reduce(and_, [F.col(f"_{n}") == k for n, k in place.items()]), one.contains(word))
            return out
        asked = reduce(or_, [self._asked(word, *j) for j in sorted(joints)])
        return self._per_variant(known) | asked if any(known) else asked

    def length(self) -> Column:
        return self._per_variant([sum(map(len, t)) for _, t in self.variants]) + F.length(self.question) * (len(self.variants[0][1]) - 1)

    def has_paragraphs(self, n: int) -> bool:
        """Whether the constant texts alone hold n blank lines; joints can only add some."""
        return all(sum(t.count("\n\n") for t in texts) >= n for _, texts in self.variants)


LONGEST_WORD = 32  # constant texts between two questions are longer, so no word spans both joints


def seamed(strategy, question: Column, schema: dict):
    """The variants of a strategy that can be searched by its seams, or None."""
    if not hasattr(strategy, "variants"):
        return None
    variants = strategy.variants(question, schema)
    able = all(len(t) > 1 and all(len(x) > LONGEST_WORD for x in t[1:-1]) and len(t) == len(variants[0][1]) for _, t in variants)
    return variants if able else None


_STYLES = {"zero_shot": "typed", "chain_of_thought": "typed", "few_shot": "keys", "self_consistency": "graph",
           "least_to_most": "graph"}
REGISTRY = {name: Strategy(name, tpl.TEMPLATES[name], _STYLES[name]) for name in tpl.STRATEGIES}


def register_strategy(strategy) -> None:
    REGISTRY[strategy.name] = strategy


def get_strategy(name: str):
    if name not in REGISTRY:
        raise ValueError(f"Unknown strategy: {name}")
    return REGISTRY[name]


def with_prompts(questions: DataFrame, schema: dict, strategies=tpl.STRATEGIES, question: str = "question") -> DataFrame:
    """Add ``strategies``: an array of (ordinal, strategy, prompt), one entry per strategy."""
    cells = [F.struct(F.lit(i).alias("ordinal"), F.lit(s).alias("strategy"),
                      get_strategy(s).render(F.col(question), schema).alias("prompt")) for i, s in enumerate(strategies)]
    return spread(questions).withColumn("strategies", F.array(*cells))


def render_prompts(questions: DataFrame, schema: dict, strategies=tpl.STRATEGIES, question: str = "question") -> DataFrame:
    """One row per question and strategy."""
    rows = with_prompts(questions, schema, strategies, question)
    return rows.select(*questions.columns, F.explode("strategies").alias("_s")).select(*questions.columns, "_s.*")


def select_examples(questions: DataFrame, examples: DataFrame, k: int = 3, question: str = "question") -> DataFrame:
    """Up to k examples per question from a table (ordinal, category, ...): the question's first
    category, then its second, then any, each in table order.

    Examples are ranked per pair of categories (there are five), not per question."""
    pairs = [p for p, _ in QUESTION_CATEGORIES] + [DEFAULT_CATEGORIES]
    pair_rows = F.array(*[F.struct(F.lit(",".join(p)).alias("pair"), F.lit(c).alias("category"), F.lit(i).alias("priority"))
                          for p in dict.fromkeys(pairs) for i, c in enumerate(p)])
    one = questions.sparkSession.range(0, 1, 1, 1)
    wanted = one.select(F.explode(pair_rows).alias("p")).select("p.*")
    by_category = top_k(examples, ["category"], ["ordinal"], k, keep_rank=False)
    matched = by_category.join(F.broadcast(wanted), "category")
    # whatever the category: the first k of the table, or k more when those were matched already
    spare = examples.orderBy("ordinal").limit(3 * k)
    every_pair = F.array(*[F.lit(",".join(p)) for p in dict.fromkeys(pairs)])
    rest = spare.select("*", F.explode(every_pair).alias("pair")).withColumn("priority", F.lit(2))
    pool = matched.select("pair", "ordinal", "priority").unionByName(rest.select("pair", "ordinal", "priority"))
    pool = pool.groupBy("pair", "ordinal").agg(F.min("priority").alias("priority"))
    best = top_k(pool, ["pair"], ["priority", "ordinal"], k)
    ids = best.groupBy("pair").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "ordinal"))), lambda x: x["ordinal"]).alias("examples"))
    asked = questions.withColumn("pair", F.array_join(question_categories(question), ","))
    return asked.join(F.broadcast(ids), "pair").drop("pair")


def route(question, word: bool = False) -> Column:
    """Strategy for a question: many complexity indicators first, then the first list that hits.
    Words match inside other words ('order' holds 'or') unless ``word``."""
    q = F.lower(text(question))
    if word:
        indicators = sum((q.rlike(rf"\b{w}\b").cast("int") for w in ROUTE_INDICATORS), F.lit(0))
    else:
        indicators = count_contained(q, ROUTE_INDICATORS)
    out = F.when(indicators >= 3, "least_to_most")
    for name, hints in ROUTES:
        out = out.when(contains_any(q, hints, word), name)
    return out.otherwise(DEFAULT_ROUTE)


def _points(*rules) -> Column:
    """Sum of (test, points) in order, at most 1."""
    total = F.lit(0.0)
    for test, points in rules:
        total = total + F.when(test, F.lit(points)).otherwise(F.lit(0.0))
    return F.least(total, F.lit(1.0))


def prompt_quality(low) -> Column:
    """Five checks on the lower-cased prompt."""
    p = col(low)
    return _points((p.contains("json"), 0.2), (contains_any(p, ("example", "template")), 0.2),
                   (p.contains("schema") & p.contains("table"), 0.2), (contains_any(p, ("step", "process", "framework")), 0.2),
                   (contains_any(p, ("e-commerce", "business", "customer", "order")), 0.2))


def business_relevance(low) -> Column:
    p = col(low)
    terms = F.least(count_contained(p, BUSINESS_TERMS) * F.lit(0.15), F.lit(0.6))
    more = F.when(contains_any(p, ("business", "analysis", "metrics", "performance")), F.lit(0.2)).otherwise(F.lit(0.0))
    domain = F.when(contains_any(p, ("brazilian", "olist")), F.lit(0.2)).otherwise(F.lit(0.0))
    return F.least(terms + more + domain, F.lit(1.0))


def hard_words(question) -> Column:
    return count_contained(F.lower(text(question)), HARD_INDICATORS)


def complexity_handling(low, length, level) -> Column:
    """Guidance for hard questions (two hard words or more), brevity and an example for easy ones."""
    p, length, level = col(low), col(length), col(level)
    zero = F.lit(0.0)
    hard = (F.lit(0.5) + F.when(contains_any(p, ("decompose", "break down", "step by step")), F.lit(0.3)).otherwise(zero)
            + F.when(contains_any(p, ("sub-question", "sub-problem", "component")), F.lit(0.2)).otherwise(zero))
    easy = (F.lit(0.5) + F.when(length < 1000, F.lit(0.3)).otherwise(zero)
            + F.when(p.contains("example"), F.lit(0.2)).otherwise(zero))
    return F.least(F.when(level >= 2, hard).otherwise(easy), F.lit(1.0))


def prompt_structure(prompt) -> Column:
    p = col(prompt)
    return _points((paragraphs(p), 0.3), (p.contains("{") & p.contains("}"), 0.2),
                   (p.contains("Question:"), 0.2), (p.contains("Schema"), 0.3))


def paragraphs(p) -> Column:
    return p.question.isNotNull() if isinstance(p, Seams) else occurrences(p, "\n\n") >= 2


def overall(quality: Column, business: Column, handling: Column) -> Column:
    w = OVERALL_WEIGHTS
    return (quality * w["prompt_quality"] + business * w["business_relevance"] + handling * w["complexity_handling"]
            + F.lit(PARSABILITY))


def scored_strategies(questions: DataFrame, schema: dict, question: str = "question", strategies=tpl.STRATEGIES) -> DataFrame:
    """Add ``scores``: an array of (ordinal, strategy, overall_score, parts, prompt_length).

    A prompt is its constant text around the question: the constant text is searched while the plan is made, the question
    once per word. A strategy without such seams has its prompt rendered, in a column of its own."""
    rows = spread(questions).withColumns({"_level": hard_words(question), **{
        f"_{n}": chosen(made(question), range(len(made(question)))) for n, made in CHOICES.items()}})
    tests, rendered, parts = {}, {}, {}
    for i, name in enumerate(strategies):
        strategy = get_strategy(name)
        variants = seamed(strategy, F.col(question), schema)
        if variants:
            prompt = Seams(variants, tests, F.col(question), False)
            low, length = Seams(variants, tests, F.col(question), True), prompt.length()
            if not prompt.has_paragraphs(2):
                variants = None
        if not variants:
            rendered[f"_p{i}"] = strategy.render(F.col(question), schema)
            prompt, low, length = F.col(f"_p{i}"), F.col(f"_l{i}"), F.length(f"_p{i}")
        parts |= {f"_a{i}": prompt_quality(low), f"_b{i}": business_relevance(low),
                  f"_c{i}": complexity_handling(low, length, F.col("_level")), f"_d{i}": prompt_structure(prompt),
                  f"_n{i}": length.cast("long")}
    rows = rows.withColumns({**{n: test for n, test in tests.values()}, **rendered})
    rows = rows.withColumns({f"_l{n[2:]}": F.lower(n) for n in rendered}).withColumns(parts)
    scores = [F.struct(
        F.lit(i).alias("ordinal"), F.lit(name).alias("strategy"), overall(F.col(f"_a{i}"), F.col(f"_b{i}"), F.col(f"_c{i}")).alias("overall_score"),
        F.col(f"_a{i}").alias("prompt_quality"), F.col(f"_b{i}").alias("business_relevance"), F.col(f"_c{i}").alias("complexity_handling"),
        F.col(f"_d{i}").alias("prompt_structure"), F.col(f"_n{i}").alias("prompt_length")) for i, name in enumerate(strategies)]
    return rows.select(*questions.columns, F.array(*scores).alias("scores"))


def score_rows(questions: DataFrame, schema: dict, question: str = "question") -> DataFrame:
    scored = scored_strategies(questions, schema, question)
    # outer: the inner form makes Catalyst compute the array twice, to test that it is not empty
    return scored.select(*questions.columns, F.explode_outer("scores").alias("s")).select(*questions.columns, "s.*")


def benchmark(questions: DataFrame, schema: dict, question: str = "question") -> DataFrame:
    """Averages per strategy, ranked."""
    rows = score_rows(questions, schema, question)
    per = rows.groupBy("strategy").agg(
        F.avg("overall_score").alias("average_overall_score"), F.avg("prompt_quality").alias("average_prompt_quality"),
        F.avg("business_relevance").alias("average_business_relevance"),
        F.avg("complexity_handling").alias("average_complexity_handling"), F.count(F.lit(1)).alias("total_questions_evaluated"),
        F.min("ordinal").alias("_o"))
    w = Window.orderBy(F.round("average_overall_score", 9).desc(), "_o")  # one row per strategy
    return per.withColumn("rank", F.row_number().over(w)).drop("_o")


def recommend(questions: DataFrame, schema: dict, question: str = "question") -> DataFrame:
    """Routed and best-scored strategy (the first on ties), the score and whether they agree."""
    scored = scored_strategies(questions, schema, question)
    best = F.array_max(F.transform("scores", lambda s: F.named_struct(
        F.lit("score"), s["overall_score"], F.lit("late"), -s["ordinal"], F.lit("strategy"), s["strategy"])))
    return (scored.withColumn("_b", best).withColumn("auto_selected", route(question))
            .select(*questions.columns, "auto_selected", F.col("_b.strategy").alias("best_evaluated"),
                    F.col("_b.score").alias("confidence"), (F.col("auto_selected") == F.col("_b.strategy")).alias("agreement")))


def usage(recommended: DataFrame) -> DataFrame:
    """Questions per recommended strategy, with the most recommended one."""
    counts = recommended.groupBy(F.col("best_evaluated").alias("strategy")).agg(F.count(F.lit(1)).alias("n"))
    top = counts.agg(F.min_by("strategy", F.struct((-F.col("n")).alias("x"), "strategy"))).scalar()
    return counts.withColumn("most_recommended", F.col("strategy") == top)


def confidence_band(c) -> Column:
    return F.when(col(c) > 0.8, "high").when(col(c) > 0.5, "medium").otherwise("low")


def side_by_side(df: DataFrame, key: str, strategy: str, answer: str, confidence: str, names) -> DataFrame:
    """One row per question: each strategy's most confident answer and its band."""
    best = [F.max(F.when(F.col(strategy) == n, F.struct(F.col(confidence).alias("c"), F.col(answer).alias("a")))).alias(f"_{n}")
            for n in names]
    wide = df.groupBy(key).agg(*best)
    cells = [x for n in names for x in (
        F.col(f"_{n}.a").alias(f"{n}_answer"), F.col(f"_{n}.c").alias(f"{n}_confidence"),
        F.when(F.col(f"_{n}").isNotNull(), confidence_band(f"_{n}.c")).alias(f"{n}_band"))]
    return wide.select(key, *cells)


def majority_vote(samples: DataFrame, key: str, sql: str, confidence: str, weight: Column | None = None) -> DataFrame:
    """The statement (normalised) with most votes per question; ties go to the higher confidence,
    then to the smaller text. ``weight`` replaces one vote per sample by a score."""
    votes = samples.groupBy(key, normalise(sql).alias("sql")).agg(
        F.sum(F.lit(1) if weight is None else weight).alias("votes"), F.max(confidence).alias("confidence"))
    order = [F.col("votes").desc() if weight is None else F.round("votes", 9).desc(), F.desc("confidence"), F.asc("sql")]
    return top_k(votes, [key], order, 1, keep_rank=False)


# Weights of syntax, logic, efficiency and business relevance in a weighted vote.
VOTE_WEIGHTS = (0.3, 0.3, 0.2, 0.2)


def weighted_score(*criteria) -> Column:
    return sum((col(c) * w for c, w in zip(criteria, VOTE_WEIGHTS)), F.lit(0.0))


def best_answers(df: DataFrame, key: str, confidence: str, success: str, ordinal: str, keep) -> DataFrame:
    """Per question the most confident successful answer; ties keep the first, zero never wins."""
    good = df.filter(F.col(success) & (F.col(confidence) > 0))
    best = F.max(F.struct(F.col(confidence).alias("_c"), (-F.col(ordinal)).alias("_o"), *keep))
    return good.groupBy(key).agg(best.alias("_b")).select(key, F.col("_b._c").alias(confidence), *[f"_b.{k}" for k in keep])

