"""Prompt queries in SQL."""

import re

from oracle.fixtures import with_
from oracle.scoring import CATEGORIES, categories, like_any, norm, parsed, question_type, LAST
from querywright.functions import templates as tpl
from querywright.plans.prompting import SCHEMA, TECHNIQUES


def lit(s):
    return "'" + s.replace("'", "''") + "'"


def _examples(pair):
    cats = pair.split(",")
    order = [e for c in cats for e in tpl.EXAMPLES if e[0] == c]
    order = (order + [e for e in tpl.EXAMPLES if e not in order])[:3]
    return "".join(f"\nExample {i} ({c} - {x}):\nQuestion: {q}\nSQL: {s}\nExplanation: {e}\n" for i, (c, q, s, e, x) in enumerate(order, 1))


_PICK = "CASE " + " ".join(f"WHEN {like_any('lower(question)', ws)} THEN {lit(_examples(n))}" for n, ws in CATEGORIES) + f" ELSE {lit(_examples('customer_analysis,product_analysis'))} END"
_STYLE = dict(zip(tpl.STRATEGIES, ("typed", "typed", "keys", "graph", "graph")))


def prompt(name):
    parts = re.split(r"(\{question\}|\{schema\}|\{examples\}|\{complexity_type\})", tpl.TEMPLATES[name])
    known = {"{question}": "question", "{schema}": lit(SCHEMA[_STYLE[name]]), "{examples}": _PICK, "{complexity_type}": question_type("question")}
    return "concat(" + ", ".join(known.get(x, lit(x)) for x in parts if x) + ")"


PROMPTS = ("pm AS (SELECT qid, question, ordinal, strategy, prompt FROM questions, LATERAL (VALUES "
           + ", ".join(f"({i}, '{s}', {prompt(s)})" for i, s in enumerate(tpl.STRATEGIES)) + ") v(ordinal, strategy, prompt))")


def points(*rules):
    return "least(" + " + ".join(f"CASE WHEN {t} THEN {p} ELSE 0e0 END" for t, p in rules) + ", 1e0)"


def count_in(c, words):
    return "(" + " + ".join(f"CASE WHEN contains({c}, '{w}') THEN 1 ELSE 0 END" for w in words) + ")"


P, Q = "lower(prompt)", "lower(question)"
QUALITY = points((f"contains({P}, 'json')", "2e-1"), (like_any(P, ["example", "template"]), "2e-1"), (f"contains({P}, 'schema') AND contains({P}, 'table')", "2e-1"),
                 (like_any(P, ["step", "process", "framework"]), "2e-1"), (like_any(P, ["e-commerce", "business", "customer", "order"]), "2e-1"))
BUSINESS = (f"least(least({count_in(P, ['customer', 'order', 'product', 'payment', 'delivery', 'category', 'revenue'])} * 15e-2, 6e-1) "
            f"+ CASE WHEN {like_any(P, ['business', 'analysis', 'metrics', 'performance'])} THEN 2e-1 ELSE 0e0 END + CASE WHEN {like_any(P, ['brazilian', 'olist'])} THEN 2e-1 ELSE 0e0 END, 1e0)")
_LEVEL = count_in(Q, ["average", "compare", "multiple", "join", "across", "trend", "classify"])
HANDLING = (f"least(CASE WHEN {_LEVEL} >= 2 THEN 5e-1 + CASE WHEN {like_any(P, ['decompose', 'break down', 'step by step'])} THEN 3e-1 ELSE 0e0 END + CASE WHEN {like_any(P, ['sub-question', 'sub-problem', 'component'])} THEN 2e-1 ELSE 0e0 END "
            f"ELSE 5e-1 + CASE WHEN length(prompt) < 1000 THEN 3e-1 ELSE 0e0 END + CASE WHEN contains({P}, 'example') THEN 2e-1 ELSE 0e0 END END, 1e0)")
STRUCTURE = points(("len(string_split(prompt, chr(10) || chr(10))) - 1 >= 2", "3e-1"), ("contains(prompt, '{') AND contains(prompt, '}')", "2e-1"),
                   ("contains(prompt, 'Question:')", "2e-1"), ("contains(prompt, 'Schema')", "3e-1"))
SCORED = f"{PROMPTS}, s1 AS (SELECT *, {QUALITY} AS prompt_quality, {BUSINESS} AS business_relevance, {HANDLING} AS complexity_handling, {STRUCTURE} AS prompt_structure, length(prompt) AS prompt_length FROM pm), sc AS (SELECT *, prompt_quality * 3e-1 + business_relevance * 25e-2 + complexity_handling * 25e-2 + 16e-2 AS overall_score FROM s1)"

_INDICATORS = ["average", "more than", "less than", "compare", "ratio", "between", "join", "across", "relationship", "combined", "multiple tables",
               "monthly", "yearly", "trend", "over time", "period", "growth", "classify", "categorize", "based on", "if", "when", "where"]
_ROUTES = [("least_to_most", ["and", "or", "both", "either", "multiple", "various"]), ("chain_of_thought", ["why", "how", "explain", "reason", "analyze", "breakdown"]),
           ("self_consistency", ["best", "optimal", "most", "top", "highest", "lowest"]), ("few_shot", ["show", "list", "find", "get", "what", "which", "who"])]


def route(word=False):
    if word:
        n = "(" + " + ".join(f"CASE WHEN regexp_matches({Q}, '\\b{w}\\b') THEN 1 ELSE 0 END" for w in _INDICATORS) + ")"
        tests = [(s, f"regexp_matches({Q}, '\\b({'|'.join(ws)})\\b')") for s, ws in _ROUTES]
    else:
        n, tests = count_in(Q, _INDICATORS), [(s, like_any(Q, ws)) for s, ws in _ROUTES]
    return f"CASE WHEN {n} >= 3 THEN 'least_to_most' " + " ".join(f"WHEN {x} THEN '{s}'" for s, x in tests) + " ELSE 'chain_of_thought' END"


BEST = f"{SCORED}, be AS (SELECT qid, question, strategy AS best_evaluated, overall_score AS confidence FROM sc QUALIFY row_number() OVER (PARTITION BY qid ORDER BY overall_score DESC, ordinal) = 1)"
ENTRY = "en AS (SELECT *, question_id // 5 AS entry FROM eval_rows)"
_PAIRS = list(dict.fromkeys([n for n, _ in CATEGORIES] + ["customer_analysis,product_analysis"]))


def score(*names):
    return with_("questions", f"WITH {SCORED} SELECT qid, strategy, " + ", ".join(n if n == "prompt_length" else f"round({n}, 6) AS {n}" for n in names) + " FROM sc")


def vote(source, votes):
    return f"SELECT qid, sql, votes, confidence FROM (SELECT qid, {norm('sql')} AS sql, {votes} AS votes, max(confidence) AS confidence FROM {source} GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY qid ORDER BY round(votes, 9) DESC, confidence DESC, sql) = 1"


_ANSWERS = parsed(LAST)

SQL = {
    "PRM01": with_("questions", f"WITH {PROMPTS} SELECT qid, strategy, md5(prompt) AS prompt_md5, length(prompt) AS length FROM pm"),
    "PRM02": with_("questions qa_pairs", f"""
WITH ex AS (SELECT pair_id AS ordinal, string_split({categories('question')}, ',')[1] AS category FROM qa_pairs),
pr AS (SELECT unnest({_PAIRS!r}) AS pair),
rk AS (SELECT pair, ordinal, row_number() OVER (PARTITION BY pair ORDER BY CASE WHEN category = string_split(pair, ',')[1] THEN 0 WHEN category = string_split(pair, ',')[2] THEN 1 ELSE 2 END, ordinal) AS r FROM pr, ex),
pk AS (SELECT pair, string_agg(CAST(ordinal AS VARCHAR), ',' ORDER BY r) AS examples FROM rk WHERE r <= 3 GROUP BY 1)
SELECT qid, examples FROM questions JOIN pk ON pair = {categories('question')}"""),
    "PRM03": with_("questions", f"SELECT qid, {route()} AS strategy, {route(True)} AS strategy_word FROM questions"),
    "PRM04": score("prompt_quality"),
    "PRM05": score("business_relevance"),
    "PRM06": score("complexity_handling"),
    "PRM07": score("prompt_structure", "prompt_length"),
    "PRM08": score("overall_score"),
    "PRM09": with_("questions", f"WITH {SCORED}, ag AS (SELECT strategy, avg(overall_score) AS o, avg(prompt_quality) AS a, avg(business_relevance) AS b, avg(complexity_handling) AS c, count(*) AS n, min(ordinal) AS i FROM sc GROUP BY 1) SELECT strategy, round(o, 6) AS average_overall_score, round(a, 6) AS average_prompt_quality, round(b, 6) AS average_business_relevance, round(c, 6) AS average_complexity_handling, n AS total_questions_evaluated, row_number() OVER (ORDER BY round(o, 9) DESC, i) AS rank FROM ag"),
    "PRM10": with_("questions", f"WITH {BEST} SELECT qid, {route()} AS auto_selected, best_evaluated, round(confidence, 6) AS confidence, {route()} = best_evaluated AS agreement FROM be"),
    "PRM11": with_("questions", f"WITH {BEST}, us AS (SELECT best_evaluated AS strategy, count(*) AS n FROM be GROUP BY 1) SELECT strategy, n, strategy = (SELECT strategy FROM us ORDER BY n DESC, strategy LIMIT 1) AS most_recommended FROM us"),
    "PRM12": with_("eval_rows", f"WITH {ENTRY}, bs AS (SELECT entry, technique, confidence_score AS c, CAST(question_id AS VARCHAR) AS a FROM en QUALIFY row_number() OVER (PARTITION BY entry, technique ORDER BY confidence_score DESC, CAST(question_id AS VARCHAR) DESC) = 1) SELECT entry, "
                   + ", ".join(f"max(a) FILTER (technique = '{n}') AS {n}_answer, max(c) FILTER (technique = '{n}') AS {n}_confidence, max(CASE WHEN c > 0.8 THEN 'high' WHEN c > 0.5 THEN 'medium' ELSE 'low' END) FILTER (technique = '{n}') AS {n}_band" for n in TECHNIQUES) + " FROM bs GROUP BY 1"),
    "PRM13": with_("sql_pairs", "WITH sm AS (SELECT question_id // 6 AS qid, pred_sql AS sql, (question_id % 10) / CAST(10 AS DOUBLE) AS confidence FROM sql_pairs) " + vote("sm", "count(*)")),
    "PRM13_weighted": with_("sql_pairs", "WITH sm AS (SELECT question_id // 6 AS qid, pred_sql AS sql, (question_id % 10) / 10e0 AS confidence, 3e-1 * ((question_id % 7) / 7e0) + 3e-1 * ((question_id % 3) / 3e0) + 2e-1 * ((question_id % 5) / 5e0) + 2e-1 * ((question_id % 2) / 2e0) AS w FROM sql_pairs) SELECT * REPLACE (round(votes, 6) AS votes) FROM (" + vote("sm", "sum(w)") + ")"),
    "PRM13_answers": f"WITH an AS ({_ANSWERS}), sm AS (SELECT question_id // 35 AS qid, sql, confidence FROM an) SELECT * REPLACE (round(confidence, 6) AS confidence) FROM ({vote('sm', 'count(*)')})",
    "PRM14": with_("eval_rows", f"WITH {ENTRY} SELECT entry, confidence_score, technique FROM en WHERE error_message IS NULL AND confidence_score > 0 QUALIFY row_number() OVER (PARTITION BY entry ORDER BY confidence_score DESC, question_id) = 1"),
}
