"""Prompt queries: every user turn and one business question per order."""

from pyspark.sql import functions as F

from querywright.functions.sqltext import question_categories
from querywright.operators import prompts as p
from querywright.plans.fixtures import eval_rows, qa_pairs, responses, sql_pairs, user_questions
from querywright.functions.responses import parse_responses
from querywright.plans.profiles import rounded

SCHEMA = {
    "typed": "- customer: c_custkey(BIGINT), c_name(VARCHAR)\n- orders: o_orderkey(BIGINT), o_custkey(BIGINT), o_totalprice(DOUBLE)",
    "keys": "Available Tables:\n  customer(c_custkey:BIGINT (PK), c_name:VARCHAR)\n  orders(o_orderkey:BIGINT (PK), o_custkey:BIGINT, o_totalprice:DOUBLE)",
    "graph": "orders.o_custkey → customer.c_custkey",
}
SCORES = ("overall_score", "prompt_quality", "business_relevance", "complexity_handling", "prompt_structure")
TECHNIQUES = ("click", "error", "purchase", "signup", "view")


def entries(t):
    """Five consecutive events are the answers to one question."""
    return eval_rows(t).withColumn("entry", F.floor(F.col("question_id") / 5))


def prm01(t):
    rows = p.render_prompts(user_questions(t), SCHEMA)
    return rows.select("qid", "strategy", F.md5("prompt").alias("prompt_md5"), F.length("prompt").cast("long").alias("length"))


def prm02(t):
    examples = qa_pairs(t).select(F.col("pair_id").alias("ordinal"), question_categories("question")[0].alias("category"))
    picked = p.select_examples(user_questions(t), examples)
    return picked.select("qid", F.array_join(F.transform("examples", lambda x: x.cast("string")), ",").alias("examples"))


def prm03(t):
    return user_questions(t).select("qid", p.route("question").alias("strategy"), p.route("question", word=True).alias("strategy_word"))


def prm_scores(t):
    return p.score_rows(user_questions(t), SCHEMA).drop("question", "ordinal")


def prm04(t):
    return rounded(prm_scores(t).select("qid", "strategy", "prompt_quality"), "prompt_quality")


def prm05(t):
    return rounded(prm_scores(t).select("qid", "strategy", "business_relevance"), "business_relevance")


def prm06(t):
    return rounded(prm_scores(t).select("qid", "strategy", "complexity_handling"), "complexity_handling")


def prm07(t):
    return rounded(prm_scores(t).select("qid", "strategy", "prompt_structure", "prompt_length"), "prompt_structure")


def prm08(t):
    return rounded(prm_scores(t).select("qid", "strategy", "overall_score"), "overall_score")


def prm09(t):
    out = p.benchmark(user_questions(t), SCHEMA).withColumn("rank", F.col("rank").cast("long"))
    return rounded(out, *[c for c in out.columns if c.startswith("average_")])


def prm10(t):
    return rounded(p.recommend(user_questions(t), SCHEMA).drop("question"), "confidence")


def prm11(t):
    return p.usage(p.recommend(user_questions(t), SCHEMA))


def prm12(t):
    return p.side_by_side(entries(t).withColumn("answer", F.col("question_id").cast("string")), "entry", "technique",
                          "answer", "confidence_score", TECHNIQUES)


def prm13(t):
    samples = sql_pairs(t).select(F.floor(F.col("question_id") / 6).alias("qid"), F.col("pred_sql").alias("sql"),
                                  ((F.col("question_id") % 10) / 10).alias("confidence"))
    return p.majority_vote(samples, "qid", "sql", "confidence")


def prm13_weighted(t):
    """Criteria scores come from digits of the order key."""
    k = F.col("question_id")
    samples = sql_pairs(t).select(F.floor(k / 6).alias("qid"), F.col("pred_sql").alias("sql"), ((k % 10) / 10).alias("confidence"),
                                  ((k % 7) / 7).alias("c1"), ((k % 3) / 3).alias("c2"), ((k % 5) / 5).alias("c3"), ((k % 2) / 2).alias("c4"))
    return rounded(p.majority_vote(samples, "qid", "sql", "confidence", p.weighted_score("c1", "c2", "c3", "c4")), "votes")


def prm13_answers(t):
    """Vote over parsed model answers."""
    parsed = parse_responses(responses(t)).withColumn("qid", F.floor(F.col("question_id") / 35))
    return rounded(p.majority_vote(parsed, "qid", "sql", "confidence"), "confidence")


def prm14(t):
    rows = entries(t).withColumn("success", F.col("error_message").isNull())
    return p.best_answers(rows, "entry", "confidence_score", "success", "question_id", ["technique"])


PLANS = {name[:5].upper() + name[5:]: f for name, f in list(globals().items())
         if callable(f) and name.startswith("prm") and name[3:5].isdigit()}
