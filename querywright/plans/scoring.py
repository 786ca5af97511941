"""SQL text, safety, evaluation and analytics queries."""

from itertools import combinations

from pyspark.sql import functions as F

from querywright.functions import responses as parse
from querywright.functions import sqltext as st
from querywright.operators import analytics as an
from querywright.operators import charts, evaluate, guard, shapes
from querywright.plans.fixtures import eval_rows, responses, sql_pairs, user_questions
from querywright.plans.profiles import rounded
from querywright.scale import union_all
from querywright.sources.tables import NAMES

TECHNIQUES = ("click", "error", "purchase", "signup", "view")
PAIRS = list(combinations(TECHNIQUES, 2))
RATES = ["execution_accuracy", "exact_match_accuracy", "schema_compliance_rate", "error_rate"]


def all_rounded(df, digits=6):
    return rounded(df, *[n for n, kind in df.dtypes if kind == "double"], digits=digits)


def log(t):
    """The evaluation log with the statements that were scored."""
    pairs = sql_pairs(t).select("question_id", "truth_sql", F.col("pred_sql").alias("predicted_sql"))
    return eval_rows(t).join(pairs, "question_id", "left")


def features(t, **columns):
    return sql_pairs(t).select("question_id", *[c.alias(n) for n, c in columns.items()])


def txt01(t):
    return features(t, normalised=st.normalise("pred_sql"))


def txt02(t):
    return features(t, tokens=F.array_join(st.tokens("pred_sql"), " "))


def txt02_documents(t):
    """Whole documents; the fingerprint keeps the answer small."""
    toks = st.tokens("text")
    return t.documents.select("doc_id", F.size(toks).cast("long").alias("n_tokens"),
                              F.md5(F.array_join(toks, " ")).alias("tokens_md5"))


def txt03(t):
    return features(t, complexity=st.complexity("pred_sql"))


def txt04(t):
    return features(t, query_type=st.query_type("pred_sql"))


def txt05(t):
    return features(t, tables=F.array_join(F.sort_array(st.referenced_tables("pred_sql")), ","))


def txt06(t):
    return features(t, length_class=st.length_class("pred_sql"))


def txt07(t):
    q = user_questions(t)
    return q.select("qid", st.question_type("question").alias("question_type"),
                    st.question_type("question", word=True).alias("question_type_word"))


def txt08(t):
    return user_questions(t).select("qid", F.array_join(st.question_categories("question"), ",").alias("categories"))


def txt09(t):
    return features(t, confidence=st.length_confidence(st.tokens("pred_sql")))


def txt10(t):
    return parse.parse_responses(responses(t)).drop("response")


def txt10_outer(t):
    return parse.parse_responses(responses(t), mode="outer").drop("response")


def txt11(t):
    return responses(t).select("question_id", "strategy", parse.fallback_sql("response", "strategy").alias("sql"))


def txt12(t):
    return parse.check_fields(responses(t)).drop("response")


def saf01(t):
    return guard.label_safe(statements(t), "sql", "keyword").drop("sql")


def saf02(t):
    return guard.label_safe(statements(t), "sql", "loose").drop("sql")


def saf03(t):
    return guard.label_safe(statements(t), "sql", "prefix").drop("sql")


def statements(t):
    """Statements to judge: predictions, some turned into writes."""
    k = F.col("question_id") % 8
    sql = (F.when(k == 1, F.concat(F.lit("DROP TABLE t; "), "pred_sql")).when(k == 2, F.lit("UPDATE t SET created_at = 1"))
           .when(k == 3, F.concat(F.lit(" with x as ("), "pred_sql", F.lit(") select * from x")))
           .when(k == 4, F.lit("CALL refresh()")).when(k == 5, F.lit("SELECT created_at FROM t"))
           .otherwise(F.col("pred_sql")))
    return sql_pairs(t).select("question_id", sql.alias("sql"))


def saf04(t):
    """Status rows of good, unsafe, failing and empty statements over the given tables."""
    from querywright.sources.tables import register_views
    register_views(t.spark, t.folder)
    cases = ("SELECT o_orderstatus, COUNT(*) AS n FROM orders GROUP BY o_orderstatus",
             "WITH big AS (SELECT * FROM lineitem WHERE l_quantity > 49) SELECT l_returnflag, COUNT(*) AS n FROM big GROUP BY 1",
             "SELECT * FROM customer", "DROP TABLE orders", "WITH a AS (SELECT 1) INSERT INTO orders SELECT * FROM a",
             "SELECT * FROM missing_table", "")
    rows = [guard.run_readonly(t.spark, sql)[0] for sql in cases]
    return union_all(rows).select("sql", "success", "row_count")


def saf05(t):
    return guard.preview(t.orders.orderBy("o_orderkey"), 100)


def evl01(t):
    return features(t, exact_match=evaluate.exact_match("pred_sql", "truth_sql"))


def evl02(t):
    a, b = st.word_set(st.normalise("pred_sql")), st.word_set(st.normalise("truth_sql"))
    return features(t, similarity=F.round(evaluate.jaccard(a, b), 6), similar=evaluate.structural_match("pred_sql", "truth_sql"))


def evl03(t):
    """Three comparisons: equal results by two routes, equal sets but different copies, different."""
    by_order = t.orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    by_key = t.orders.select("o_orderkey", "o_orderstatus").distinct().groupBy("o_orderstatus").agg(F.count("o_orderkey").alias("n"))
    flags = t.lineitem.select("l_returnflag", "l_linestatus")
    flipped = t.lineitem.select("l_linestatus", F.when(F.col("l_orderkey") % 2 == 0, F.lit("R")).otherwise(
        F.col("l_returnflag")).alias("l_returnflag"))
    cases = {"same": (by_order, by_key.select("n", "o_orderstatus")), "copies": (flags, flipped),
             "fewer": (t.orders.select("o_orderkey"), t.orders.filter("o_totalprice > 1000").select("o_orderkey"))}
    return union_all([evaluate.same_result(a, b, mode).select(F.lit(name).alias("comparison"), F.lit(mode).alias("mode"), "same")
                      for name, (a, b) in cases.items() for mode in ("set", "bag")])


def evl04(t):
    """The verdict of every statement pair, one pair per order."""
    from querywright.sources.tables import register_views
    register_views(t.spark, t.folder)
    return shapes.execution_match(t.spark, sql_pairs(t)).select("question_id", "execution_correct")


def evl05(t):
    return rounded(evaluate.with_bleu(sql_pairs(t), "pred_sql", "truth_sql").select("question_id", "bleu_score"), "bleu_score")


def evl06(t):
    return evaluate.with_bleu(sql_pairs(t), "pred_sql", "truth_sql").agg(F.round(F.avg("bleu_score"), 6).alias("mean_bleu"))


def evl07(t):
    return features(t, schema_compliant=evaluate.schema_compliant("pred_sql", NAMES))


def evl08(t):
    return sql_pairs(t).agg(F.round(F.avg(evaluate.schema_compliant("pred_sql", NAMES).cast("double")), 6).alias("compliance_rate"))


def gappy_pairs(t):
    return sql_pairs(t).withColumn("pred_sql", F.when(F.col("question_id") % 10 != 0, F.col("pred_sql")))


def evl09(t):
    return rounded(evaluate.evaluate(gappy_pairs(t), NAMES).drop("pred_sql", "truth_sql"), "bleu_score")


def evl10(t):
    """Predictions without every seventh answer against truths without every eleventh."""
    pairs = sql_pairs(t)
    predictions = pairs.filter("question_id % 7 <> 0").select("question_id", "pred_sql")
    truths = pairs.filter("question_id % 11 <> 0").select("question_id", "truth_sql")
    aligned, lonely = evaluate.align(predictions, truths, "question_id")
    return aligned.select("question_id", F.lit("aligned").alias("side")).unionByName(lonely)


def evl11(t):
    return sql_pairs(t).agg(F.round(F.avg(evaluate.simple_accuracy("pred_sql", "truth_sql").cast("double")), 6).alias("accuracy"))


def evl12(t):
    return sql_pairs(t).agg(F.round(F.avg(evaluate.exact_match("pred_sql", "truth_sql", "strict").cast("double")), 6).alias("exact_match"))


def evl13(t):
    """A lookup stands for the model; the time differs per run, so only its validity is returned."""
    timed = evaluate.timed_map(sql_pairs(t).select("question_id", "pred_sql"), str.upper, "pred_sql")
    return timed.select("question_id", "output", (F.col("response_time") >= 0).alias("timed"))


def ana01(t):
    return all_rounded(an.headline(eval_rows(t), ["technique"]))


def ana02(t):
    return all_rounded(an.time_stats(eval_rows(t), ["technique"]))


def ana03(t):
    return all_rounded(an.bleu_stats(eval_rows(t), ["technique"]))


def ana04(t):
    return all_rounded(an.confidence_stats(eval_rows(t), ["technique"]))


def ana05(t):
    return all_rounded(an.calibration_by(eval_rows(t), ["technique"]))


def ana06(t):
    return all_rounded(an.by_complexity(log(t)))


def ana07(t):
    return all_rounded(an.by_query_type(log(t)))


def ana08(t):
    return all_rounded(an.report(log(t), sized_by=t.events))  # a row of the log is an event's


def ana09(t):
    return all_rounded(an.t_tests(eval_rows(t), PAIRS, "bleu_score").drop("t_pvalue"))


def ana10(t):
    return all_rounded(an.mann_whitney(eval_rows(t), PAIRS, "response_time").drop("u_pvalue"))


def ana11(t):
    return all_rounded(an.significance(eval_rows(t), PAIRS, "response_time"))


def ana12(t):
    return all_rounded(an.technique_table(log(t)).drop("confidence_accuracy_correlation"))


def ana13(t):
    return all_rounded(an.confidence_correlation(log(t)))


def ana14(t):
    return all_rounded(an.best_technique(an.technique_table(log(t))))


def ana14_scores(t):
    return all_rounded(an.rank_techniques(an.technique_table(log(t))))


def ana15(t):
    return an.recommendations(an.technique_table(log(t)))


def ana16(t):
    return all_rounded(an.leaderboard(eval_rows(t)))


def ana17(t):
    return an.report_text(an.leaderboard(eval_rows(t)))


def ana18(t):
    return all_rounded(an.strategy_aggregates(eval_rows(t)))


def ana19(t):
    return all_rounded(an.overall_summary(an.strategy_aggregates(eval_rows(t))))


def ana20(t):
    return all_rounded(an.syntax_proxy(log(t)))


def ana21(t):
    return an.outcome_counts(eval_rows(t))


def ana22(t):
    return an.confusion(eval_rows(t), "execution_correct", "exact_match")


def ana23(t):
    return all_rounded(an.error_rate_by_length(log(t)))


def ana24(t):
    return all_rounded(an.history_confidence(eval_rows(t)))


def ana25(t):
    """A history entry holds five runs: five consecutive events."""
    return an.recent_history(eval_rows(t).withColumn("entry", F.floor(F.col("question_id") / 5)), "entry")


def ana26(t):
    return an.formatted_table(an.strategy_aggregates(eval_rows(t)))


def cht14(t):
    metrics = an.leaderboard(eval_rows(t))
    out = charts.radar_data(metrics, "model", ["execution_accuracy", "exact_match_accuracy", "schema_compliance_rate",
                                               "avg_bleu_score", "avg_response_time", "error_rate"])
    return all_rounded(out)


def cht15(t):
    return all_rounded(an.cross_model(eval_rows(t)))


def snk08(t):
    """Per-question table of the results mart."""
    return all_rounded(an.results_mart(grouped_runs(t), TECHNIQUES)["questions"])


def snk08_results(t):
    return all_rounded(an.results_mart(grouped_runs(t))["results"])


def grouped_runs(t):
    """Five consecutive events belong to one question."""
    return eval_rows(t).withColumn("question_id", F.floor(F.col("question_id") / 5))


def snk08_summary(t):
    return all_rounded(an.results_mart(eval_rows(t))["summary"])


_NAMES = ("txt", "saf", "evl", "ana", "cht", "snk")
PLANS = {name[:5].upper() + name[5:]: f for name, f in list(globals().items())
         if callable(f) and name[:3] in _NAMES and name[3:5].isdigit()}
