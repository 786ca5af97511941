"""Aggregates over the evaluation log (technique, question_id, flags, scores, times)."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from querywright.functions import stats
from querywright.functions.sqltext import complexity, length_class, query_type, strip, text
from querywright.operators.charts import box_summary, finite
from querywright.scale import fits, guarded_corr, quantiles, rate, running_totals, union_all

INF = float("inf")

# Weights of the overall technique score.
SCORE_WEIGHTS = {
    "execution_accuracy": 0.3, "exact_match_accuracy": 0.2, "schema_compliance_rate": 0.15, "avg_bleu_score": 0.1,
    "speed": -0.1, "success_rate": 0.1, "avg_confidence": 0.05,
}
COMPLEXITIES = ("simple", "medium", "complex")
QUERY_TYPES = ("select_simple", "select_join", "select_aggregate", "insert", "update", "delete", "create", "unknown")
LENGTH_CLASSES = ("Short (<50)", "Medium (50-150)", "Long (>150)")


def ok_time() -> Column:
    return F.when(F.col("response_time") != INF, F.col("response_time"))


def calibration(confidence="confidence_score", correct="execution_correct") -> Column:
    """Correlation of confidence and correctness, not below zero; 0 when undefined."""
    r = guarded_corr(F.col(confidence), F.col(correct).cast("double"))
    return F.when(F.count(F.lit(1)) < 2, 0.0).otherwise(F.greatest(F.lit(0.0), F.coalesce(r, F.lit(0.0))))


def _headline() -> dict:
    return {"total_samples": F.count(F.lit(1)), "execution_accuracy": rate("execution_correct"),
            "exact_match_accuracy": rate("exact_match"), "schema_compliance_rate": rate("schema_compliant"),
            "average_bleu_score": F.avg("bleu_score"), "average_response_time": F.avg("response_time"),
            "average_confidence": F.avg("confidence_score"), "error_rate": rate(F.col("error_message").isNotNull())}


def headline(df: DataFrame, keys=()) -> DataFrame:
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in _headline().items()])


def _distribution(df, keys, value, probs):
    """Minimum, maximum, population deviation and quantiles per key."""
    keys = list(keys)
    basic = df.groupBy(*keys).agg(F.min(value).alias("min"), F.max(value).alias("max"), F.stddev_pop(value).alias("std"))
    q = quantiles(df, keys, value, probs)
    if keys:
        return basic.join(q, keys)
    return basic.withColumn("_q", q.select(F.struct(*probs)).scalar()).select(
        "min", "max", "std", *[F.col("_q")[p].alias(p) for p in probs])


def time_stats(df: DataFrame, keys=()) -> DataFrame:
    """Times of successful calls; zeros for a key without any."""
    s = _distribution(finite(df, "response_time"), keys, "response_time", {"median": 0.5, "p95": 0.95, "p99": 0.99})
    names = ["min", "max", "median", "std", "p95", "p99"]
    if keys:
        s = df.select(*keys).distinct().join(s, list(keys), "left")
    return s.select(*keys, *[F.coalesce(n, F.lit(0.0)).alias(n) for n in names])


def bleu_stats(df: DataFrame, keys=()) -> DataFrame:
    s = _distribution(df, keys, "bleu_score", {"median": 0.5, "p25": 0.25, "p75": 0.75})
    return s.select(*keys, *[F.coalesce(n, F.lit(0.0)).alias(n) for n in ("min", "max", "median", "std", "p25", "p75")])


def confidence_stats(df: DataFrame, keys=()) -> DataFrame:
    s = _distribution(df, keys, "confidence_score", {"median": 0.5})
    c = df.groupBy(*keys).agg(calibration().alias("calibration_score"))
    if keys:
        return s.join(c, list(keys))
    return s.withColumn("calibration_score", c.scalar())


def calibration_by(df: DataFrame, keys=()) -> DataFrame:
    return df.groupBy(*keys).agg(calibration().alias("calibration_score"))


def by_complexity(df: DataFrame, sql: str = "predicted_sql") -> DataFrame:
    """Count and accuracy per complexity class; all three classes are present."""
    seen = df.groupBy(complexity(sql).alias("complexity")).agg(
        F.count(F.lit(1)).alias("count"), rate("execution_correct").alias("accuracy"))
    classes = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in COMPLEXITIES])).alias("complexity"))
    return classes.join(seen, "complexity", "left").select(
        "complexity", F.coalesce("count", F.lit(0)).alias("count"), F.coalesce("accuracy", F.lit(0.0)).alias("accuracy"))


# Measures of a statement type; {f} takes a FILTER. A failed call adds nothing to the time but counts in its average.
TYPE_MEASURES = {
    "count": "count(*){f}",
    "execution_correct": "sum(CAST(execution_correct AS BIGINT)){f}",
    "exact_match": "sum(CAST(exact_match AS BIGINT)){f}",
    "execution_accuracy": "avg(CAST(execution_correct AS DOUBLE)){f}",
    "exact_match_accuracy": "avg(CAST(exact_match AS DOUBLE)){f}",
    "avg_bleu_score": "avg(bleu_score){f}",
    "avg_response_time": "try_divide(coalesce(sum(CASE WHEN response_time <> double('infinity') THEN response_time END){f}, 0.0D), count(*){f})",
}


def by_query_type(df: DataFrame, sql: str = "predicted_sql") -> DataFrame:
    """Measures per statement type."""
    return df.groupBy(query_type(sql).alias("query_type")).agg(
        *[F.expr(m.format(f="")).alias(n) for n, m in TYPE_MEASURES.items()])


# values of the report that are read at quantiles, and under which names
REPORT_QUANTILES = {
    "response_time": {"median": 0.5, "p95": 0.95, "p99": 0.99},
    "bleu_score": {"median": 0.5, "p25": 0.25, "p75": 0.75},
    "confidence_score": {"median": 0.5},
}


def report(df: DataFrame, sql: str = "predicted_sql", sized_by: DataFrame | None = None) -> DataFrame:
    """Everything about one log in long form (section, item, metric, value).

    Statement and complexity classes are few and known, so all measures are conditional aggregates of one pass without
    keys: each task sends one row. The quantiles belong to the same pass while the log fits one task (``sized_by`` is
    the table that bounds the log when it is itself a join); beyond that the three values take one distributed quantile
    plan together. An empty log has zeros, and no statement types."""
    rows = df.select("execution_correct", "exact_match", "schema_compliant", "bleu_score", "response_time", "confidence_score",
                     "error_message", complexity(sql).alias("_complexity"), query_type(sql).alias("_type"))
    small = fits(df if sized_by is None else sized_by)
    values = {"response_time": ok_time(), "bleu_score": F.col("bleu_score"), "confidence_score": F.col("confidence_score")}

    def spread_of(c):
        return {"min": F.min(values[c]), "max": F.max(values[c]), "std": F.stddev_pop(values[c])}

    def filtered(measures, column, item):
        where = f" FILTER (WHERE {column} = '{item}')"
        return F.expr("struct(" + ", ".join(f"double({m.format(f=where)}) AS {n}" for n, m in measures.items()) + ")")

    def together(measures):
        return F.struct(*[c.cast("double").alias(n) for n, c in measures.items()])

    class_measures = {n: TYPE_MEASURES[m] for n, m in (("count", "count"), ("accuracy", "execution_accuracy"))}
    overall = _headline()
    parts = {("overall", "all"): (overall, together(overall))}
    for section, column in (("response_time", "response_time"), ("bleu_score", "bleu_score"), ("confidence", "confidence_score")):
        measures = spread_of(column)
        if section == "confidence":
            measures["calibration_score"] = calibration()
        parts[section, "all"] = measures, together(measures)
    parts.update({("complexity", c): (class_measures, filtered(class_measures, "_complexity", c)) for c in COMPLEXITIES})
    parts.update({("query_type", c): (TYPE_MEASURES, filtered(TYPE_MEASURES, "_type", c)) for c in QUERY_TYPES})
    aggregates = [c.alias(f"{section}_{item}") for (section, item), (_, c) in parts.items()]
    if small:
        aggregates += [F.percentile(v, list(REPORT_QUANTILES[c].values())).alias(f"_{c}") for c, v in values.items()]
    one = rows.agg(*aggregates)
    if not small:
        probs = {f"q{p}".replace(".", "_"): p for p in sorted({p for q in REPORT_QUANTILES.values() for p in q.values()})}
        long = rows.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), v.alias("value")) for c, v in values.items()]))
                           .alias("c")).select("c.*")
        q = quantiles(long, ["column"], "value", probs, distributed=True)
        wide = q.agg(*[F.max(F.when(F.col("column") == c, F.array(*[F.col(f"q{p}".replace(".", "_")) for p in names.values()])))
                       .alias(f"_{c}") for c, names in REPORT_QUANTILES.items()])
        one = one.crossJoin(F.broadcast(wide))  # one row each

    cells = []
    for (section, item), (measures, _) in parts.items():
        got = {m: f"{section}_{item}.{m}" for m in measures}
        column = "confidence_score" if section == "confidence" else section
        for i, m in enumerate(REPORT_QUANTILES.get(column, ())):
            got[m] = f"get(_{column}, {i})"
        there = f"{section}_{item}.count > 0" if section == "query_type" else "true"
        zero = section in ("response_time", "bleu_score", "complexity")
        cells += [f"struct('{section}' AS section, '{item}' AS item, '{m}' AS metric, "
                  f"{f'coalesce({v}, 0.0D)' if zero else v} AS value, {there} AS there)" for m, v in got.items()]
    return one.select(F.expr(f"inline(array({', '.join(cells)}))")).filter("there").drop("there")


def metric_rows(df: DataFrame, metric: str) -> DataFrame:
    """(technique, value) of a comparable metric; failed calls have no time."""
    if metric not in ("execution_correct", "bleu_score", "response_time"):
        raise ValueError(f"unsupported metric: {metric}")
    value = F.col(metric).cast("double").alias("value")
    return (finite(df, "response_time") if metric == "response_time" else df).select("technique", value)


def _pair_table(df: DataFrame, pairs) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in pairs])
    return df.sparkSession.range(1).select(F.explode(cells).alias("p")).select("p.*")


def t_tests(df: DataFrame, pairs, metric: str = "execution_correct") -> DataFrame:
    """Pooled two-sample t-test and Cohen's d for the given technique pairs."""
    m = metric_rows(df, metric).groupBy("technique").agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"),
        F.var_samp("value").alias("var"))

    def side(s):
        return m.select(F.col("technique").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("n", "mean", "std", "var")])

    j = _pair_table(df, pairs).join(side("a"), "a").join(side("b"), "b")
    dof = F.col("n_a") + F.col("n_b") - 2
    pooled = F.sqrt(F.try_divide((F.col("n_a") - 1) * F.col("var_a") + (F.col("n_b") - 1) * F.col("var_b"), dof))
    diff = F.col("mean_a") - F.col("mean_b")
    t = F.try_divide(diff, pooled * F.sqrt(1 / F.col("n_a") + 1 / F.col("n_b")))
    d = F.when(pooled > 0, F.try_divide(diff, pooled)).otherwise(0.0)
    out = j.select("a", "b", F.lit(metric).alias("metric"), F.col("n_a").alias("sample_size_a"),
                   F.col("n_b").alias("sample_size_b"), "mean_a", "mean_b", "std_a", "std_b",
                   t.alias("t_statistic"), d.alias("cohens_d"), dof.cast("double").alias("_dof"))
    return out.withColumn("t_pvalue", stats.student_p("t_statistic", "_dof")).drop("_dof")


def mann_whitney(df: DataFrame, pairs, metric: str = "execution_correct", distributed: bool | None = None) -> DataFrame:
    """Two-sided Mann-Whitney U with mid-ranks, tie and continuity correction. Rows are counted per
    (technique, value) before pairs are formed, and ranks come from running totals."""
    rows = metric_rows(df, metric)
    if distributed is None:
        distributed = not fits(rows)
    counts = rows.groupBy("technique", "value").agg(F.count(F.lit(1)).alias("c"))
    sides = union_all([_pair_table(df, pairs).select("a", "b", F.col(s).alias("technique"), F.lit(s).alias("side"))
                       for s in ("a", "b")])
    pooled = counts.join(F.broadcast(sides), "technique").groupBy("a", "b", "value").agg(
        F.sum("c").alias("n"), F.coalesce(F.sum(F.when(F.col("side") == "a", F.col("c"))), F.lit(0)).alias("n_a"))
    ranked = running_totals(pooled, ["a", "b"], "value", distributed)
    mid = F.col("before") + (F.col("n") + 1) / 2.0
    n = F.col("n").cast("double")
    s = ranked.groupBy("a", "b").agg(F.sum(F.col("n_a") * mid).alias("r"), F.sum("n_a").cast("double").alias("n1"),
                                     F.sum("n").cast("double").alias("all"), F.sum(n * n * n - n).alias("ties"))
    n1, n2 = F.col("n1"), F.col("all") - F.col("n1")
    u1 = F.col("r") - n1 * (n1 + 1) / 2
    u = F.greatest(F.col("u_statistic"), n1 * n2 - F.col("u_statistic"))
    sigma = F.sqrt(n1 * n2 / 12 * (F.col("all") + 1 - F.try_divide(F.col("ties"), F.col("all") * (F.col("all") - 1))))
    z = F.try_divide(u - n1 * n2 / 2 - 0.5, sigma)
    out = s.withColumn("u_statistic", u1)
    return out.select("a", "b", F.lit(metric).alias("metric"), "u_statistic", z.alias("z")).withColumn(
        "u_pvalue", stats.normal_p("z"))


def significance(df: DataFrame, pairs, metric: str = "execution_correct") -> DataFrame:
    """Both tests and the flags at .05 and .01 on the smaller p."""
    both = t_tests(df, pairs, metric).join(mann_whitney(df, pairs, metric).drop("metric", "z"), ["a", "b"])
    p = F.least("t_pvalue", "u_pvalue")
    return both.withColumn("significant_at_05", p < 0.05).withColumn("significant_at_01", p < 0.01)


def technique_table(df: DataFrame) -> DataFrame:
    """One row per technique. The mean and median time count failed calls as infinite (the spread is
    then undefined); ``avg_time_ok`` is the mean of the successful ones."""
    failed = F.col("response_time") == INF
    filled = strip(text("predicted_sql")) != ""
    any_failed = F.bool_or(failed)
    strict = (F.upper(strip(text("predicted_sql"))) == F.upper(strip(text("truth_sql")))).cast("double")
    base = df.groupBy("technique").agg(
        rate("execution_correct").alias("execution_accuracy"), rate("exact_match").alias("exact_match_accuracy"),
        rate("schema_compliant").alias("schema_compliance_rate"), F.avg("bleu_score").alias("avg_bleu_score"),
        F.avg("response_time").alias("avg_response_time"),
        F.when(~any_failed, F.stddev_pop(ok_time())).alias("response_time_std"), F.avg(ok_time()).alias("avg_time_ok"),
        F.avg("confidence_score").alias("avg_confidence"), F.stddev_pop("confidence_score").alias("confidence_std"),
        rate(~failed).alias("success_rate"), F.count(F.lit(1)).alias("total_queries"),
        F.avg(F.when(text("predicted_sql") != "", F.length("predicted_sql"))).alias("prediction_length_avg"),
        F.sum(filled.cast("long")).alias("non_empty_predictions"),
        F.coalesce(guarded_corr(F.col("confidence_score"), strict), F.lit(0.0)).alias("confidence_accuracy_correlation"))
    median = quantiles(df, ["technique"], "response_time", {"median_response_time": 0.5})
    return base.join(median, "technique")


def confidence_correlation(df: DataFrame) -> DataFrame:
    strict = (F.upper(strip(text("predicted_sql"))) == F.upper(strip(text("truth_sql")))).cast("double")
    return df.groupBy("technique").agg(
        F.coalesce(guarded_corr(F.col("confidence_score"), strict), F.lit(0.0)).alias("confidence_accuracy_correlation"))


def rank_techniques(metrics: DataFrame, weights=None) -> DataFrame:
    """Weighted score, best first. Speed is already inverted and its default weight negative (kept
    from the reference); pass ``weights`` to reward fast techniques. A technique whose mean time is
    infinite is judged by its successful calls."""
    weights = {**SCORE_WEIGHTS, **(weights or {})}
    time_ = F.when(F.col("avg_response_time") == INF, F.col("avg_time_ok")).otherwise(F.col("avg_response_time"))
    timed = metrics.withColumn("_t", time_)
    slowest = timed.agg(F.max("_t")).scalar()
    scored = timed.withColumn("_max", slowest).withColumn(
        "speed", F.when(F.col("_max") > 0, 1 - F.col("_t") / F.col("_max")).otherwise(1.0))
    score = sum((F.col(c) * w for c, w in weights.items()), F.lit(0.0))
    return scored.select("technique", score.alias("score"))


def best_technique(metrics: DataFrame, weights=None) -> DataFrame:
    best = F.min_by("technique", F.struct((-F.col("score")).alias("s"), "technique"))
    return rank_techniques(metrics, weights).agg(best.alias("best_technique"), F.max("score").alias("score"))


def recommendations(metrics: DataFrame) -> DataFrame:
    """Advice lines: overall, per technique (by name), then best and fastest."""
    t = F.col("technique")
    overall = metrics.agg(F.avg("execution_accuracy").alias("acc"), F.avg("avg_response_time").alias("rt"),
                          F.min_by("technique", F.struct((-F.col("execution_accuracy")).alias("x"), "technique")).alias("best"),
                          F.min_by("technique", F.struct("avg_response_time", "technique")).alias("fast"))

    def lines(frame, section, who, texts):
        cells = F.array(*[F.struct(F.lit(i).alias("seq"), x.alias("text")) for i, x in enumerate(texts)])
        return frame.select(F.lit(section).alias("section"), who.alias("technique"), F.explode(cells).alias("c")).select(
            "section", "technique", "c.seq", "c.text").filter(F.col("text").isNotNull())

    first = lines(overall, 1, F.lit(""), [
        F.when(F.col("acc") < 0.7, "Overall accuracy is below 70%. Consider improving training data quality or model architecture."),
        F.when(F.col("rt") > 2.0, "Average response time exceeds 2 seconds. Consider model optimization or caching strategies.")])
    each = lines(metrics, 2, t, [
        F.when(F.col("execution_accuracy") < 0.6, F.format_string(
            "%s: Low accuracy (%.1f%%). Consider technique-specific improvements or parameter tuning.", t,
            F.col("execution_accuracy") * 100)),
        F.when(F.col("avg_response_time") > 3.0, F.concat(
            t, F.lit(": High response time ("), F.when(F.col("avg_response_time") == INF, "inf").otherwise(
                F.format_string("%.1f", "avg_response_time")), F.lit("s). Optimize for faster inference."))),
        F.when(F.col("avg_confidence") < 0.5, F.format_string(
            "%s: Low confidence scores (%.2f). Review confidence calibration.", t, "avg_confidence"))])
    last = lines(overall, 3, F.lit(""), [F.format_string(
        "For highest accuracy, use %s. For fastest response, use %s.", "best", "fast")])
    return union_all([first, each, last]).orderBy("section", "technique", "seq")


def leaderboard(df: DataFrame, model: str = "technique") -> DataFrame:
    h = headline(df, [model])
    return h.select(F.col(model).alias("model"), F.col("total_samples").alias("total_queries"), "execution_accuracy",
                    "exact_match_accuracy", "schema_compliance_rate", F.col("average_bleu_score").alias("avg_bleu_score"),
                    F.col("average_response_time").alias("avg_response_time"), "error_rate")


def percent(c, digits: int = 1) -> Column:
    return F.format_string(f"%.{digits}f%%", F.col(c) * 100)


def seconds(c, digits: int = 3) -> Column:
    return F.when(F.col(c) == INF, "inf").otherwise(F.format_string(f"%.{digits}f", F.col(c)))


def report_text(board: DataFrame) -> DataFrame:
    """One text block per model of a leaderboard."""
    lines = [F.concat(F.lit("Model: "), "model"),
             F.concat(F.lit("  Execution Accuracy: "), percent("execution_accuracy")),
             F.concat(F.lit("  Exact Match: "), percent("exact_match_accuracy")),
             F.concat(F.lit("  Schema Compliance: "), percent("schema_compliance_rate")),
             F.concat(F.lit("  BLEU Score: "), F.format_string("%.3f", "avg_bleu_score")),
             F.concat(F.lit("  Response Time: "), seconds("avg_response_time"), F.lit("s")),
             F.concat(F.lit("  Error Rate: "), percent("error_rate"))]
    return board.select("model", F.concat_ws("\n", *lines).alias("text"))


def strategy_aggregates(df: DataFrame) -> DataFrame:
    ok = F.col("error_message").isNull()
    return df.groupBy(F.col("technique").alias("strategy")).agg(
        rate(ok).alias("success_rate"), F.avg("confidence_score").alias("avg_confidence"),
        F.avg(ok_time()).alias("avg_execution_time"), F.avg("bleu_score").alias("avg_bleu_score"),
        rate("execution_correct").alias("execution_accuracy"), rate("schema_compliant").alias("schema_compliance_rate"),
        F.count(F.lit(1)).alias("total_questions"))


def overall_summary(strategies: DataFrame) -> DataFrame:
    """Mean of the strategy means and the best strategy by BLEU."""
    best = F.min_by("strategy", F.struct((-F.col("avg_bleu_score")).alias("b"), "strategy"))
    return strategies.agg(best.alias("best_strategy"), F.avg("success_rate").alias("avg_success_rate"),
                          F.avg("avg_bleu_score").alias("avg_bleu_score"),
                          F.avg("execution_accuracy").alias("avg_execution_accuracy"),
                          F.count(F.lit(1)).alias("total_strategies"), F.max("total_questions").alias("total_questions"))


def syntax_proxy(df: DataFrame, sql: str = "predicted_sql") -> DataFrame:
    """Share of statements with both SELECT and FROM, per technique; empty ones fail."""
    s = F.upper(text(sql))
    return df.groupBy("technique").agg(rate(s.contains("SELECT") & s.contains("FROM")).alias("execution_accuracy"))


def outcome_counts(df: DataFrame) -> DataFrame:
    """Errors vs successes and compliant vs not, in one pass."""
    outcome = F.when(F.col("error_message").isNotNull(), "Error").otherwise("Success")
    compliance = F.when(F.col("schema_compliant"), "Compliant").otherwise("Non-Compliant")
    cells = F.array(F.struct(F.lit("outcome").alias("chart"), outcome.alias("label")),
                    F.struct(F.lit("compliance").alias("chart"), compliance.alias("label")))
    return df.select(F.explode(cells).alias("c")).select("c.*").groupBy("chart", "label").agg(F.count(F.lit(1)).alias("n"))


def confusion(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """2 x 2 counts per technique, zeros included."""
    cells = [(a, b) for a in (False, True) for b in (False, True)]
    wide = df.groupBy("technique").agg(*[
        F.sum(((F.col(truth) == a) & (F.col(predicted) == b)).cast("long")).alias(f"n{i}") for i, (a, b) in enumerate(cells)])
    rows = F.array(*[F.struct(F.lit(a).alias("actual"), F.lit(b).alias("predicted"), F.col(f"n{i}").alias("n"))
                     for i, (a, b) in enumerate(cells)])
    return wide.select("technique", F.explode(rows).alias("c")).select("technique", "c.*")


def error_rate_by_length(df: DataFrame, sql: str = "predicted_sql") -> DataFrame:
    """Share of wrong statements per length class; 0 for an empty class."""
    seen = df.groupBy(length_class(sql).alias("length_class")).agg(
        F.count(F.lit(1)).alias("n"), rate(~F.col("execution_correct")).alias("error_rate"))
    classes = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in LENGTH_CLASSES])).alias("length_class"))
    return classes.join(seen, "length_class", "left").select(
        "length_class", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("error_rate", F.lit(0.0)).alias("error_rate"))


def history_confidence(df: DataFrame) -> DataFrame:
    """Confidence box per strategy over the history, errors left out."""
    return box_summary(df.filter(F.col("error_message").isNull()), "technique", "confidence_score")


def recent_history(df: DataFrame, entry: str, keep: int = 10) -> DataFrame:
    """The newest history entries with successful and total strategy runs."""
    return df.groupBy(entry).agg(
        F.max("ts").alias("ts"), F.sum(F.col("error_message").isNull().cast("long")).alias("successful"),
        F.count(F.lit(1)).alias("total")).orderBy(F.desc("ts"), F.desc(entry)).limit(keep)


def formatted_table(strategies: DataFrame) -> DataFrame:
    """Strategy aggregates as display strings."""
    return strategies.select(
        F.initcap(F.replace("strategy", F.lit("_"), F.lit(" "))).alias("strategy"),
        F.format_string("%.3f", "avg_bleu_score").alias("bleu_score"), percent("success_rate").alias("success_rate"),
        percent("execution_accuracy").alias("execution_accuracy"), percent("schema_compliance_rate").alias("schema_compliance"),
        F.format_string("%.3f", "avg_confidence").alias("avg_confidence"),
        F.format_string("%.2f", F.col("avg_execution_time") * 1000).alias("avg_time_ms"))


def cross_model(df: DataFrame) -> DataFrame:
    """Averages over the models, the best and the fastest model, and the share of good queries."""
    board = df.groupBy("technique").agg(
        rate("execution_correct").alias("acc"), rate("exact_match").alias("exact"), F.avg("bleu_score").alias("bleu"),
        rate("schema_compliant").alias("comp"), F.avg(ok_time()).alias("rt"), F.count(F.lit(1)).alias("n"),
        F.sum(F.col("error_message").isNull().cast("long")).alias("good"))
    return board.agg(
        F.avg("acc").alias("avg_execution_accuracy"), F.avg("exact").alias("avg_exact_match"), F.avg("bleu").alias("avg_bleu_score"),
        F.avg("comp").alias("avg_schema_compliance"),
        F.min_by("technique", F.struct((-F.col("acc")).alias("x"), "technique")).alias("best_model"),
        F.min_by("technique", F.struct("rt", "technique")).alias("fastest_model"),
        (F.sum("good") / F.sum("n")).alias("success_share"))


MART_MEASURES = ("bleu_score", "confidence_score")


def question_results(df: DataFrame) -> DataFrame:
    """Long form: one row per question and strategy with its best measures, however many strategies there are."""
    return df.groupBy("question_id", "technique").agg(*[F.max(c).alias(c) for c in MART_MEASURES])


def wide_results(df: DataFrame, names) -> DataFrame:
    """One row per question with a column per measure of the named strategies."""
    return df.groupBy("question_id").agg(*[
        F.max(F.when(F.col("technique") == n, F.col(c))).alias(f"{n}_{c}") for n in names for c in MART_MEASURES])


def results_mart(df: DataFrame, names=()) -> dict:
    """Tables for a dashboard: summary, per strategy, per question and strategy, and a wide table of the named ones."""
    strategies = strategy_aggregates(df)
    tables = {"summary": overall_summary(strategies), "strategies": strategies, "results": question_results(df)}
    return {**tables, "questions": wide_results(df, names)} if names else tables
