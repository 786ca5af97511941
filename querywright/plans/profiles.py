"""Profiling, chart and cleaning queries over the given tables."""

from pyspark.sql import functions as F

from querywright.operators import charts, clean, profile
from querywright.plans.fixtures import dirty_docs, eval_rows, sql_pairs
from querywright.scale import union_all
from querywright.sources.tables import FOREIGN_KEYS, NAMES, PRIMARY_KEYS, load_report
from querywright.streaming.history import work_folder

PROFILED_SQL = "SELECT o_custkey, COUNT(*) FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY o_custkey ORDER BY 2"
METRICS = ["execution_correct", "bleu_score", "schema_compliant"]
CATALOG_KEYS = {**PRIMARY_KEYS, "dirty_docs": ["doc_id"]}


def whole_catalog(t):
    return {"dirty_docs": dirty_docs(t), **{name: getattr(t, name) for name in NAMES}}


def rounded(df, *names, digits=6):
    return df.select(*[F.round(c, digits).alias(c) if c in names else F.col(c) for c in df.columns])


def src05(t):
    return load_report({name: getattr(t, name) for name in NAMES})


def prf01(t):
    return rounded(profile.numeric_summary(t.lineitem), "mean", "std", "q25", "q50", "q75", digits=4)


def prf02(t):
    return rounded(profile.ranges(dirty_docs(t)), "mean", "range", digits=4)


def prf03(t):
    return profile.outliers(t.lineitem)


def prf04(t):
    return profile.skew(t.events)


def prf05(t):
    s = profile.categorical_summary(dirty_docs(t))
    return rounded(s.drop("dominance"), "share")


def prf06(t):
    return profile.categorical_summary(t.pages.select("url").unionByName(
        t.pages.select(F.lit("none").alias("url"))).withColumn("kind", F.when(F.col("url") == "none", "x").otherwise("y"))
        .unionByName(t.customer.select(F.lit("none").alias("url"), F.lit("x").alias("kind")))).select("column", "dominance")


def prf07(t):
    return profile.missing(dirty_docs(t))


def prf08(t):
    return profile.duplicate_rows(dirty_docs(t))


def prf09(t):
    return union_all([profile.size_class(f).withColumn("table_name", F.lit(n)) for n, f in (
        ("region", t.region), ("benchmark", t.benchmark), ("orders", t.orders),
        ("total", t.orders.agg(F.sum("o_totalprice"))))])


def prf10(t):
    return profile.insights(dirty_docs(t))


def prf11(t):
    return profile.summary(t.orders, PROFILED_SQL)


def prf12(t):
    return profile.recommendations(dirty_docs(t), "SELECT * FROM docs")


def prf13(t):
    return rounded(profile.correlation_matrix(eval_rows(t), METRICS), "r")


def int01(t):
    return profile.integrity({n: getattr(t, n) for n in NAMES}, PRIMARY_KEYS, FOREIGN_KEYS)


def cht01(t):
    frames = {"orders": t.orders, "nation_sizes": t.nation.select("n_name", F.col("n_regionkey")),
              "region": t.region, "prices": t.part.select("p_retailprice"), "languages": t.documents.select("lang")}
    return union_all([charts.choose_chart(f).withColumn("frame", F.lit(n)) for n, f in frames.items()])


def cht02(t):
    return charts.bar_data(t.part.select("p_brand", "p_retailprice"))


def cht02_counts(t):
    return charts.bar_data(t.orders.select("o_orderpriority"))


def cht02_numeric(t):
    return charts.bar_data(t.part.select("p_partkey", "p_size", "p_retailprice"), row_key="p_partkey")


def cht03(t):
    return charts.line_data(t.orders)


def cht04(t):
    return rounded(charts.pie_data(t.orders.select("o_orderpriority", "o_totalprice")), "share")


def cht04_counts(t):
    return rounded(charts.pie_data(t.documents.select("lang")), "share")


def cht05(t):
    return rounded(charts.cut_bins(t.orders, "o_totalprice"), "lower", "upper", digits=4)


def cht06(t):
    return charts.scatter_data(t.events.select("user_id", "value", "event_type"))


def cht07(t):
    return rounded(charts.histogram(t.lineitem, "l_extendedprice"), "lower", "upper", digits=4)


def cht08(t):
    frames = {"orders": t.orders, "prices": t.part.select("p_retailprice"), "languages": t.documents.select("lang")}
    return union_all([charts.available_charts(f).withColumn("frame", F.lit(n)) for n, f in frames.items()])


def cht09(t):
    return rounded(charts.histogram(eval_rows(t), "bleu_score", keys=["execution_correct"]), "lower", "upper")


def cht09_length(t):
    rows = sql_pairs(t).select((F.upper(F.trim("pred_sql")) == F.upper(F.trim("truth_sql"))).alias("correct"),
                               F.length("pred_sql").alias("length"))
    return rounded(charts.histogram(rows, "length", keys=["correct"]), "lower", "upper")


def cht10(t):
    return rounded(charts.empirical_cdf(charts.finite(eval_rows(t), "response_time"), "technique", "response_time"),
                   "first_step", "last_step", "response_time")


def cht11(t):
    out = charts.percentile_table(eval_rows(t), "technique", "response_time")
    return rounded(out, "p50", "p75", "p90", "p95", "p99")


def cht12(t):
    return rounded(charts.box_summary(eval_rows(t), "technique", "response_time"), "q1", "median", "q3",
                   "whisker_low", "whisker_high")


def cht13(t):
    return rounded(charts.linear_trend(eval_rows(t), "confidence_score", ["execution_correct", "bleu_score"]),
                   "slope", "intercept")


def cat10(t):
    return charts.class_summary(t.lineitem)


def cln01(t):
    return clean.dedupe(dirty_docs(t))


def cln02(t):
    return clean.impute_median(dirty_docs(t), keys=("doc_id",))


def cln03(t):
    return clean.impute_mode(dirty_docs(t))


def cln04(t):
    return clean.parse_dates(dirty_docs(t))


def cln05(t):
    return clean.standardise_text(dirty_docs(t))


def cln06(t):
    before = dirty_docs(t)
    return clean.clean_stats(before, clean.clean(before, ("doc_id",)), "dirty_docs")


def cln07(t):
    return clean.clean_catalog(whole_catalog(t), work_folder(t.spark, "catalog"), CATALOG_KEYS)


def cleaned_docs(t):
    return clean.clean(dirty_docs(t), ("doc_id",))


def cleaned_docs_dates_first(t):
    return clean.clean(dirty_docs(t), ("doc_id",), dates_first=True)


PLANS = {name.upper().replace("_COUNTS", "_counts").replace("_NUMERIC", "_numeric").replace("_LENGTH", "_length"): f
         for name, f in list(globals().items())
         if callable(f) and name[:3] in ("src", "prf", "int", "cht", "cat", "cln") and name[3:5].isdigit()}
PLANS.update(CLN_all_steps=cleaned_docs, CLN_dates_first=cleaned_docs_dates_first)
