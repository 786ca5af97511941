"""Files, sinks, streams and user code, each run over the given tables."""

from pyspark.sql import functions as F

from querywright.functions.sqltext import normalise
from querywright.operators import analytics, catalog, clean, curate, models
from querywright.plans.fixtures import columns_catalog, eval_rows, qa_pairs, raw_pairs, sql_pairs, user_questions, with_run_outcome
from querywright.plans.prompting import SCHEMA
from querywright.plans.profiles import CATALOG_KEYS, whole_catalog
from querywright.plans.scoring import all_rounded, log
from querywright.operators.prompts import register_strategy, render_prompts, Strategy
from querywright.scale import union_all
from querywright.sources import pairs, sinks
from querywright.sources.jsonarray import write_json_array
from querywright.streaming import history


def written_pairs(t, kind, root=None):
    """Pairs written in a format, packed, and loaded back."""
    folder = (root or history.work_folder(t.spark, f"pairs-{kind}")) + f"/pairs.{kind}"
    rows = raw_pairs(t).select("question", "sql", "schema_context", "category", F.lit(None).cast("string").alias("complexity"))
    writer = rows.write.mode("overwrite").option("compression", "gzip")
    if kind == "csv":
        writer.options(header="true", escape='"', ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false").csv(folder)
    elif kind == "json":
        write_json_array(rows, folder, "gzip")
    else:
        writer.json(folder)
    return pairs.load_pairs(t.spark, folder)


def loaded_summary(df):
    return df.agg(F.count(F.lit(1)).alias("n"), F.count("question").alias("questions"), F.count("sql").alias("statements"),
                  F.count("schema_context").alias("contexts"), F.sum(F.length("sql")).alias("sql_chars"))


def src01(t):
    return loaded_summary(written_pairs(t, "json"))


def src04(t):
    """Every suffix, one that is not supported and a missing file, side by side. The pairs of one format are loaded and summed up
    before the next format is written, and go then, so that the disk holds them once."""
    found = {}
    for kind in ("json", "jsonl", "csv"):
        root = history.work_folder(t.spark, f"pairs-{kind}")
        found[kind] = history.stored(loaded_summary(written_pairs(t, kind, root)), f"summary-{kind}")
        sinks.drop_folder(t.spark, root)
    found["xml"] = loaded_summary(pairs.load_pairs(t.spark, f"{t.folder}/documents.xml"))
    found["missing"] = loaded_summary(pairs.load_pairs(t.spark, f"{t.folder}/no such file.json"))
    return union_all([df.withColumn("kind", F.lit(kind)) for kind, df in found.items()])


def src02(t):
    return loaded_summary(written_pairs(t, "jsonl"))


def src03(t):
    return loaded_summary(written_pairs(t, "csv"))


def src07(t):
    """Strategy results written as a nested artifact and read from the second of two paths."""
    folder = history.work_folder(t.spark, "results") + "/results.json"
    s = analytics.strategy_aggregates(eval_rows(t))
    nested = s.agg(F.struct(F.lit("now").alias("timestamp"), F.max("total_questions").alias("total_questions")).alias("metadata"),
                   F.map_from_entries(F.collect_list(F.struct("strategy", F.struct(
                       "success_rate", "avg_confidence", "avg_execution_time", "avg_bleu_score", "execution_accuracy",
                       "schema_compliance_rate")))).alias("strategy_results"))
    nested.write.mode("overwrite").json(folder)
    return all_rounded(pairs.load_results(t.spark, ["/nowhere/results.json", folder]))


def snk01(t):
    folder = history.work_folder(t.spark, "splits")
    sinks.write_splits(curate.split(qa_pairs(t), "pair_id"), folder)
    return t.spark.read.json(folder).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def snk02(t):
    """Every cleaned table as written: values and content totals (characters, or hundredths) per column."""
    folder = history.work_folder(t.spark, "clean")
    tables = whole_catalog(t)
    sinks.write_clean(tables, folder, CATALOG_KEYS)

    def columns_of(name):
        rows = clean.read_clean(t.spark, folder, name)
        kinds = dict(rows.dtypes)

        def total(c):
            if kinds[c] == "string":
                return F.sum(F.length(c).cast("long"))
            if kinds[c] in ("int", "bigint", "double"):
                return F.sum(F.floor(F.col(c).cast("double") * 100 + 0.5))
            return F.lit(None).cast("long")

        one = rows.agg(*[F.struct(F.lit(c).alias("column"), F.count(c).alias("n"), total(c).alias("total")).alias(c) for c in kinds])
        return one.select(F.lit(name).alias("table_name"), F.explode(F.array(*kinds)).alias("c")).select("table_name", "c.*")

    stats = t.spark.read.json(f"{folder}/stats").select("table_name", "original_rows", "final_rows", "duplicates_removed")
    return union_all([columns_of(name) for name in tables]).join(stats, "table_name")


def snk03(t):
    folder = history.work_folder(t.spark, "metrics")
    sinks.write_metrics(all_rounded(analytics.strategy_aggregates(eval_rows(t))), folder)
    return t.spark.read.json(f"{folder}/json").select("strategy", "avg_bleu_score", "total_questions")


def snk04(t):
    folder = history.work_folder(t.spark, "nested")
    rows = eval_rows(t).select(F.floor(F.col("question_id") / 5).alias("question_id"), "technique", "bleu_score", "confidence_score")
    sinks.write_results(rows, folder)
    return t.spark.read.json(folder).select("question_id", F.size("results").cast("long").alias("n_results"))


def snk05(t):
    """Orders and lines bucketed on the order key; the join of the two needs no shuffle."""
    names = {"qw_orders": t.orders, "qw_lines": t.lineitem}
    sinks.register_tables(t.spark, names, {"qw_orders": "o_orderkey", "qw_lines": "l_orderkey"},
                          location=history.work_folder(t.spark, "bucketed"), replace=True)
    joined = t.spark.table("qw_lines").join(t.spark.table("qw_orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


def snk06(t):
    folder = history.work_folder(t.spark, "cards")
    sinks.save_cards(catalog.build_cards(columns_catalog(t)), folder)
    return sinks.load_cards(t.spark, folder).select("id", "content", F.col("type").cast("string").alias("type"))


def snk07(t):
    folder = history.work_folder(t.spark, "comparison")
    sinks.write_comparison(analytics.technique_table(log(t)), folder)
    return t.spark.read.json(folder).select("best_technique", F.size("recommendations").cast("long").alias("n_recommendations"))


def udf01(t):
    """A lookup model answers every rendered prompt of one strategy."""
    def load():
        return lambda prompt: "SELECT COUNT(*) FROM orders" if "How many" in prompt else "SELECT * FROM orders"
    rows = render_prompts(user_questions(t), SCHEMA, strategies=("zero_shot",))
    return models.generate(rows, load).select("qid", "response")


def udf02(t):
    """Two techniques, one of which fails on some statements."""
    def careful(row):
        return {"sql": row["truth_sql"], "confidence": 0.9}

    def sloppy(row):
        if row["question_id"] % 4 == 0:
            raise ValueError("no idea")
        return row["truth_sql"].lower()

    rows = models.run_techniques(sql_pairs(t).select("question_id", "truth_sql"), {"careful": careful, "sloppy": sloppy}, "question_id")
    return rows.select("question_id", "technique", normalise("predicted_sql").alias("sql"), "confidence_score",
                       (F.col("response_time") == float("inf")).alias("failed"))


def udf03(t):
    """A user's strategy next to a built-in one."""
    register_strategy(Strategy("terse", "SQL for: {question}", "graph"))
    rows = render_prompts(user_questions(t), SCHEMA, strategies=("zero_shot", "terse"))
    return rows.select("qid", "strategy", F.md5("prompt").alias("prompt_md5"))


def udf04(t):
    models.register_metric("slow_share", models.column_metric(F.avg((F.col("response_time") > 1).cast("double"))))
    models.register_metric("longest", models.column_metric(F.max(F.when(F.col("response_time") != float("inf"), F.col("response_time")))))
    return all_rounded(models.compute_metrics(eval_rows(t), ["technique"], ["slow_share", "longest"]))


def str01(t):
    """Every event arrives twice; the history keeps one of each."""
    folder = history.work_folder(t.spark, "history")
    stream = history.read_events(t.spark, t.folder, "events.parquet")
    history.append_history(stream.unionByName(history.read_events(t.spark, t.folder, "events.parquet")),
                           f"{folder}/table", f"{folder}/checkpoint").awaitTermination()
    return history.read_history(t.spark, f"{folder}/table", stream.schema).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def str02(t):
    folder = history.work_folder(t.spark, "windows")
    rows = with_run_outcome(history.read_events(t.spark, t.folder, "events.parquet"))
    windows = history.strategy_windows(rows, "event_type", "ok", "correct", "value")
    history.run_to_table(windows, f"{folder}/table", f"{folder}/checkpoint")
    rows = t.spark.read.parquet(f"{folder}/table")
    day = F.date_format(F.col("window.start"), "yyyy-MM-dd")
    return rows.select(day.alias("day"), "strategy", "calls", "correct", "avg_time")


PLANS = {name[:5].upper() + name[5:]: f for name, f in list(globals().items())
         if callable(f) and name[:3] in ("src", "snk", "udf", "str") and name[3:5].isdigit()}
