"""Values the reference's own tests assert, and properties of the operators."""

import math
import os
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from querywright.functions import sqltext as st
from querywright.functions.stats import LARGE_DOF, incomplete_beta, student_tails
from querywright.operators import analytics, charts, clean, evaluate, guard, models, profile, prompts
from querywright.operators import catalog
from querywright.sources import pairs, tables as src
from querywright.streaming import history


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return df.select(column).first()[0]


def test_normalise(spark):
    assert one(spark, st.normalise("s"), s="  SELECT   *   FROM   customers  ; ") == "SELECT * FROM CUSTOMERS"


def test_tokens(spark):
    want = ["select", "name", ",", "age", "from", "customers", "where", "age", ">", "25"]
    assert one(spark, st.tokens("s"), s="SELECT name, age FROM customers WHERE age > 25") == want


@pytest.mark.parametrize("pred,low,high", [
    ("SELECT * FROM customers", 1.0, 1.0), ("SELECT name FROM customers", 1e-9, 1 - 1e-9), ("", 0.0, 0.0), (None, 0.0, 0.0)])
def test_bleu(spark, pred, low, high):
    df = spark.createDataFrame([(pred, "SELECT * FROM customers")], "p string, t string")
    assert low - 1e-12 <= evaluate.with_bleu(df, "p", "t").first().bleu_score <= high + 1e-12


def test_empty_prediction(spark):
    df = spark.createDataFrame([("", "SELECT * FROM customers"), (None, "SELECT 1")], "pred_sql string, truth_sql string")
    for r in evaluate.evaluate(df, ["customers"]).collect():
        assert (r.exact_match, r.bleu_score, r.execution_correct, r.schema_compliant) == (False, 0.0, False, False)


@pytest.mark.parametrize("sql,ok", [("SELECT * FROM customers", True), ("SELECT * FROM nowhere", False), ("", False)])
def test_compliance(spark, sql, ok):
    assert one(spark, evaluate.schema_compliant("s", ["customers", "orders"]), s=sql) is ok


@pytest.mark.parametrize("sql,ok", [
    ("SELECT * FROM customers", True), ("SELECT COUNT(*) FROM orders", True), ("DROP TABLE customers", False),
    ("INSERT INTO customers VALUES (1)", False), ("UPDATE customers SET a = 1", False), ("DELETE FROM customers", False)])
def test_safe(spark, sql, ok):
    assert one(spark, st.is_safe("s"), s=sql) is ok


def test_run_readonly(spark, tables):
    src.register_views(spark, tables.folder)
    good = ["SELECT 1", "SELECT c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders) ORDER BY 1 LIMIT 3",
            "WITH a AS (SELECT o_custkey, row_number() OVER (ORDER BY o_orderkey) r FROM orders) SELECT * FROM a",
            "SELECT * FROM region UNION SELECT * FROM region", "SELECT a.* FROM orders a LEFT JOIN customer ON o_custkey = c_custkey",
            "SELECT o_orderstatus, COUNT(*) FROM orders GROUP BY 1 HAVING COUNT(*) > 1", "VALUES (1), (2)",
            "SELECT created_at FROM (SELECT 1 AS created_at)"]
    for sql in good:
        status, result = guard.run_readonly(spark, sql)
        row = status.first()
        assert row.success, (sql, row.error)
        assert result is not None and row.row_count == result.count()
    for sql in ("", None, "DROP VIEW orders", "CREATE TABLE t AS SELECT 1", "INSERT INTO orders SELECT * FROM orders",
                "WITH a AS (SELECT 1) INSERT INTO orders SELECT * FROM a", "SELECT 1; DROP TABLE t", "SET x=1",
                "SELECT * FROM missing_table", "SELECT nothing FROM orders", "SELEC 1", "TRUNCATE TABLE orders", "CACHE TABLE orders"):
        status, result = guard.run_readonly(spark, sql)
        assert not status.first().success and status.first().error and result is None, sql


def test_leaderboard_columns(tables):
    from querywright.plans.fixtures import eval_rows
    board = analytics.leaderboard(eval_rows(tables))
    assert board.columns == ["model", "total_queries", "execution_accuracy", "exact_match_accuracy", "schema_compliance_rate",
                             "avg_bleu_score", "avg_response_time", "error_rate"]
    assert "Execution Accuracy" in analytics.report_text(board).first().text


def test_failing_model_call(spark):
    df = spark.createDataFrame([("a",), ("b",)], "q string")

    def fn(text):
        if text == "b":
            raise ValueError
        return text.upper()
    got = {r.q: (r.output, r.response_time) for r in evaluate.timed_map(df, fn, "q").collect()}
    assert got["a"][0] == "A" and got["b"] == (None, math.inf)


def test_same_result_modes(spark):
    a = spark.createDataFrame([("a",), ("a",), ("b",)], "x string")
    b = spark.createDataFrame([("a",), ("b",), ("b",)], "x string")
    assert evaluate.same_result(a, b).first().same and not evaluate.same_result(a, b, "bag").first().same
    assert evaluate.same_result(a, b, "bag").first() == evaluate.same_result(b, a, "bag").first()
    assert not evaluate.same_result(a, b.withColumnRenamed("x", "y")).first().same
    empty = a.filter("false")
    assert evaluate.same_result(empty, empty).first().same and not evaluate.same_result(a, empty).first().same


def test_histogram_keeps_every_value(spark):
    df = spark.range(1000).select((F.col("id") * 0.1).alias("v"))
    assert charts.histogram(df, "v").agg(F.sum("n")).first()[0] == 1000
    constant = spark.range(10).select(F.lit(3.0).alias("v"))
    assert charts.histogram(constant, "v").agg(F.sum("n")).first()[0] == 10
    assert charts.cut_bins(df, "v").agg(F.sum("n")).first()[0] == 1000


def test_describe_ignores_nan(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (None,)], "v double")
    r = profile.numeric_summary(df).first()
    assert (r["count"], r["mean"], r["q50"]) == (2, 2.0, 2.0)


def test_clean_order(spark):
    df = spark.createDataFrame([(1, "2024-01-01"), (2, None), (3, "2024-01-01"), (3, "2024-01-01")], "n int, the_date string")
    assert clean.clean(df).filter("the_date is null").count() == 0
    assert clean.clean(df, dates_first=True).filter("the_date is null").count() == 1


def test_load_pairs(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"question": "q1", "sql": "s1"},\n {"question": "q2", "sql": "s2"}]')
    (tmp_path / "a.jsonl").write_text('{"question": "q1", "sql": "s1"}\n\n{"question": "q2", "sql": "s2"}\nbroken\n')
    (tmp_path / "a.csv").write_text('question,sql,schema_context,category,complexity\n"q, 1",s1,,,\nq2,s2,,,\n')
    (tmp_path / "a.txt").write_text("x")
    load = lambda n: pairs.load_pairs(spark, str(tmp_path / n))
    assert load("a.json").filter("sql is not null").count() == 2
    assert load("a.jsonl").filter("sql is not null").count() == 2
    assert {r.question for r in load("a.csv").collect()} == {"q, 1", "q2"}
    assert load("a.txt").count() == 0 and load("missing.json").count() == 0


def test_load_catalog(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n1,x\n")
    got = src.load_catalog(spark, str(tmp_path), {"t": "t.csv", "u": "u.csv"})
    assert list(got) == ["t"] and src.load_report(got).first().rows == 1
    with pytest.raises(FileNotFoundError):
        src.load_catalog(spark, str(tmp_path), {"u": "u.csv"})


def test_jdbc_options():
    o = src.jdbc_options("jdbc:postgresql://h/db", "orders", "id", 1, 100, 8, user="u")
    assert o["partitionColumn"] == "id" and o["numPartitions"] == "8" and o["user"] == "u"
    with pytest.raises(ValueError):
        src.jdbc_options("jdbc:x", "t", "id")


def test_schema_graph(spark):
    e = spark.createDataFrame([("o", "c", "k", "id"), ("l", "o", "o", "id"), ("l", "a", "o", "id")],
                              "table_name string, column_name string, ref_table string, ref_column string")
    got = {r.table_name: r.schema_graph for r in catalog.schema_graph(e).collect()}
    assert got == {"l": "l.a → o.id\nl.o → o.id", "o": "o.c → k.id"}


def test_results_mart_keeps_every_technique(spark):
    rows = spark.range(3000).select((F.col("id") % 2).alias("question_id"), F.concat(F.lit("t"), F.floor(F.col("id") / 2)).alias("technique"),
                                    F.lit(0.5).alias("bleu_score"), F.lit(0.25).alias("confidence_score"))
    assert analytics.question_results(rows).count() == 3000
    wide = analytics.wide_results(rows, ["t0", "t1499"])
    assert wide.columns == ["question_id", "t0_bleu_score", "t0_confidence_score", "t1499_bleu_score", "t1499_confidence_score"]
    assert wide.count() == 2


def test_history_takes_files_in_any_order(spark, tables, tmp_path):
    """Newest file first, one per micro-batch, and a copy that comes days later."""
    events = tables.events.orderBy("ts").toPandas()
    third = -(-len(events) // 3)
    late = events.iloc[:1].assign(ts=events.ts.iloc[0] + pd.Timedelta(days=3))
    for place, part in enumerate([pd.concat([events.iloc[2 * third:], late]), events.iloc[third:2 * third], events.iloc[:third]]):
        path = tmp_path / f"events{place}.parquet"
        part.to_parquet(path, coerce_timestamps="us")
        os.utime(path, (1_600_000_000 + place, 1_600_000_000 + place))
    stream = history.read_events(spark, str(tmp_path), files_per_trigger=1)
    history.append_history(stream, str(tmp_path / "table"), str(tmp_path / "checkpoint")).awaitTermination()
    got = sorted(r.event_id for r in history.read_history(spark, str(tmp_path / "table"), stream.schema).collect())
    assert got == sorted(events.event_id)


def _appended(spark, folder, files, schema="event_id long, ts timestamp, v int"):
    """Each list of rows is a file and a micro-batch of its own."""
    for place, rows in enumerate(files):
        part = folder / "parts" / str(place)
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(part))
        source = next(part.glob("*.parquet"))
        os.utime(source, (1_600_000_000 + place,) * 2)
        (folder / "in").mkdir(exist_ok=True, parents=True)
        os.rename(source, folder / "in" / f"events{place}.parquet")
    stream = history.read_events(spark, str(folder / "in"), files_per_trigger=1)
    history.append_history(stream, str(folder / "table"), str(folder / "checkpoint")).awaitTermination()
    return stream


def test_history_reads_only_days_its_keys_reach(spark, tmp_path):
    day = lambda n: datetime(2024, 1, 1) + timedelta(days=n)
    files = [[(10 * n + i, day(n), 0) for i in range(10)] for n in range(4)]
    files.append([(5, day(9), 1), (5, day(2), 2), (None, None, 3), (None, day(1), 4)])   # late copies on other days, keyless rows
    files.append([(None, day(3), 5), (36, day(0), 6), (40, None, 7)])
    stream = _appended(spark, tmp_path, files)
    table = str(tmp_path / "table")
    got = history.read_history(spark, table, stream.schema)
    assert got.columns == ["event_id", "ts", "v"]
    ids = [r.event_id for r in got.collect()]
    assert sorted(i for i in ids if i is not None) == list(range(41)) and ids.count(None) == 1
    known = history.known_keys(spark, table, stream.schema["event_id"], 12, 17, False)
    assert sorted(r[0] for r in known.collect()) == list(range(12, 18))
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "GreaterThanOrEqual(event_id,12)" in plan
    # spans of the days: the first batch of each, and the late ones that reach over several
    hit = {r[0] for r in spark.read.parquet(f"{table}/_spans").filter("low <= 17 and high >= 12").select(history.DAY).distinct().collect()}
    assert hit == {"2024-01-02"}


def test_history_batch_repeated_and_empty(spark, tmp_path):
    rows = [(i, datetime(2024, 1, 1 + i % 3), i) for i in range(20)]
    stream = _appended(spark, tmp_path / "a", [rows])
    # the same files through a new checkpoint, as after a failure between rows and commit
    history.append_history(stream, str(tmp_path / "a" / "table"), str(tmp_path / "again")).awaitTermination()
    assert history.read_history(spark, str(tmp_path / "a" / "table"), stream.schema).count() == 20
    stream = _appended(spark, tmp_path / "b", [[]])
    assert history.read_history(spark, str(tmp_path / "b" / "table"), stream.schema).count() == 0


def test_unknown_strategy():
    with pytest.raises(ValueError):
        prompts.get_strategy("nope")


def test_metric_registry(spark):
    models.register_metric("n_rows", lambda: F.count(F.lit(1)))
    models.register_metric("top", lambda df, keys: df.groupBy(*keys).agg(F.max("v").alias("top")))
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 5)], "k string, v int")
    assert {tuple(r) for r in models.compute_metrics(df, ["k"], ["n_rows", "top"]).collect()} == {("a", 2, 2), ("b", 1, 5)}


def test_student_tail():
    # two-sided p of t = 2.0 with 10 degrees of freedom, and of t = 1 with 1 (a Cauchy quartile)
    assert incomplete_beta(5, 0.5, 10 / 14) == pytest.approx(0.0733880, abs=1e-6)
    assert incomplete_beta(0.5, 0.5, 0.5) == pytest.approx(0.5, abs=1e-12)


def test_student_tail_of_large_samples():
    for t in (0.1, 1.0, 3.0):                # no step at the border
        assert student_tails(t, 0.999 * LARGE_DOF) == pytest.approx(student_tails(t, 1.001 * LARGE_DOF), rel=1e-7)
    assert student_tails(1.0, 1e11) == pytest.approx(0.3173105, abs=1e-7)
    assert student_tails(0.0, 1e11) == 1.0


def test_calibration_is_guarded(spark):
    df = spark.createDataFrame([("x", 0.5, True), ("x", 0.5, False), ("y", 0.1, True)], "technique string, confidence_score double, execution_correct boolean")
    assert {r.technique: r.calibration_score for r in analytics.calibration_by(df, ["technique"]).collect()} == {"x": 0.0, "y": 0.0}
