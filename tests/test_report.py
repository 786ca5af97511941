"""The long-form report of a log: both quantile plans, empty logs, failed calls."""

import pytest

from querywright.operators import analytics
from querywright.plans.scoring import log


def rows_of(df):
    return sorted((r.section, r.item, r.metric, None if r.value is None else round(r.value, 9)) for r in df.collect())


def test_both_quantile_plans_agree(spark, tables):
    rows = log(tables)
    spark.conf.set("spark.querywright.singleTaskBytes", "1")
    try:
        far = rows_of(analytics.report(rows))
    finally:
        spark.conf.unset("spark.querywright.singleTaskBytes")
    near = rows_of(analytics.report(rows, sized_by=tables.events))
    assert near == far and len(near) > 30


def test_sections_equal_their_own_queries(tables):
    rows = log(tables)
    got = {(r.section, r.item, r.metric): r.value for r in analytics.report(rows, sized_by=tables.events).collect()}
    for section, frame in (("overall", analytics.headline(rows)), ("confidence", analytics.confidence_stats(rows)),
                           ("response_time", analytics.time_stats(rows)), ("bleu_score", analytics.bleu_stats(rows))):
        for metric, value in frame.first().asDict().items():
            assert got[section, "all", metric] == pytest.approx(value), (section, metric)
    for r in analytics.by_query_type(rows).collect():
        for metric, value in r.asDict().items():
            if metric != "query_type":
                assert got["query_type", r.query_type, metric] == pytest.approx(value)


def test_empty_log(tables):
    got = {(r.section, r.item, r.metric): r.value for r in analytics.report(log(tables).limit(0), sized_by=tables.events).collect()}
    assert got["overall", "all", "total_samples"] == 0.0 and got["response_time", "all", "p95"] == 0.0
    assert got["complexity", "complex", "count"] == 0.0 and not [k for k in got if k[0] == "query_type"]


def test_one_pass(tables):
    plan = analytics.report(log(tables), sized_by=tables.events)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange SinglePartition") == 1 and "CartesianProduct" not in plan
