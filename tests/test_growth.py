"""Work that must not grow with more than its input: prompts by their seams, bounded text partitions, JSON marks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from querywright.operators import prompts, retrieve, shapes
from querywright.sources import jsonarray

SCHEMA = {"typed": "- a: b(INT) or", "keys": "a(b:INT) custo", "graph": "olist → x"}
QUESTIONS = ["Show revenue", "der by", "", "mer \n\n{json} STEP by step", "Compare average order trend across Schema", None,
             "lian category", "İstanbul ΣΑΣ TABLE", "Which product {", "delivery } Question:"]


class Rendered:
    """A strategy without seams: its prompt is built and searched whole."""

    def __init__(self, inner):
        self.name, self.inner = inner.name, inner

    def render(self, question, schema):
        return self.inner.render(question, schema)


def test_seams_score_as_rendered_prompts_do(spark, monkeypatch):
    rows = spark.createDataFrame([(i, q) for i, q in enumerate(QUESTIONS)], "qid long, question string")
    monkeypatch.setitem(prompts.REGISTRY, "tight", prompts.Strategy("tight", "Bra{question}tomer and sub-{schema}{question}ss\n\n\n\n {examples}", "keys"))
    monkeypatch.setitem(prompts.REGISTRY, "close", prompts.Strategy("close", "Bra{question}tomer and sub-{schema}\n\n\n\n{examples}", "keys"))
    assert prompts.seamed(prompts.get_strategy("close"), F.col("question"), SCHEMA)
    names = [*prompts.tpl.STRATEGIES, "tight", "close"]
    by_seams = prompts.scored_strategies(rows, SCHEMA, strategies=names)
    assert "expert SQL analyst" not in by_seams._jdf.queryExecution().optimizedPlan().toString()
    got = {r.qid: r.scores for r in by_seams.collect()}
    for n in names:
        monkeypatch.setitem(prompts.REGISTRY, n, Rendered(prompts.REGISTRY[n]))
    assert got == {r.qid: r.scores for r in prompts.scored_strategies(rows, SCHEMA, strategies=names).collect()}


def test_terms_are_counted_in_bounded_parts(spark, monkeypatch):
    monkeypatch.setattr(retrieve, "PART_CHARS", 1000)
    docs = spark.createDataFrame([(i, "some words of a text " * 10) for i in range(200)], "id long, content string")
    assert retrieve.postings(docs).rdd.getNumPartitions() >= 42
    assert retrieve.postings(docs).agg(F.sum("f")).first()[0] == 200 * 50


def test_levels_follow_marks_alone():
    plain = b'[{"a": "x, ]"}, [1, 2]]' + b" " * 1000
    at, marks = jsonarray._marks(plain)
    assert len(at) == sum(plain.count(c) for c in (b'"', b"[", b"]", b"{", b"}", b","))
    outside, level = jsonarray._levels(marks, False)
    assert outside[-1] and level[-1] == 0 and int(np.max(level)) == 2
    assert jsonarray._borders(plain, False, 0)[0].tolist() == [0, 14, 22]
    assert jsonarray._borders(b"   ", True, 3) [1:] == (True, 3)


def test_statements_are_shaped_once(spark, monkeypatch):
    written = []
    real = shapes.stored
    monkeypatch.setattr(shapes, "stored", lambda df, name: written.append(name) or real(df, name))
    df = spark.createDataFrame([(k, f"SELECT 1 AS x WHERE {k} = {k}", "SELECT 1 AS x") for k in range(3)], "id long, pred_sql string, truth_sql string")
    out = shapes.execution_match(spark, df)
    assert written == ["statements"]
    assert "regexp_extract_all" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert [r.execution_correct for r in out.orderBy("id").collect()] == [True] * 3
