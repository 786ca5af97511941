"""The pipeline stage by stage against plain Python, and its queries against SQL."""

import duckdb
import numpy as np
import zlib
from collections import Counter

import corpus_pipeline
from check_oracle import compare
from querywright.llm import packing, sql
from querywright.llm.queries import PLANS
from querywright.sources.tables import NAMES
from tests.conftest import FOLDER
from tests.llm.test_operators import brute_components, brute_features, brute_lines, ids


def test_stages_equal_brute_force(spark, tables):
    docs = tables.documents
    labels = {r.doc_id: r.quality for r in tables.labels.collect()}
    frame, texts = docs, {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        before, frame = texts, corpus_pipeline.settle(stage(spark, frame, FOLDER))
        if name == "packing":
            want = Counter()
            for i, text in before.items():
                own = np.array([*ids(text), 0], "<u4")
                for k, (start, n) in enumerate(packing.cuts(len(own), 2048)):
                    want[i, k, start, n, zlib.crc32(own[start:start + n].tobytes())] += 1
            assert Counter(tuple(r)[:5] for r in frame.collect()) == want
            continue
        assert frame.schema == docs.schema
        texts = {r.doc_id: r.text for r in frame.collect()}
        assert all(r.n_chars == len(r.text) for r in frame.collect())
        if name == "quality_rules":
            for i, text in before.items():
                words, _, _, _, repeated = brute_features(text)
                if words < 50 or 2 * repeated > words or labels.get(i) == 0:
                    assert i not in texts
                elif labels.get(i) == 1:
                    assert i in texts
        elif name == "line_dedup":
            assert texts == {i: text for i, _, _, text in brute_lines(list(before.items()))}
        elif name == "near_dedup":
            assert set(texts) == {i for i, (_, _, kept) in brute_components(list(before.items())).items() if kept}
        elif name == "pii":
            assert set(texts) == set(before)
    assert corpus_pipeline.run(spark, FOLDER).count() == frame.count()


def test_queries_equal_sql(spark):
    con = duckdb.connect()
    for name in NAMES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    for name, text in sql.SQL.items():
        problems, rows = compare(PLANS[name](spark, FOLDER), con, text)
        assert not problems and rows


def test_every_query_returns_all_documents(spark, tables):
    n = tables.documents.count()
    for name, plan in PLANS.items():
        assert plan(spark, FOLDER).select("doc_id").distinct().count() == n, name
