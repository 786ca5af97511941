"""The distributed plans give the results of the single-task plans, also on skewed input."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from querywright import scale
from querywright.operators import analytics, catalog, curate, retrieve


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key, and a third of those one value."""
    k = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7)
    v = F.when(F.col("id") % 9 == 0, 5.0).otherwise((F.col("id") * 7919 % 1000) / 10)
    return spark.range(6000).select(k.alias("k"), v.cast("double").alias("v"))


def rows(df):
    return sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect())


@pytest.mark.parametrize("keys", [[], ["k"]])
@pytest.mark.parametrize("accuracy", [50, 100_000])
def test_quantiles(spark, skewed, keys, accuracy):
    spark.conf.set(scale.SKETCH_ACCURACY, accuracy)
    probs = {"lo": 0, "q": 0.25, "m": 0.5, "h": 0.99, "hi": 1}
    try:
        assert rows(scale.quantiles(skewed, keys, "v", probs, False)) == rows(scale.quantiles(skewed, keys, "v", probs, True))
    finally:
        spark.conf.unset(scale.SKETCH_ACCURACY)


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_cumulative_counts(skewed, keys):
    near, far = scale.cumulative_counts(skewed, keys, "v", False), scale.cumulative_counts(skewed, keys, "v", True)
    assert rows(near) == rows(far.select(near.columns))


def test_sum_by_dimension(spark, skewed):
    dim = spark.range(7).select(F.col("id").alias("d"), (F.col("id") % 2).alias("g"))
    near = scale.sum_by_dimension(skewed, "k", dim, "d", ["g"], {"s": F.col("v").cast("decimal(12,1)"), "n": F.lit(1)})
    spark.conf.set(scale.BROADCAST_BYTES, 0)
    try:
        far = scale.sum_by_dimension(skewed, "k", dim, "d", ["g"], {"s": F.col("v").cast("decimal(12,1)"), "n": F.lit(1)})
        assert rows(near) == rows(far)
    finally:
        spark.conf.unset(scale.BROADCAST_BYTES)


def test_checked_broadcast_falls_back(spark, skewed):
    spark.conf.set(scale.BROADCAST_BYTES, 64)
    try:
        assert scale.checked_broadcast(skewed) is skewed
    finally:
        spark.conf.unset(scale.BROADCAST_BYTES)


def test_top_k_is_cut_before_the_shuffle(skewed):
    plan = scale.top_k(skewed, ["k"], [F.desc("v")], 3)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan


def test_mann_whitney_against_brute_force(spark):
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 20, 60) / 10, rng.integers(5, 25, 80) / 10
    data = [("a", float(x)) for x in a] + [("b", float(x)) for x in b]
    df = spark.createDataFrame(data, "technique string, bleu_score double")
    u = sum((x > y) + 0.5 * (x == y) for x in a for y in b)
    n, ties = len(data), sum(c ** 3 - c for c in Counter(v for _, v in data).values())
    sigma = math.sqrt(len(a) * len(b) / 12 * (n + 1 - ties / (n * (n - 1))))
    z = (max(u, len(a) * len(b) - u) - len(a) * len(b) / 2 - 0.5) / sigma
    for distributed in (False, True):
        got = analytics.mann_whitney(df, [("a", "b")], "bleu_score", distributed).first()
        assert got.u_statistic == pytest.approx(u) and got.z == pytest.approx(z)
        assert got.u_pvalue == pytest.approx(math.erfc(z / math.sqrt(2)))


def test_dense_tiles_equal_broadcast(tables):
    vecs = tables.embeddings.select(F.col("vec_id").alias("id"), "embedding")
    asked = tables.embeddings.limit(50).select(F.col("vec_id").alias("qid"), "embedding")
    near = retrieve.dense_topk(vecs, asked, 5).collect()
    far = retrieve.dense_topk(vecs, asked, 5, block=20).collect()
    assert sorted(map(tuple, near)) == sorted(map(tuple, far)) and len(near) == 250


def test_dense_ties_and_small_tiles(spark, monkeypatch):
    """Equal vectors over several score blocks and tiles rank by id on both paths."""
    vecs = spark.range(3000).select("id", F.array((F.col("id") % 3 + 1).cast("double"), F.lit(1.0)).alias("embedding"))
    asked = spark.range(9).select(F.col("id").alias("qid"), F.array(F.lit(1.0), F.lit(1.0)).alias("embedding"))
    want = [(q, i * 3, i + 1) for q in range(9) for i in range(4)]
    monkeypatch.setattr(retrieve, "TILE_BYTES", 16 * 700)
    for block in (100, 4):
        got = retrieve.dense_topk(vecs, asked, 4, block).select("qid", "id", "rank").collect()
        assert sorted(map(tuple, got)) == want
    assert retrieve.dense_topk(vecs.filter("id < 0"), asked, 4).isEmpty()
    assert retrieve.dense_topk(vecs.filter("id < 0"), asked, 4, 4).isEmpty()


def test_series_ordinals(spark):
    scores = spark.range(500).select((F.col("id") * 7 % 1000).alias("qid"), (F.col("id") / 500).alias("relevance"))
    near, far = (retrieve.retrieval_series(scores, distributed=d) for d in (False, True))
    assert near.schema == far.schema and rows(near) == rows(far)
    assert [o for _, o, _ in rows(near)] == list(range(1, 501))
    times = scores.select("qid", F.lit(0.25).alias("response_time"))
    assert {r.time_ms for r in retrieve.retrieval_series(scores, times).collect()} == {250.0}


def test_bm25_against_brute_force(spark):
    docs = ["a b c a", "b b d", "a", "e f g h a", "c c c b"]
    df = spark.createDataFrame(list(enumerate(docs)), "id long, content string")
    qs = spark.createDataFrame([(0, "a c c zzz"), (1, "d e")], "qid long, text string")
    toks = [d.split() for d in docs]
    avg, n = sum(map(len, toks)) / len(toks), len(toks)
    idf = {t: math.log(n - f + 0.5) - math.log(f + 0.5) for t, f in Counter(x for t in toks for x in set(t)).items()}
    floor = 0.25 * sum(idf.values()) / len(idf)
    want = []
    for qid, q in ((0, "a c c zzz"), (1, "d e")):
        for i, t in enumerate(toks):
            s = sum((idf[w] if idf[w] >= 0 else floor) * t.count(w) * 2.5 / (t.count(w) + 1.5 * (0.25 + 0.75 * len(t) / avg))
                    for w in q.split() if w in idf)
            if s > 0:
                want.append((qid, i, round(s, 6)))
    got = [(r.qid, r.id, round(r.score, 6)) for r in retrieve.bm25_topk(df, qs, 10).collect()]
    assert sorted(got) == sorted(want)


def test_contains_join_against_brute_force(spark):
    hay = ["Table: orders", "Column: ORDERS.id (INT)", "x", "", "reorder now", "aaa"]
    needles = ["order", "r", "aa", "ID", "zz", "orders.id"]
    h = spark.createDataFrame(list(enumerate(hay)), "id long, content string")
    n = spark.createDataFrame([(x,) for x in needles], "q string")
    got = {(r.q, r.id) for r in catalog.contains_join(n, "q", h, ["content"]).collect()}
    assert got == {(q, i) for q in needles for i, t in enumerate(hay) if q.lower() in t.lower()}


def test_split_sizes_and_stability(spark):
    df = spark.range(1003).select(F.col("id").alias("pair_id"))
    first = {r.pair_id: r.split for r in curate.split(df, "pair_id").collect()}
    again = {r.pair_id: r.split for r in curate.split(df.repartition(5), "pair_id").collect()}
    assert first == again
    assert Counter(first.values()) == {"train": 802, "validation": 100, "test": 101}
    with pytest.raises(ValueError):
        curate.split(df, "pair_id", (0.5, 0.1, 0.1))
