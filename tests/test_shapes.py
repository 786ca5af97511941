"""Statement shapes, group splits and the rare-gram index against plain Python."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from querywright.operators import catalog, curate, shapes
from querywright.sources.tables import register_views


@pytest.fixture(scope="module")
def views(spark, tables):
    register_views(spark, tables.folder)
    return spark


def verdicts(spark, pairs, **rules):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "id long, pred_sql string, truth_sql string")
    return [r.execution_correct for r in shapes.execution_match(spark, df, **rules).orderBy("id").collect()]


def test_execution_match_by_shape(views):
    count = "SELECT COUNT(*) AS n FROM nation WHERE n_regionkey = {}"
    cases = [
        (count.format(1), count.format(1) + " ;", True),
        (count.format(1), count.format(99), False),                          # no row counts as zero, not as nothing
        (count.format(99), "SELECT 0 AS n", True),
        ("SELECT n_name FROM nation WHERE n_name = 'PERU'", "SELECT n_name FROM nation WHERE 'PERU' = n_name", None),
        ("SELECT r_name AS a FROM region", "SELECT r_name AS b FROM region", False),
        ("SELECT r_regionkey + 0.0 AS k FROM region", "SELECT r_regionkey AS k FROM region", True),
        ("SELECT r_name FROM region WHERE r_name = 'no such'", "SELECT r_name FROM region WHERE r_regionkey > 99", True),
        ("SELECT n_name FROM nation WHERE n_regionkey >= 3 AND n_nationkey < 9", "SELECT n_name FROM nation WHERE n_nationkey < 9 AND n_regionkey >= 3", True),
        ("DELETE FROM region", "DELETE FROM region", False), (None, "SELECT 1", False), ("", "", False),
        ("SELECT nothing FROM nowhere", "SELECT nothing FROM nowhere", False),
        ("SELECT 'a = 5' AS t", "SELECT 'a = 6' AS t", False), ("SELECT 'a = 5' AS t", "SELECT 'a = 5' AS  t", True),
        ("SELECT 1 AS x, 2 AS x", "SELECT 1 AS x, 2 AS x ", True)]
    got = verdicts(views, [(a, b) for a, b, _ in cases])
    name = views.sql("SELECT count(*) FROM nation WHERE n_name = 'PERU'").first()[0] >= 0
    assert [g for g, (_, _, w) in zip(got, cases) if w is not None] == [w for _, _, w in cases if w is not None]
    assert got[3] is name


def test_sets_and_bags_differ(views):
    pair = [("SELECT * FROM VALUES (1), (1), (2) AS t(a)", "SELECT * FROM VALUES (1), (2), (2) AS t(a)")]
    assert verdicts(views, pair) == [True] and verdicts(views, pair, mode="bag") == [False]


def test_shapes_are_bounded(views):
    pairs = [("SELECT 1 AS a", "SELECT 2 AS b")]
    with pytest.raises(ValueError):
        verdicts(views, pairs, max_shapes=1)
    many = [(f"SELECT n_name FROM nation WHERE n_nationkey = {i}",) * 2 for i in range(25)]
    df = views.createDataFrame(many, "pred_sql string, truth_sql string")
    assert shapes.with_shape(df, "pred_sql").select("shape").distinct().count() == 1
    assert verdicts(views, many, max_shapes=1) == [True] * 25


def test_group_split_keeps_groups_and_sizes(spark):
    groups = ["hot"] * 300 + [f"g{i % 150}" for i in range(400)] + [f"s{i}" for i in range(200)]
    df = spark.createDataFrame(list(enumerate(groups)), "id long, g string")
    for ratios in ((0.8, 0.1, 0.1), (0.5, 0.25, 0.25)):
        out = curate.split_by_group(df, F.col("g"), ratios)
        rows = out.select("g", "split").collect()
        held = defaultdict(set)
        for r in rows:
            held[r.g].add(r.split)
        assert len(rows) == len(groups) and all(len(s) == 1 for s in held.values())
        sizes, largest = Counter(r.split for r in rows), max(Counter(groups).values())
        assert all(abs(sizes[name] - ratio * len(groups)) <= largest for name, ratio in zip(("train", "validation", "test"), ratios))
        assert curate.leaks(out).count() == 0
    single = df.withColumn("group_key", F.col("g")).withColumn("split", F.when(F.col("id") < 50, "train").otherwise("test"))
    assert {r.group_key for r in curate.leaks(single).collect()} == {"hot"}
    assert curate.split_by_group(df.filter("false"), F.col("g")).count() == 0


def test_contains_join_by_rarest_gram(spark):
    rnd = random.Random(2)
    texts = ["".join(rnd.choices("abAB ", k=rnd.randint(0, 12))) for _ in range(200)] + [None, "xyz rare", "aaaa"]
    needles = ["a", "b ", "ab", "AbA", "abab", "rare", "xyz rare", "zzz", "aaaa", "z r", "bbbbbb"]
    hay = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    asked = spark.createDataFrame([(n,) for n in needles], "q string")
    got = {(r.q, r.id) for r in catalog.contains_join(asked, "q", hay, ["text"]).select("q", "id").collect()}
    assert got == {(n, i) for n in needles for i, t in enumerate(texts) if t is not None and n.lower() in t.lower()}
    assert catalog.contains_join(asked.filter("false"), "q", hay, ["text"]).count() == 0


def test_any_word_matches_without_words_times_cards(spark):
    """Numbers ask for a plan that meets no card per word and candidate: first cards are kept by run, not by rare gram."""
    rng = random.Random(7)
    cards = [(f"c{i:04}", "column", f"n{i}", f"Column: t{i // 7}_big.Name_{i * 37} (É{i % 5})") for i in range(300)]
    cards += [(f"t{i}", "table", f"T{i}", f"Table: t{i}_big") for i in range(40)] + [("c0001", "column", "n1", cards[1][3])]
    asked = [(q, " ".join(rng.choice(["37", "1", "name_7", "big.", "É3", "zz", "T1", "99", "umn", "incomprehensibilities", "(é4)", str(rng.randrange(900))])
                          for _ in range(3))) for q in range(60)]
    got = catalog.match_any_word(spark.createDataFrame(asked, "qid long, question string"),
                                 spark.createDataFrame(cards, "id string, type string, name string, content string"), "qid", "question")
    joined = []
    real = catalog.contains_join
    try:
        catalog.contains_join = lambda needles, *a, **b: joined.extend(r.word for r in needles.collect()) or real(needles, *a, **b)
        catalog.match_any_word(spark.createDataFrame(asked, "qid long, question string"),
                               spark.createDataFrame(cards, "id string, type string, name string, content string"), "qid", "question").collect()
    finally:
        catalog.contains_join = real
    assert joined and not [w for w in joined if w.isdigit()]
    want = set()
    for q, text in asked:
        hits = set()
        for w in set(text.lower().split()):
            rows = sorted((c[1] != "table", c[0], c[2]) for c in cards if w in c[3].lower())
            rows = [r for r in rows for _ in range(sum(c[0] == r[1] for c in cards))]
            hits |= set(rows[:3])
        want |= {(q, name, rank) for rank, (_, _, name) in enumerate(sorted(hits)[:3], 1)}
    assert {tuple(r) for r in got.collect()} == want
