"""Pairs on disk: packed files, one format at a time, only the keys of quoting orders beside the texts."""

import bz2
import gzip
import io
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from querywright.plans import operations
from querywright.plans.fixtures import raw_pairs
from querywright.sources import jsonarray, pairs
from querywright.sources.tables import Tables
from querywright.streaming import history

ELEMENTS = [{"a": "plain", "n": 1}, {"a": "quote \" and \\ and ] } , [ {", "n": [1, [2, {"x": "],"}]]}, {"a": "\\" * 9 + "\"", "n": None},
            {"a": "größe 漢字 😀", "n": 2}, {}, {"a": "long " * 400, "n": 3}, 7, "a, text ]", None, [1, 2], {"a": "\n\t", "n": 4}]
WORDS = "w " * 1500


def elements(data):
    return [p.decode() for some in jsonarray._elements(io.BytesIO(data)) for p in some if p.strip()]


@pytest.mark.parametrize("size", [1, 2, 3, 7, 64, 1000, 1 << 20])
def test_pieces_of_any_size(monkeypatch, size):
    monkeypatch.setattr(jsonarray, "PIECE_BYTES", size)
    for indent in (None, 2):
        text = " \n" + json.dumps(ELEMENTS, indent=indent, ensure_ascii=False) + "\n"
        assert [json.loads(t) for t in elements(text.encode())] == ELEMENTS
    assert elements(b"") == elements(b" \n ") == elements(b"[]") == elements(b" [ ] ") == []
    assert elements(b'  {"a": "[1, 2]"}') == ['{"a": "[1, 2]"}']
    assert elements(b'[{"a": 1}, {"a": "\\') == ['{"a": 1}', ' {"a": "\\']


def test_packed_beside_plain_files(spark, tmp_path):
    rng, want = random.Random(2), []
    for i, (end, pack) in enumerate([("", bytes), (".gz", gzip.compress), (".bz2", bz2.compress), (".gz", gzip.compress)]):
        rows = [{"i": i, "j": j, "s": "".join(rng.choices('ab"\\[]{},:é', k=rng.randrange(60)))} for j in range(i * 300)]
        want += rows
        (tmp_path / f"p{i}.json{end}").write_bytes(pack(json.dumps(rows, ensure_ascii=i % 2 == 0).encode("utf-8-sig" if i == 3 else "utf-8")))
    (tmp_path / "parts.json.gz").write_bytes(gzip.compress(b'[{"i": 9}, {"i"') + gzip.compress(b': 10}]'))
    got = [json.loads(r.json) for r in jsonarray.array_records(spark, str(tmp_path), 97).collect()]
    assert sorted(map(json.dumps, got)) == sorted(map(json.dumps, want + [{"i": 9}, {"i": 10}]))


def test_packed_round_trip(spark, tmp_path):
    df = spark.range(5000).selectExpr("concat('q', chr(34), id, chr(92), '],') AS question", "string(id) AS sql").repartition(3)
    jsonarray.write_json_array(df, str(tmp_path / "pairs.json"), "gzip")
    back = pairs.load_pairs(spark, str(tmp_path / "pairs.json"))
    assert back.filter("_corrupt_record IS NULL").count() == back.count() == 5000
    assert not back.select("question", "sql").exceptAll(df).count()


def test_ranges_are_read_by_many_tasks(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"n": i} for i in range(2000)]))
    rows = jsonarray.array_records(spark, str(tmp_path / "a.json"), 500)
    assert rows.groupBy(F.spark_partition_id()).count().count() > 8


@pytest.fixture
def quoted(spark, tmp_path):
    """Orders with odd keys, of which several quote one text; a text that comes twice, and one without words."""
    folder = tmp_path / "in"
    keys = [None, -26, -14, -13, -1, *range(2600), 13, 26]
    spark.createDataFrame([(k, k and k % 7, "O") for k in keys], "o_orderkey long, o_custkey long, o_orderstatus string").write.parquet(f"{folder}/orders.parquet")
    docs = [(i, f"{i} {WORDS}" if i % 5 else None) for i in range(40)] + [(39, "again"), (None, "no key")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    return Tables(spark, str(folder)), keys, docs


def test_quoting_orders_meet_their_texts(quoted):
    t, keys, docs = quoted
    want = []
    for k in keys:
        texts = [d for i, d in docs if i is not None and k is not None and k >= 0 and k % 13 == 0 and i == k % 40] or [None]
        cust = None if k is None else str(k % 7)
        for text in texts:
            if k is None:
                q = None  # the words of the last case, about nobody
            elif k % 17 == 0:
                q = None
            elif k % 19 == 0:
                q = " ab "
            elif k % 13 == 0:
                q = text and f"  Show me {text}  "
            else:  # the sign of a rest is that of the number
                q = {0: f"How many orders has customer {cust}?", 1: f"Find the status of customer {cust}"}.get(abs(k) % 3 * (1 if k >= 0 else -1), f"list ALL orders of customer {cust}")
            want.append((k, q))
    got = [(r.pair_id, r.question) for r in raw_pairs(t).select("pair_id", "question").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_statements_stay_out_of_the_join(quoted):
    plan = raw_pairs(quoted[0])._jdf.queryExecution().optimizedPlan().toString()
    assert "SELECT o_orderstatus" in plan and "Join LeftOuter" in plan
    assert "SELECT o_orderstatus" not in plan[plan.index("Join LeftOuter"):]


def test_one_packed_format_at_a_time(quoted, tmp_path, monkeypatch):
    t, keys, docs = quoted
    work, held = tmp_path / "work", []

    def work_folder(spark, name):
        os.makedirs(folder := f"{work}/{name}")
        return folder

    def load(spark, path, real=pairs.load_pairs):
        held.append({d.name: sum(f.stat().st_size for f in d.rglob("part-*")) for d in work.iterdir() if d.name.startswith("pairs-")})
        return real(spark, path)

    monkeypatch.setattr(history, "work_folder", work_folder)
    monkeypatch.setattr(pairs, "load_pairs", load)
    rows = {r.kind: r for r in operations.src04(t).collect()}
    assert [[*x] for x in held] == [["pairs-json"], ["pairs-jsonl"], ["pairs-csv"], [], []]
    chars = raw_pairs(t).agg(F.sum(F.length("question"))).first()[0]
    assert all(size < chars / 4 for x in held for size in x.values())
    n = raw_pairs(t).count()
    assert [rows[k].n for k in ("json", "jsonl", "csv", "xml", "missing")] == [n, n, n, 0, 0]
    assert rows["json"].questions == rows["jsonl"].questions == rows["csv"].questions and rows["json"].sql_chars == rows["csv"].sql_chars
