"""JSON arrays in ranges: any border must give the same elements."""

import json
import random

import pytest

from querywright.sources import jsonarray, pairs

ELEMENTS = [{"a": "plain", "n": 1}, {"a": "quote \" and \\ and ] } , [ {", "n": [1, [2, {"x": "],"}]]}, {"a": "\\" * 9 + "\"", "n": None},
            {"a": "größe 漢字 😀", "n": 2}, {}, {"a": "long " * 400, "n": 3}, 7, "a, text ]", None, [1, 2], {"a": "\n\t", "n": 4}]


def read(spark, path, size):
    return sorted(json.dumps(json.loads(r.json)) for r in jsonarray.array_records(spark, str(path), size).collect())


@pytest.mark.parametrize("size", [1, 2, 3, 7, 64, 1000, 1 << 20])
@pytest.mark.parametrize("indent", [None, 2])
def test_any_range(spark, tmp_path, size, indent):
    some = ELEMENTS if size > 3 else ELEMENTS[:5] + ELEMENTS[6:]
    (tmp_path / "a.json").write_text(" \n" + json.dumps(some, indent=indent, ensure_ascii=False) + "\n", encoding="utf-8")
    assert read(spark, tmp_path / "a.json", size) == sorted(map(json.dumps, some))


def test_many_files(spark, tmp_path):
    rng, want = random.Random(1), []
    for i in range(6):
        rows = [{"i": i, "j": j, "s": "".join(rng.choices('ab"\\[]{},:é', k=rng.randrange(60)))} for j in range(i * 40)]
        want += rows
        (tmp_path / f"p{i}.json").write_text(json.dumps(rows, ensure_ascii=i % 2 == 0), encoding="utf-8-sig" if i == 3 else "utf-8")
    (tmp_path / "empty.json").write_text("")
    (tmp_path / "blank.json").write_text(" \n")
    assert read(spark, tmp_path, 97) == sorted(map(json.dumps, want))


def test_long_runs_of_backslashes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jsonarray, "READ_ON", 4)  # the run is longer than one look back
    rows = [{"a": "\\" * 301 + '"'}, {"a": '","'}]
    (tmp_path / "a.json").write_text(json.dumps(rows))
    with open(tmp_path / "a.json", "rb") as f:
        data = f.read()
    with jsonarray._open(str(tmp_path / "a.json")) as file:
        whole = jsonarray._plain(file, 0, len(data))
        assert all(jsonarray._plain(file, i, len(data)).endswith(whole[i + 1:]) for i in range(len(data) - 1))
    assert read(spark, tmp_path / "a.json", 50) == sorted(map(json.dumps, rows))


def test_no_array_and_cut_off(spark, tmp_path):
    (tmp_path / "one.json").write_text('{"question": "q"}')
    assert [r.question for r in pairs.load_pairs(spark, str(tmp_path / "one.json")).collect()] == ["q"]
    (tmp_path / "cut.json").write_text('[{"question": "q"}, {"question": "un')
    rows = pairs.load_pairs(spark, str(tmp_path / "cut.json")).collect()
    assert [r.question for r in rows if r._corrupt_record is None] == ["q"] and sum(r._corrupt_record is not None for r in rows) == 1


def test_suffixes(spark, tmp_path):
    for name in ("missing.json", "missing.csv", "x.xml", "none"):
        assert pairs.load_pairs(spark, str(tmp_path / name)).count() == 0


def test_round_trip(spark, tmp_path):
    df = spark.range(500).selectExpr("id", "concat('t', chr(34), id, chr(92), '],') AS s").repartition(3)
    jsonarray.write_json_array(df, str(tmp_path / "out"))
    back = jsonarray.read_json_array(spark, str(tmp_path / "out"), "id long, s string", range_bytes=200)
    assert back.filter("_corrupt_record IS NULL").count() == back.count() == 500
    assert not back.select("id", "s").exceptAll(df).count()


def test_paths_only_spark_opens(spark, tmp_path):
    """A mounted path is read by Spark's own reader."""
    (tmp_path / "a.json").write_text('[{"question": "q"}, {"question": "r"}]')
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.pairs.link./in", f"file://{tmp_path}")
    assert not jsonarray.opens("viewfs://pairs/in/a.json")
    assert sorted(r.question for r in pairs.load_pairs(spark, "viewfs://pairs/in/a.json").collect()) == ["q", "r"]
