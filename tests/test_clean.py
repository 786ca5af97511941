"""Catalog cleaning: gaps, hot values, odd names, empty tables, both plans and both formats."""

import datetime as dt
import statistics

import pytest
from pyspark.sql import functions as F

from querywright.operators import clean


def test_fills_agree_in_both_plans(spark, tmp_path):
    """A third of all rows hold one value; values tie and repeat."""
    rows = [(7.0 if i % 3 == 0 else float(i % 50), "hot" if i % 3 == 0 else f"t{i % 40}", None) for i in range(3001)]
    df = spark.createDataFrame(rows + [(None, None, None)] * 5, "x double, s string, empty double")
    one = clean.fill_values(df, ["x", "empty"], ["s"], distributed=False)
    far = clean.fill_values(df, ["x", "empty"], ["s"], distributed=True, folder=str(tmp_path / "counts"))
    assert one == far == {"x": statistics.median(r[0] for r in rows), "s": "hot"}


@pytest.mark.parametrize("values, median", [([1.0, 2.0], 1.5), ([3.0], 3.0), ([1.0, 1.0, 9.0, 9.0], 5.0), ([-2.0, 5.0, 5.0], 5.0)])
def test_median_of_few(spark, values, median):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert clean.fill_values(df, ["x"], []) == {"x": median}


def test_mode_takes_the_smallest_on_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "s string")
    assert clean.fill_values(df, [], ["s"]) == {"s": "a"}


ROWS = [(1, 4, " A ", "2024-01-15 10:00:00", [1, 2], 9), (1, 4, " A ", "2024-01-15 10:00:00", [1, 2], 9),
        (2, None, None, "no date", None, 9), (3, 8, "a", None, [3], 9), (None, 8, " A ", "2024-01-15 10:00:00", [], 9)]
SCHEMA = "id long, `n.x` int, s string, start_date string, xs array<int>, _copies int"


@pytest.mark.parametrize("format", ["parquet", "csv"])
def test_clean_table(spark, tmp_path, format):
    df = spark.createDataFrame(ROWS, SCHEMA)
    stats = clean.clean_catalog({"t": df, "none": df.limit(0)}, str(tmp_path), {"t": ["id"]}, format=format)
    got = {r.table_name: r.asDict() for r in stats.collect()}
    # left empty: the key, a date that does not parse, the list; csv reads an empty list's text back
    assert got["t"] == {"table_name": "t", "original_rows": 5, "final_rows": 4, "duplicates_removed": 1, "original_nulls": 5,
                        "final_nulls": 3, "columns": 6}
    assert got["none"]["original_rows"] == got["none"]["final_rows"] == got["none"]["final_nulls"] == 0
    assert got["TOTAL"]["original_rows"] == 5 and got["TOTAL"]["columns"] == 12
    if format == "parquet":
        rows = clean.read_clean(spark, str(tmp_path), "t").orderBy(F.col("id").asc_nulls_last()).collect()
        assert [r["n.x"] for r in rows] == [4.0, 8.0, 8.0, 8.0]
        assert [r.s for r in rows] == ["a", "a", "a", "a"]  # the mode is found before trimming
        assert [r.start_date for r in rows] == [dt.datetime(2024, 1, 15, 10), None, *[dt.datetime(2024, 1, 15, 10)] * 2]
        assert rows[0]["_copies"] == 9 and rows[1].xs is None


def test_dates_first_leaves_missing_dates_null(spark, tmp_path):
    stats = clean.clean_catalog({"t": spark.createDataFrame(ROWS, SCHEMA)}, str(tmp_path), {"t": ["id"]}, dates_first=True)
    assert stats.filter("table_name = 't'").first().final_nulls == 4


def test_columns_without_gaps_keep_their_type(spark, tables, tmp_path):
    clean.clean_catalog({"nation": tables.nation}, str(tmp_path))
    assert clean.read_clean(spark, str(tmp_path), "nation").dtypes == tables.nation.dtypes


def test_source_is_read_once(spark, tmp_path):
    path, reads = str(tmp_path / "src"), spark.sparkContext.accumulator(0)
    spark.createDataFrame([(1, None), (1, None), (2, 5)], "id int, x int").coalesce(1).write.parquet(path)

    def seen(parts):
        for p in parts:
            reads.add(p.num_rows)
            yield p

    df = spark.read.parquet(path).mapInArrow(seen, "id int, x int")
    clean.clean_catalog({"t": df}, str(tmp_path / "out"), {"t": ["id"]}).collect()
    assert reads.value == 3
