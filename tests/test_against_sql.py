"""Every query with a SQL twin, compared on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from check_oracle import compare
from querywright.sources.tables import NAMES
from tests.conftest import FOLDER

PLANS, SQLS = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for name in NAMES:
        c.sql(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return c


def test_every_sql_has_a_plan():
    assert not set(SQLS) - set(PLANS)


@pytest.mark.parametrize("name", sorted(PLANS))
def test_query(name, spark, con):
    df = PLANS[name](spark, FOLDER)
    if name in SQLS:
        problems, _ = compare(df, con, SQLS[name])
        assert not problems
    else:
        assert df.count() > 0
