import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from workload.oracle import ORACLES
from workload.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "customer orders part nation events".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def normal(value):
    if getattr(value, "tzinfo", None) is not None:
        value = value.replace(tzinfo=None)
    return repr(value + 0.0) if isinstance(value, float) else str(value)


def test_every_query_but_one_has_sql():
    assert set(QUERIES) - set(ORACLES) == {"kmeans_ml"}
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry_has_nine_cells(spark):
    assert entry_points.entry(spark).count() == 9


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted(tuple(normal(v) for v in row) for row in result.fetchall())
    got = sorted(tuple(normal(row[n]) for n in names) for row in df.collect())
    assert got == want
