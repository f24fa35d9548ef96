"""Every registered query against its SQL, and the shape of its plan."""

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, canonical
from checks import registry

QUERIES = registry.QUERIES
ORACLES = registry.ORACLES

#: Row-at-a-time Python and products of tables have no place in a plan.
FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.fixture(scope="session")
def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in FORBIDDEN if x in plan]
    got = df.toPandas()
    if name in ORACLES:
        want = duck.execute(ORACLES[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert canonical(got) == canonical(want)


def test_entry(spark):
    assert entry.entry(spark).count() == 9
