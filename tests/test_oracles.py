"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import importlib
import math
from pathlib import Path

import duckdb
import pytest

entry = importlib.import_module("__spark_entry__")
queries = importlib.import_module("rxsieve.workload.queries").QUERIES
DATA = Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    yield con
    con.close()


def comparable(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def sorted_rows(rows, names):
    order = [names.index(n) for n in sorted(names)]
    return sorted(repr([comparable(r[i]) for i in order]) for r in rows)


def test_every_query_has_its_sql():
    assert set(queries) <= set(entry.queries())
    assert set(queries) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries))
def test_query(spark, duck, name):
    frame = queries[name](spark, str(DATA))
    result = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    assert sorted(frame.columns) == sorted(names)
    assert expected, "the query should find something"
    assert sorted_rows(frame.collect(), frame.columns) == sorted_rows(expected, names)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not [op for op in ("CartesianProduct", "NestedLoop", "BatchEvalPython", "ArrowEvalPython") if op in plan]


def test_entry(spark):
    assert entry.entry(spark).count() > 0
