"""Every registered query against its DuckDB oracle on the smallest data set."""
import datetime as dt
import decimal
import math
import os

import pytest

from conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _keys():
    from saleslens import catalog
    return sorted(catalog.oracle_sql())


@pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test data missing")
@pytest.mark.parametrize("key", _keys())
def test_query_matches_oracle(spark, duck, key):
    import __spark_entry__ as E
    df = E.queries()[key](spark, SF_SMALL)
    rel = duck.sql(E.oracle_sql()[key])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(rel.columns, rel.fetchall())


def test_entry_runs(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() >= 0 and "CurrentGoalToDate" in df.columns
