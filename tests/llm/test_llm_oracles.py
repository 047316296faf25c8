"""The operators' queries against their SQL on the smallest tables."""

import pytest
from test_oracles import SF_SMALL, _rows

from saleslens.llm import queries


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", sorted(queries.oracle_sql()))
def test_query_matches_oracle(spark, duck, key):
    df = queries.queries()[key](spark, SF_SMALL)
    rel = duck.sql(queries.oracle_sql()[key])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(rel.columns, rel.fetchall())
