"""Queries against their SQL on the smallest tables, the others for running."""

import os
from collections import Counter

import pytest

from kithweave.llm import queries

DIR = os.environ.get("KITHWEAVE_TEST_TABLES", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_against_sql(spark, name):
    import duckdb

    c = duckdb.connect()
    for t in os.listdir(DIR):
        c.sql(f"CREATE VIEW {t.removesuffix('.parquet')} AS SELECT * FROM '{DIR}/{t}'")
    df = queries.QUERIES[name](spark, DIR)
    cols = sorted(df.columns)
    res = c.sql(queries.SQL[name])
    assert sorted(res.columns) == cols
    order = [res.columns.index(x) for x in cols]
    assert Counter(map(tuple, df.select(cols).collect())) == Counter(tuple(r[i] for i in order) for r in res.fetchall())


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_runs(spark, name):
    assert queries.QUERIES[name](spark, DIR).count() > 0
