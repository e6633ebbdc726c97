"""Queries against their SQL on the smallest tables, and the package without its optional part."""

import importlib
import os
import sys
from collections import Counter

import pytest

import __spark_entry__ as entry
from kithweave import queries

DIR = os.environ.get("KITHWEAVE_TEST_TABLES", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")


def normal(v):
    if isinstance(v, float):
        return None if v != v else round(v, 8)
    return v


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_against_sql(spark, name):
    import duckdb

    c = duckdb.connect()
    for t in os.listdir(DIR):
        c.sql(f"CREATE VIEW {t.removesuffix('.parquet')} AS SELECT * FROM '{DIR}/{t}'")
    df = queries.QUERIES[name](spark, DIR)
    cols = sorted(df.columns)
    got = Counter(tuple(normal(v) for v in r) for r in df.select(cols).collect())
    res = c.sql(queries.SQL[name])
    assert sorted(res.columns) == cols
    order = [res.columns.index(x) for x in cols]
    want = Counter(tuple(normal(r[i]) for i in order) for r in res.fetchall())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_runs(spark, name):
    assert queries.QUERIES[name](spark, DIR).count() >= 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_core_stands_alone(monkeypatch):
    """Without the optional subpackage the entry points still work."""
    for m in [m for m in sys.modules if m.startswith("kithweave.llm")]:
        monkeypatch.delitem(sys.modules, m)
    real = importlib.import_module

    def gone(name, *a):
        if name.startswith("kithweave.llm"):
            raise ModuleNotFoundError("gone", name="kithweave.llm")
        return real(name, *a)

    monkeypatch.setattr(importlib, "import_module", gone)
    assert "p6_found" in entry.queries() and "p3_found" not in entry.queries() and "p6_found" in entry.oracle_sql()
