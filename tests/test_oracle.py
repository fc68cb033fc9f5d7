"""Every registered query against its DuckDB oracle (row count, columns, values)."""

import pytest

from conftest import SF_SMALL
from tillstar.plans.check import _rows, duck
from tillstar.plans.registry import oracle_sql, queries

QUERIES = queries()
SQLS = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    df = QUERIES[key](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    if key not in SQLS:
        assert len(df.columns) > 0
        return
    res = con.sql(SQLS[key])
    assert sorted(df.columns) == sorted(res.columns)
    assert _rows(df.columns, rows) == _rows(res.columns, res.fetchall())


def test_every_key_has_an_oracle():
    assert set(QUERIES) == set(SQLS)


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.queries()) >= set(QUERIES)
