"""Operators that SQL can express, against DuckDB over the same small tables."""

import pytest

from tillstar.llm.queries import oracle_sql, queries
from tillstar.plans.check import _rows, duck

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(oracle_sql()))
def test_query_matches_oracle(spark, key):
    df = queries()[key](spark, SMALL)
    want = duck(SMALL).sql(oracle_sql()[key])
    assert sorted(df.columns) == sorted(want.columns)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(want.columns, want.fetchall())


def test_every_operator_is_registered_once():
    assert sorted(int(k[2:].split("_")[0]) for k in queries()) == list(range(1, 14))
