"""Marts come in the order their contract names (the result comparison ignores order)."""

import pytest

from conftest import SF_SMALL
from tillstar.plans.check import duck
from tillstar.plans.registry import oracle_sql, queries

ORDERED = ["q4_top_wilaya", "q5_top_agency", "q7_signups_by_month", "q8_retention", "q9_kyc", "q9_account_status",
           "q10_type_mix", "q11_peak_hours", "q12_failure_reasons", "q13_category_mix", "q14_basket", "q15_merchant_status",
           "viz_monthly_volume", "viz_status_share", "viz_top_wilaya", "viz_peak_hours", "viz_type_share", "viz_failure_reasons"]


@pytest.mark.parametrize("key", ORDERED)
def test_rows_come_in_contract_order(spark, key):
    df = queries()[key](spark, SF_SMALL)
    want = duck(SF_SMALL).sql(oracle_sql()[key])
    first = df.columns[0]
    assert [r[first] for r in df.collect()] == [r[want.columns.index(first)] for r in want.fetchall()]


def test_opportunity_goes_by_class_then_users(spark):
    rank = {"Fort potentiel": 1, "Potentiel modéré": 2, "Déjà performante": 3}
    rows = [(rank[r.opportunite], -r.nb_utilisateurs) for r in queries()["q6_opportunity"](spark, SF_SMALL).collect()]
    assert rows == sorted(rows)
