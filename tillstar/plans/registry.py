"""Query registry: key -> callable(spark, sf_dir) -> DataFrame, and key -> oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillstar.operators import marts
from tillstar.plans import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]

_STAR_MARTS = [
    "q1_mom", "q2_success", "q3_fees", "q4_top_wilaya", "q5_top_agency", "q6_opportunity",
    "q7_new_users", "q7_signups_by_month", "q8_retention", "q9_kyc", "q9_account_status",
    "q10_type_mix", "q12_failure_reasons", "q12_failure_reasons_normalized", "q13_category_mix",
    "q14_basket", "q15_merchant_status", "q15_merchant_activity", "kpi_total", "kpi_volume",
    "kpi_success_rate", "viz_monthly_volume", "viz_status_share", "viz_top_wilaya", "viz_type_share",
    "viz_failure_reasons", "mv_daily_kpis", "mv_wilaya_volume",
]
_EVENT_MARTS = ["q11_peak_hours", "viz_peak_hours"]


# Dimension keys of the fact that a mart uses; the other lookups are not joined.
_KEYS = {"user": ("q4_top_wilaya", "q6_opportunity", "q8_retention", "viz_top_wilaya", "mv_wilaya_volume"),
         "merchant": ("q13_category_mix", "q14_basket", "q15_merchant_activity"), "agency": ("q5_top_agency",)}


def _star_query(name: str) -> Query:
    fn = getattr(marts, name)
    keys = tuple(k for k, users in _KEYS.items() if name in users)
    return lambda spark, sf_dir: fn(fx.fixture_star(spark, sf_dir, lookups=keys))


def _event_query(name: str) -> Query:
    fn = getattr(marts, name)
    return lambda spark, sf_dir: fn(fx.event_transactions(spark, sf_dir))


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {}
    for n in _STAR_MARTS:
        q[n] = _star_query(n)
    for n in _EVENT_MARTS:
        q[n] = _event_query(n)
    from tillstar.plans import registry_integrity, registry_ops, registry_serving
    for module in (registry_ops, registry_integrity, registry_serving):
        q.update(module.queries())
    return q


def oracle_sql() -> dict[str, str]:
    from tillstar.plans import oracle_marts, registry_integrity, registry_ops, registry_serving
    sql = dict(oracle_marts.SQL)
    for module in (registry_ops, registry_integrity, registry_serving):
        sql.update(module.oracle_sql())
    return sql
