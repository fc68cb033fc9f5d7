"""Sketches, policy views, co-located tables, observed writes."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tillstar.operators import colocated, governance, observed, sketches
from tillstar.operators.policy_views import create_policy_views
from tillstar.plans import fixtures as fx
from tillstar.plans.pipeline import load_report, load_star
from tillstar.session import fresh_path
from test_plans import plan

DAY = dt.date(2024, 3, 1)


def rows_of_days(spark):
    rng = random.Random(1)
    rows = [("hot" if rng.random() < 0.7 else "cold", DAY + dt.timedelta(days=rng.randint(0, 70)), rng.randint(0, 9000), rng.random() * 1000) for _ in range(30_000)]
    rows += [(None, DAY, 1, 5.0), ("hot", None, 2, 7.0), ("none", DAY, None, None)]
    return rows, spark.createDataFrame(rows, "k string, d date, u long, v double")


def test_sketches_keep_their_bounds_over_any_range(spark):
    rows, df = rows_of_days(spark)
    path = sketches.write_daily(df, ["k"], "d", fresh_path(spark, "t"), distinct="u", quantile="v")
    for first, last in (("2024-03-01", "2024-05-31"), ("2024-03-15", "2024-04-02"), ("2024-04-10", "2024-04-10")):
        daily = sketches.read_range(spark, path, first, last)
        inside = [r for r in rows if r[1] and first <= r[1].isoformat() <= last]
        for r in sketches.distinct_over(daily, ["k"]).collect():
            exact = len({u for k, _, u, _ in inside if k == r.k and u is not None})
            assert abs(r.nb_distinct - exact) <= max(1, sketches.DISTINCT_ERROR * exact)
        for p in (0.1, 0.5, 0.9):
            for r in sketches.quantile_over(daily, ["k"], p).collect():
                values = [v for k, _, _, v in inside if k == r.k and v is not None]
                assert (r.quantile is None) == (not values)
                if values:
                    assert sum(v < r.quantile for v in values) / len(values) <= p + sketches.RANK_ERROR
                    assert sum(v <= r.quantile for v in values) / len(values) >= p - sketches.RANK_ERROR


def test_a_new_range_reads_sketches_of_its_months_only(spark):
    _, df = rows_of_days(spark)
    path = sketches.write_daily(df, ["k"], "d", fresh_path(spark, "t"), distinct="u")
    p = plan(sketches.distinct_over(sketches.read_range(spark, path, "2024-04-10", "2024-04-20"), ["k"]))
    assert "PartitionFilters: [isnotnull(mois" in p and p.count("FileScan") == 1 and "u#" not in p.split("FileScan")[1]


# ------------------------------------------------------------------ policy views
@pytest.fixture(scope="module")
def star(spark):
    return fx.fixture_star(spark, SF_SMALL, lookups=("user",))


def views(spark, star, rows, prefix):
    me = spark.sql("SELECT current_user()").first()[0]
    profiles = spark.createDataFrame([(login or me, region, role) for login, region, role in rows], "login string, wilaya_id long, role string")
    return create_policy_views(spark, star.fact, star.user, profiles, prefix)


def test_policy_views_equal_the_row_filter(spark, star):
    fact, users = views(spark, star, [(None, 3, "chef_agence"), ("other", 5, "chef_agence")], "t1")
    want = governance.rls_filter(star.fact, star.user, spark.createDataFrame([("me", 3)], "login string, wilaya_id long"), "me", "chef_agence")
    assert sorted(r.tx_pk for r in spark.sql(f"SELECT tx_pk FROM {fact}").collect()) == sorted(r.tx_pk for r in want.collect())
    seen = spark.sql(f"SELECT wilaya_id, phone, nni, email FROM {users}").collect()
    assert {r.wilaya_id for r in seen} == {3} and all(r.phone.startswith("***-****-") and r.nni == "**********" for r in seen)
    assert any(r.email is None for r in seen) or all(r.email.startswith("****@") for r in seen)


@pytest.mark.parametrize("role, rows, masked", [("directeur_general", "all", False), ("dpo", "region", False), ("analyste_junior", "region", True)])
def test_roles(spark, star, role, rows, masked):
    fact, users = views(spark, star, [(None, 4, role)], f"t_{role}")
    seen = spark.sql(f"SELECT wilaya_id, nni FROM {users}").collect()
    assert (len({r.wilaya_id for r in seen}) > 1) == (rows == "all")
    assert all((r.nni == "**********") == masked for r in seen) and seen
    assert (spark.sql(f"SELECT 1 FROM {fact}").count() == star.fact.count()) == (rows == "all")


def test_a_login_without_profile_sees_nothing_and_several_regions_add_up(spark, star):
    fact, users = views(spark, star, [("other", 4, "directeur_general")], "t2")
    assert spark.sql(f"SELECT * FROM {fact}").count() == 0 and spark.sql(f"SELECT * FROM {users}").count() == 0
    _, users = views(spark, star, [(None, 4, "chef_agence"), (None, 5, "chef_agence")], "t3")
    assert {r.wilaya_id for r in spark.sql(f"SELECT wilaya_id FROM {users}").collect()} == {4, 5}


# ------------------------------------------------------------------ co-located tables
def test_bucketed_join_has_no_exchange_below_the_region_sum(spark, star):
    fact = colocated.write_bucketed(star.fact.select("user_key", "amount"), "t_fact", "user_key", buckets=4)
    users = colocated.write_bucketed(star.user.select("user_key", "wilaya_id", "wilaya_name", "is_current"), "t_users", "user_key", buckets=4)
    out = colocated.region_volume(fact, users)
    p = plan(out)
    assert "SortMergeJoin" in p and p.count("Exchange") == 1 and p.index("Exchange") < p.index("SortMergeJoin")
    want = {r.wilaya_id: r.n for r in star.fact.join(star.user, "user_key").groupBy("wilaya_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert {r.wilaya_id: r.nb_transactions for r in out.collect()} == want


# ------------------------------------------------------------------ observed writes
def test_observed_write_counts_what_it_wrote(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (None, None)], "a int, b string").repartition(3)
    path = fresh_path(spark, "t")
    got = observed.observed_write(df, lambda rows: rows.write.parquet(path), nulls=True, big=F.sum(F.when(F.col("a") > 1, 1).otherwise(0)))
    assert got == {"_rows": 3, "a": 1, "b": 2, "big": 1} and spark.read.parquet(path).count() == 3
    empty = observed.observed_write(df.limit(0), lambda rows: rows.write.parquet(f"{path}-e"), nulls=True)
    assert empty == {"_rows": 0, "a": 0, "b": 0}


def test_load_report_reads_no_table_again(spark):
    staging = fx.staging_with_gaps(spark, SF_SMALL)
    root = fresh_path(spark, "t-star")
    star = load_star(spark, SF_SMALL, root, staging)
    got = {r.table_name: r.nb for r in load_report(spark, root).collect()}
    for name in ("user", "merchant", "agency", "node", "date"):
        assert got[f"dim_{name}"] == getattr(star, name).count()
    assert got["fact_transactions"] == star.fact.count() > 0
    assert got["stg_transactions"] == staging["transactions"].count() == got["fact_transactions"] + got["dropped_unknown_node"]
    assert got["dropped_unknown_node"] == staging["transactions"].filter("node_id = 'NKC-NODE-9'").count() > 0
    assert "FileScan" not in plan(load_report(spark, root)).replace("_load_report", "") or plan(load_report(spark, root)).count("FileScan") == 1
