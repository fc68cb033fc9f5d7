"""Physical plan properties the scale design relies on."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tillstar.operators import marts
from tillstar.plans import fixtures as fx
from tillstar.session import fresh_path
from tillstar.sources import landing


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_prunes_columns_and_pushes_filters(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    p = plan(li.filter(F.col("l_returnflag") == "R").select("l_orderkey", "l_extendedprice"))
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_returnflag:string>" in p
    # ``load`` adds nothing above the scan.
    p2 = plan(fx.load(spark, SF_SMALL, "lineitem").filter(F.col("l_returnflag") == "R").select("l_extendedprice"))
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in p2
    assert "l_tax" not in p2 and "l_shipdate" not in p2


def test_calendar_is_broadcast(spark):
    star = fx.fixture_star(spark, SF_SMALL)
    p = plan(marts.viz_monthly_volume(star))
    assert "BroadcastHashJoin" in p and "BroadcastExchange" in p


def test_region_mart_aggregates_before_the_user_join(spark):
    star = fx.fixture_star(spark, SF_SMALL)
    df = marts.q4_top_wilaya(star)
    lp = df._jdf.queryExecution().optimizedPlan().toString()
    # The per-user partial aggregate sits below the join with the user dimension.
    join_at = lp.index("Join Inner")
    assert "Aggregate [user_key" in lp[join_at:]


def test_layout_read_prunes_month_partitions(spark):
    star = fx.fixture_star(spark, SF_SMALL)
    path = landing.write_fact_layout(star.fact, fresh_path(spark, "test-layout"))
    df = spark.read.parquet(path).filter(F.col("tx_month").between(199601, 199603)).select("amount")
    p = plan(df)
    assert "PartitionFilters: [isnotnull(tx_month" in p
    assert df.count() == star.fact.filter(F.year("transaction_date") == 1996).filter(
        F.month("transaction_date") <= 3).count()


def test_dedup_is_a_partial_aggregate(spark):
    p = plan(fx.fx_tx(spark, SF_SMALL))
    assert "partial_min" in p and "Window" not in p


def test_retention_has_no_self_join(spark):
    star = fx.fixture_star(spark, SF_SMALL)
    lp = marts.q8_retention(star)._jdf.queryExecution().optimizedPlan().toString()
    lp_fact = star.fact._jdf.queryExecution().optimizedPlan().toString()
    # The month-to-month link is one aggregate: no join beyond the fact's own lookups
    # and the calendar.
    assert lp.count("LeftOuter") == lp_fact.count("LeftOuter")
    assert lp.count("Join Inner") == lp_fact.count("Join Inner") + 1


def test_load_star_pipeline_writes_checked_star(spark):
    from tillstar.plans.pipeline import load_star
    root = fresh_path(spark, "test-load")
    star = load_star(spark, SF_SMALL, root)
    mem = fx.fixture_star(spark, SF_SMALL)
    report = {r["table_name"]: r["nb"] for r in spark.read.parquet(f"{root}/_load_report").collect()}
    assert report["fact_transactions"] == mem.fact.count() == star.fact.count()
    assert report["dim_user"] == mem.user.count() + 1 and report["dropped_unknown_node"] == 0
    assert set(spark.read.parquet(f"{root}/fact").columns) >= {"tx_month", "amount", "transaction_date"}
    # same marts on the written star as on the in-memory star
    assert sorted(marts.q10_type_mix(star).collect()) == sorted(marts.q10_type_mix(mem).collect())


def fact_scans(df) -> int:
    """Scans of lineitem that run: in the final plan, outside reused exchanges."""
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return sum("FileScan" in line and "l_extendedprice" in line for line in final.splitlines())


def test_shares_and_orphans_read_the_fact_once(spark):
    for name in ("q4_top_wilaya", "q10_type_mix", "q13_category_mix", "q14_basket", "viz_type_share"):
        assert fact_scans(getattr(marts, name)(fx.fixture_star(spark, SF_SMALL))) == 1, name
    from tillstar.operators import quality
    star = fx.fixture_star(spark, SF_SMALL)
    root = landing.write_fact_layout(star.fact, fresh_path(spark, "orphans"))
    df = quality.orphans(star.with_fact(spark.read.parquet(root)))
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert sum("FileScan" in line and "agency_key" in line and "date_key" in line for line in final.splitlines()) == 1


def test_refresh_reads_the_touched_months_only(spark):
    from tillstar.operators import refresh
    root = landing.write_fact_layout(fx.fixture_star(spark, SF_SMALL).fact, fresh_path(spark, "refresh"))
    p = plan(refresh.fact_of_months(spark.read.parquet(root), [199601, 199602]))
    assert "PartitionFilters: [tx_month" in p and "PartitionFilters: []" not in p


def test_builders_start_no_job(spark):
    star = fx.fixture_star(spark, SF_SMALL)
    spark.sparkContext.setJobGroup("lazy", "builders")
    for name in ("q14_basket", "q13_category_mix", "q6_opportunity", "q12_failure_reasons"):
        getattr(marts, name)(star)
    started = spark.sparkContext.statusTracker().getJobIdsForGroup("lazy")
    spark.sparkContext.setJobGroup("", "")
    assert not list(started)


def test_a_repeated_natural_id_stops_the_load(spark):
    import pytest

    from tillstar.plans.pipeline import load_star
    staging = fx.staging_with_gaps(spark, SF_SMALL)
    merchants = staging["merchants"]
    staging["merchants"] = merchants.unionByName(merchants.limit(1))
    with pytest.raises(AssertionError, match="dim_merchant"):
        load_star(spark, SF_SMALL, fresh_path(spark, "test-load"), staging)


def test_lookup_files_round_trip(spark):
    from tillstar.sources import lookups
    for name, rows in lookups.ROWS.items():
        path = lookups.write_lookup(spark, name, fresh_path(spark, name))
        assert [tuple(r) for r in lookups.read_lookup(spark, name, path).orderBy("id").collect()] == rows
