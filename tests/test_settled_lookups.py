"""What a load that writes the fact shuffles: lookups on distinct ids, base columns only, order columns once; on rows built here."""

import datetime as dt

from conftest import SF_SMALL
from pyspark.sql import functions as F
from tillstar.operators.dedup import latest_per_key
from tillstar.operators.star import build_dim_node, build_fact, derived_columns, settle_lookups
from tillstar.plans import fixtures as fx
from tillstar.plans import pipeline
from tillstar.session import fresh_path
from tillstar.sources import landing, schemas


def staging(spark, rows):
    """(id, user, merchant, agency, node) rows in the staging shape."""
    given = "id source_user_id merchant_id agency_id node_id".split()
    rest = {"amount": "10.50", "fee": " ", "status": "SUCCESS", "sync_status": "SYNCED", "datacenter": "DC-NDB", "transaction_type": "PAY",
            "transaction_date": "2024-02-03", "transaction_time": "07:30:00"}
    return spark.createDataFrame([tuple({**rest, **dict(zip(given, r))}.get(f.name) for f in schemas.STG_TRANSACTIONS) for r in rows], schemas.STG_TRANSACTIONS)


def dimensions(spark):
    user = spark.createDataFrame([(1, 1, True), (2, 2, True), (2, 2, True), (3, 3, False), (4, 40, True), (5, None, True), (None, 6, True), (-1, -1, True)],
                                 "user_id long, user_key long, is_current boolean")
    merchant = spark.createDataFrame([(1, 1), (2, 2), (-1, -1)], "merchant_id long, merchant_key long")
    return user, merchant, spark.createDataFrame([(1, 1), (7, 7), (7, 70)], "agency_id long, agency_key long"), build_dim_node(spark)


ROWS = [(1, "1", "1", "1", "NDB-NODE-1"), (2, "2", "2", None, "NDB-NODE-1"), (3, "3", None, "7", "NKC-NODE-1"), (4, "4", "99", "1", "NKC-NODE-2"),
        (5, "5", None, None, "NDB-NODE-2"), (6, "6", "1", "8", "NDB-NODE-1"), (7, None, None, None, "NDB-NODE-1"), (8, "1", "1", "1", "NKC-NODE-9"),
        (9, "-1", "-1", "-1", "NDB-NODE-1"), (None, "1", None, "1", "NDB-NODE-1"), (10, "-5", None, "7", "NDB-NODE-1"), (10, "1", "2", None, "NDB-NODE-1"),
        (11, "77", "77", "77", "NKC-NODE-9"), (12, "1", None, None, None)]


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_settled_lookups_give_the_rows_of_the_joins(spark):
    stg, dims = staging(spark, ROWS), dimensions(spark)
    settled = settle_lookups(stg, *dims, fresh_path(spark, "settled"))
    assert found(settled) == sorted([("user", 2, 2), ("user", 2, 2), ("user", 3, None), ("user", 4, 40), ("user", 5, None), ("user", 6, None),
                                     ("user", -5, None), ("merchant", 99, None), ("agency", 7, 7), ("agency", 7, 70), ("agency", 8, None),
                                     ("agency", -1, None)], key=str)
    plain = build_fact(stg, *dims)
    assert plain.count() == 14  # ids 2, 3 and one of 10 fan out, 8, 11 and 12 have no node
    assert found(build_fact(stg, *dims, settled=settled)) == found(plain)
    some = settle_lookups(stg, *dims, fresh_path(spark, "settled"), ("agency",))
    assert found(build_fact(stg, *dims, lookups=("agency",), settled=some)) == found(build_fact(stg, *dims, lookups=("agency",)))


def test_a_settled_fact_is_not_shuffled_for_its_lookups(spark):
    rows = spark.range(4000)
    stg = staging(spark, [(None, None, None, None, None)]).drop("id", "source_user_id", "merchant_id", "agency_id", "node_id")
    stg = rows.select("id", F.col("id").cast("string").alias("source_user_id"), F.col("id").cast("string").alias("merchant_id"),
                      F.col("id").cast("string").alias("agency_id"), F.lit("NDB-NODE-1").alias("node_id")).crossJoin(stg)
    dims = [rows.filter("id <> 9").select(F.col("id").alias(f"{n}_id"), F.col("id").alias(f"{n}_key"), F.lit(True).alias("is_current")) for n in fx.LOOKUPS]
    nodes = build_dim_node(spark)
    settled = settle_lookups(stg, *dims, nodes, fresh_path(spark, "settled"))
    assert found(settled) == [("agency", 9, None), ("merchant", 9, None), ("user", 9, None)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "8000")
    try:
        plan = lambda f: f._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning" in plan(build_fact(stg, *dims, nodes))
        assert "hashpartitioning" not in plan(build_fact(stg, *dims, nodes, settled=settled))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_the_layout_shuffles_base_columns_and_writes_them_all(spark):
    stg, dims, seen = staging(spark, ROWS), dimensions(spark), []
    fact = build_fact(stg, *dims)
    path = landing.write_fact_layout(fact, fresh_path(spark, "layout"), watch=lambda rows: seen.append(rows) or rows, derived=derived_columns())
    written = spark.read.parquet(path)
    assert written.columns == [*fact.columns, "tx_month"]
    assert found(written.drop("tx_month")) == found(fact)
    sent = seen[0]._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression", 1)[1]
    assert not any(f" AS {c}#" in sent for c in derived_columns()) and " AS tx_month#" in sent


def test_descending_order_columns_are_sent_once_and_restored(spark):
    t = dt.datetime(1901, 2, 3, 4, 5, 6, 789)
    rows = [(1, t, t, dt.date(1950, 1, 2), 5, 1.5, True, "a"), (1, None, None, None, None, None, None, "b"),
            (2, None, t, None, -7, float("nan"), False, "c"), (3, t, None, dt.date(2030, 1, 1), None, -0.25, None, "d"),
            (4, t, t, None, 5, 1.5, True, "x"), (4, t, t, None, 5, 1.5, None, "w")]
    df = spark.createDataFrame(rows, "k int, n timestamp_ntz, z timestamp, d date, i short, x double, b boolean, rest string")
    df = df.withColumn("m", F.col("x").cast("string").try_cast("decimal(9,3)"))
    best = latest_per_key(df, ["k"], [(c, True) for c in ("n", "z", "d", "i", "x", "m", "b")])
    assert best.schema.simpleString() == df.schema.simpleString()
    want = [r for r in found(df) if r[7] in "acdx"]
    assert str(found(best)) == str(want)
    for c in ("n", "z", "d"):
        one = latest_per_key(df.select("k", c, "rest"), ["k"], [(c, True)])
        sent = one._jdf.queryExecution().analyzed().toString().split("Aggregate", 1)[1]
        assert "_row, struct(rest, rest#" in sent and f"{c}, {c}#" not in sent.split("\n")[0].split("min(")[1]


def test_versions_of_one_id_from_several_orders_keep_their_order(spark):
    day = dt.datetime(1995, 1, 2)
    li = spark.createDataFrame([(ok, 7, 8, ln, 1.0, 10.0, 0.02, "N", day) for ok, ln in ((1, 9), (2, 1), (3, -7), (5, 3), (None, 2))],
                               "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                               "l_tax double, l_returnflag string, l_shipdate timestamp_ntz")
    orders = spark.createDataFrame([(k, 100 + k, day) for k in (1, 2, 3, 5)], "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz")
    assert [(r.tx_id, r.user_key) for r in fx._with_orders(fx._versions(li), orders).sort("tx_id", "user_key").collect()] == [
        (17, 101), (17, 102), (17, 103), (43, 105)]
    latest = latest_per_key(fx._versions(li), ["tx_id"], fx.VERSION_ORDER)
    assert [(r.tx_id, r.user_key, r.transaction_type) for r in fx._with_orders(latest, orders).sort("tx_id").collect()] == [
        (17, 101, "SAL"), (43, 105, "WIT")]
    assert "l_orderkey" not in fx._versions(li).columns


def test_the_load_looks_distinct_ids_up_and_stages_gzip_text(spark):
    root = fresh_path(spark, "settled-load")
    star = pipeline.load_star(spark, SF_SMALL, root, fx.staging_with_gaps(spark, SF_SMALL))
    assert found(spark.read.parquet(f"{root}/_lookups")) == [("user", 999999999999, None)]
    assert star.fact.filter("user_key = -1").count() == star.fact.filter("tx_pk % 71 = 0").count() > 0
    files = spark.read.format("binaryFile").load(f"{root}/_staging/transactions").select("path").collect()
    assert files and all(r.path.endswith(".csv.gz") for r in files)


def test_a_settled_star_has_the_rows_of_the_plain_one(spark):
    settled, plain = (fx.fixture_star(spark, SF_SMALL, settle=s).fact for s in (True, False))
    assert settled.schema.simpleString() == plain.schema.simpleString()
    assert found(settled) == found(plain)
