"""Operator unit tests on small in-line frames: NULL, blank, -1, empty group, ties."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillstar.functions.clean import blank_to_null, fee_or_zero, guarded_cast, lenient_cast
from tillstar.functions.share import with_share
from tillstar.operators import governance as gov
from tillstar.operators import scd
from tillstar.operators.dedup import latest_per_key
from tillstar.operators.percentile import percentile_cont
from tillstar.operators.star import (build_dim_date, cross_dc_flag, insert_if_absent, resolve_amount)


def test_blank_to_null(spark):
    df = spark.createDataFrame([("  a ",), ("",), ("   ",), (None,)], "x string")
    out = [r[0] for r in df.select(blank_to_null("x")).collect()]
    assert out == ["a", None, None, None]


def test_guarded_and_lenient_casts(spark):
    good = spark.createDataFrame([(" 12.50 ",), ("",), (None,)], "x string")
    bad = spark.createDataFrame([(" 12.50 ",), ("",), (None,), ("N/A",)], "x string")
    ok = good.select(guarded_cast("x", "decimal(18,2)").cast("string")).collect()
    assert [r[0] for r in ok] == ["12.50", None, None]
    lenient = [r[0] for r in bad.select(lenient_cast("x", "decimal(18,2)").cast("string")).collect()]
    assert lenient == ["12.50", None, None, None]
    fees = [r[0] for r in good.select(fee_or_zero("x").cast("string")).collect()]
    assert fees == ["12.50", "0.00", "0.00"]
    with pytest.raises(Exception):
        bad.select(guarded_cast("x", "decimal(18,2)")).collect()     # ANSI: bad text fails the load


def test_dim_date_2024(spark):
    d = build_dim_date(spark, "2024-01-01", "2024-12-31")
    assert d.count() == 366
    r = {x["full_date"]: x for x in d.filter(F.col("full_date").isin(dt.date(2024, 12, 30), dt.date(2024, 1, 7))).collect()}
    assert r[dt.date(2024, 12, 30)]["week_of_year"] == 1          # ISO week
    assert r[dt.date(2024, 1, 7)]["day_of_week"] == 7              # Sunday = 7
    assert r[dt.date(2024, 1, 7)]["is_weekend"]
    assert r[dt.date(2024, 1, 7)]["date_key"] == 20240107
    assert r[dt.date(2024, 12, 30)]["month_name"] == "December"


def test_insert_if_absent_is_idempotent(spark):
    a = build_dim_date(spark, "2024-01-01", "2024-01-10")
    b = build_dim_date(spark, "2024-01-05", "2024-01-20")
    once = insert_if_absent(a, b, ["date_key"])
    twice = insert_if_absent(once, b, ["date_key"])
    assert once.count() == twice.count() == 20


def test_latest_per_key_order_nulls_and_ties(spark):
    rows = [(1, dt.datetime(2024, 1, 2), 5, "x"), (1, dt.datetime(2024, 1, 3), 9, "y"),
            (1, None, 1, "z"), (2, dt.datetime(2024, 1, 1), 2, "b"), (2, dt.datetime(2024, 1, 1), 1, "a")]
    df = spark.createDataFrame(rows, "k int, ts timestamp, v int, s string")
    out = {r["k"]: r["s"] for r in latest_per_key(df, ["k"], [("ts", True), ("v", False)]).collect()}
    assert out == {1: "y", 2: "a"}


def test_latest_per_key_hot_key(spark):
    # One key holds most rows: still one row out, and the right one.
    df = spark.range(0, 20000).select((F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(F.lit(-1))).alias("k"),
                                      F.col("id").alias("v"))
    out = latest_per_key(df, ["k"], [("v", True)])
    hot = out.filter("k = -1").collect()
    assert len(hot) == 1 and hot[0]["v"] == 19999
    assert out.count() == 2001


@pytest.mark.parametrize("p", [0.5, 0.25, 0.9])
def test_percentile_cont_matches_numpy(spark, p):
    rnd = random.Random(7)
    rows = []
    for g, n in (("hot", 5000), ("small", 7), ("one", 1), ("two", 2)):
        for _ in range(n):
            rows.append((g, round(rnd.lognormvariate(5, 2), 2)))
    rows.append(("hot", None))
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r["g"]: r["q"] for r in percentile_cont(df, ["g"], "x", p, "q").collect()}
    for g in ("hot", "small", "one", "two"):
        vals = np.array([x for gg, x in rows if gg == g and x is not None])
        assert got[g] == pytest.approx(float(np.quantile(vals, p)), rel=1e-12, abs=1e-9)


def test_percentile_weighted_equals_expanded(spark):
    df = spark.createDataFrame([("a", 1.0, 3), ("a", 2.0, 1), ("a", 10.0, 2)], "g string, x double, w long")
    got = percentile_cont(df, ["g"], "x", 0.5, "m", weight_col="w").collect()[0]["m"]
    assert got == pytest.approx(float(np.quantile([1, 1, 1, 2, 10, 10], 0.5)))


def test_unbounded_share_has_no_single_partition_exchange(spark):
    g = spark.range(100).groupBy((F.col("id") % 7).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    out = with_share(g, "n", "pct", 1, bounded=False)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, with_share(g, "n", "pct", 1).collect()))
    assert sum(r["pct"] for r in out.collect()) == pytest.approx(100, abs=0.5)
    plan = out._jdf.queryExecution().executedPlan().toString()
    # Only the one-row grand total (partial sums, one per task) is gathered; the
    # grouped rows are never moved to one partition by a window.
    assert "Window" not in plan
    for line in plan.splitlines():
        if "SinglePartition" in line:
            nxt = plan.splitlines()[plan.splitlines().index(line) + 1]
            assert "keys=[]" in nxt and "partial_sum" in nxt


def test_resolve_amount_strategies(spark):
    df = spark.createDataFrame([("CONFLICT", "10.00", "11.00", "9.00"), ("CONFLICT", "10.00", "", None),
                                ("SYNCED", "5.00", "6.00", "4.00")],
                               "sync_status string, amount string, amount_node_a string, amount_node_b string")
    a = [str(r[0]) for r in df.select(resolve_amount("node_a")).collect()]
    b = [str(r[0]) for r in df.select(resolve_amount("node_b")).collect()]
    assert a == ["11.00", "10.00", "5.00"]
    assert b == ["9.00", "10.00", "5.00"]


def test_cross_dc_flag(spark):
    df = spark.createDataFrame([("DC-NDB", "NKC-NODE-1"), ("DC-NKC-PRIMARY", "NDB-NODE-2"),
                                ("DC-NKC-PRIMARY", "NKC-NODE-3"), ("DC-NDB", "NDB-NODE-1"), (None, "NDB-NODE-1")],
                               "datacenter string, node_id string")
    assert [r[0] for r in df.select(cross_dc_flag()).collect()] == [True, True, False, False, None]


def test_masks_leak_nothing(spark):
    u = spark.createDataFrame([(1, "22334455", "1234567890", "a.b@mail.mr"), (2, None, None, None)],
                              "user_id int, phone string, nni string, email string")
    m = gov.masked_users(u, "analyste_junior").collect()
    assert m[0]["phone"] == "***-****-4455" and m[0]["nni"] == "**********" and m[0]["email"] == "****@mail.mr"
    assert "2233" not in m[0]["phone"] and "a.b" not in m[0]["email"]
    clear = gov.masked_users(u, "dpo").collect()
    assert clear[0]["phone"] == "22334455"


def test_rls_equals_manual_subset(spark):
    fact = spark.createDataFrame([(1, 10), (2, 11), (3, 12), (4, 10)], "tx_pk int, user_key int")
    users = spark.createDataFrame([(10, 1, True), (11, 2, True), (12, 1, True)], "user_key int, wilaya_id int, is_current boolean")
    prof = spark.createDataFrame([("chef1", 1), ("chef2", 2)], "login string, wilaya_id int")
    seen = sorted(r["tx_pk"] for r in gov.rls_filter(fact, users, prof, "chef1", "chef_agence").collect())
    assert seen == [1, 3, 4]
    assert gov.rls_filter(fact, users, prof, "x", "directeur_general").count() == 4


def test_export_decision_thresholds(spark):
    df = spark.createDataFrame([(9999,), (10001,), (50000,), (50001,)], "n int")
    out = [r[0] for r in df.select(gov.export_decision(F.col("n"))).collect()]
    assert out == ["OK", "ALERT", "ALERT", "REFUSE"]


def test_pii_scan_patterns(spark):
    df = spark.createDataFrame([("write to a.b@mail.example.com or +1 (743) 555-3824",),
                                ("card 4785380592391139 is not a phone; nni 1234567890; MR1300020001010000123456",)],
                               "text string")
    got = {r["pii_type"]: (r["nb_rows"], r["nb_hits"]) for r in gov.pii_scan(df, "t", ["text"]).collect()}
    assert got["EMAIL"] == (1, 1)
    assert got["PHONE"] == (1, 1)
    assert got["NNI"] == (1, 1)
    assert got["IBAN"] == (1, 1)


def _snap(spark, rows):
    return spark.createDataFrame(rows, "user_id long, wilaya_id int, status string")


def test_scd2_apply_and_reapply(spark):
    s1 = _snap(spark, [(1, 1, "A"), (2, 2, "A"), (3, 3, None)])
    s2 = _snap(spark, [(1, 1, "A"), (2, 5, "A"), (3, 3, None), (4, 4, "A")])
    h1 = scd.scd2_initial(s1, "user_id", "user_key", "2024-01-01")
    h2 = scd.scd2_apply(h1, s2, "user_id", "user_key", ["wilaya_id", "status"], "2024-02-01")
    rows = {(r["user_id"], r["is_current"]): r for r in h2.collect()}
    assert len(rows) == 5                                    # 1, 3 unchanged (NULL-safe), 2 closed+opened, 4 new
    assert rows[(2, False)]["effective_to"] == dt.date(2024, 2, 1)
    assert rows[(2, True)]["wilaya_id"] == 5
    h3 = scd.scd2_apply(h2, s2, "user_id", "user_key", ["wilaya_id", "status"], "2024-03-01")
    assert sorted(map(tuple, h3.collect())) == sorted(map(tuple, h2.collect()))   # same snapshot: no change
    keys = [r["user_key"] for r in h2.collect()]
    assert len(keys) == len(set(keys))


def test_asof_join_picks_valid_version(spark):
    s1 = _snap(spark, [(1, 1, "A")])
    h = scd.scd2_apply(scd.scd2_initial(s1, "user_id", "user_key", "2024-01-01"),
                       _snap(spark, [(1, 2, "A")]), "user_id", "user_key", ["wilaya_id"], "2024-02-01")
    fact = spark.createDataFrame([(1, dt.date(2024, 1, 15)), (1, dt.date(2024, 2, 1)), (1, dt.date(2023, 12, 31))],
                                 "uid long, d date")
    got = sorted((r["d"], r["wilaya_id"]) for r in scd.asof_join(fact, h, "uid", "user_id", "d").collect())
    assert got == [(dt.date(2024, 1, 15), 1), (dt.date(2024, 2, 1), 2)]


def test_build_fact_unknowns_and_spread_null_keys(spark):
    from tillstar.operators.star import build_dim_node, build_fact, lookup_key
    stg = spark.createDataFrame(
        [(1, "10", None, None, "NDB-NODE-1", "DC-NDB", "SYNCED", "5.00", "", "2024-01-02", "SUCCESS"),
         (2, "99", "7", "3", "NKC-NODE-1", "DC-NDB", "CONFLICT", "6.00", "1.00", "2024-01-03", "FAILED"),
         (3, "10", None, None, "XX-NODE-9", "DC-NDB", "SYNCED", "7.00", None, "2024-01-04", "SUCCESS")],
        "id long, source_user_id string, merchant_id string, agency_id string, node_id string, datacenter string, "
        "sync_status string, amount string, fee string, transaction_date string, status string")
    for c in ("reference", "idempotency_key", "transaction_type", "total_amount", "balance_before", "balance_after",
              "risk_score", "failure_reason", "channel", "device_type", "amount_node_a", "amount_node_b",
              "transaction_time", "created_at", "updated_at", "completed_at", "last_synced_at"):
        stg = stg.withColumn(c, F.lit(None).cast("string"))
    user = spark.createDataFrame([(10, 10, True)], "user_key long, user_id long, is_current boolean")
    merchant = spark.createDataFrame([(7, 7), (-1, -1)], "merchant_key long, merchant_id long")
    agency = spark.createDataFrame([(-1, -1)], "agency_key long, agency_id long")
    f = {r["tx_pk"]: r for r in build_fact(stg, user, merchant, agency, build_dim_node(spark)).collect()}
    assert set(f) == {1, 2}                              # unknown node: row dropped by the inner join
    assert f[1]["merchant_key"] == -1 and f[1]["agency_key"] == -1 and f[1]["user_key"] == 10
    assert f[2]["user_key"] == -1 and f[2]["merchant_key"] == 7 and f[2]["agency_key"] == -1
    assert str(f[1]["fee"]) == "0.00" and f[2]["is_conflict"] and f[2]["is_cross_dc"]
    assert f[1]["date_key"] == 20240102
    # NULL keys are spread over many distinct never-matching values
    keys = spark.range(1000).withColumn("m", F.lit(None).cast("string")).select(lookup_key("m").alias("k"))
    assert keys.filter("k >= -1").count() == 0 and keys.distinct().count() > 900


@pytest.mark.parametrize("n", [3, 40, 3000])
def test_percentile_keeps_null_groups_at_any_size(spark, n):
    from tillstar.operators.percentile import percentile_stats
    rnd = random.Random(3)
    rows = [(("a", "b", None)[i % 3], round(rnd.lognormvariate(4, 1.5) - 20, 2), 1 + i % 4) for i in range(n)]
    rows += [("a", None, 5), ("empty", None, 2), ("one", 7.5, 1)]
    df = spark.createDataFrame(rows, "g string, x double, w long")
    got = {r["g"]: r for r in percentile_stats(df, ["g"], "x", 0.5, "m", weight_col="w").collect()}
    assert set(got) == {r[0] for r in rows}
    for g in got:
        vals = [x for gg, x, w in rows if gg == g and x is not None for _ in range(w)]
        assert got[g]["_rows"] == sum(w for gg, _, w in rows if gg == g) and got[g]["_n"] == len(vals)
        assert got[g]["m"] == (pytest.approx(float(np.quantile(vals, 0.5)), rel=1e-12) if vals else None)


def test_scd2_same_day_and_older_as_of(spark):
    from tillstar.operators import scd
    snap = spark.createDataFrame([(1, "a"), (2, "b")], "user_id long, region string")
    h = scd.scd2_initial(snap, "user_id", "user_key", "2024-01-01")
    day2 = spark.createDataFrame([(1, "c"), (2, "b")], "user_id long, region string")
    h = scd.scd2_apply(h, day2, "user_id", "user_key", ["region"], "2024-01-02")
    again = spark.createDataFrame([(1, "d"), (2, "b")], "user_id long, region string")
    h = scd.scd2_apply(h, again, "user_id", "user_key", ["region"], "2024-01-02")
    rows = sorted((r.user_id, str(r.effective_from), str(r.effective_to), r.region, r.is_current) for r in h.collect())
    assert rows == [(1, "2024-01-01", "2024-01-02", "a", False), (1, "2024-01-02", "None", "d", True), (2, "2024-01-01", "None", "b", True)]
    assert h.select("user_key").distinct().count() == 3
    with pytest.raises(Exception, match="before a current version"):
        scd.scd2_apply(h, snap, "user_id", "user_key", ["region"], "2023-12-31").collect()


@pytest.mark.parametrize("dates", [["2020-01-01", "2024-05-01", None], ["2024-05-01", "2024-04-01", None], [None]])
def test_archive_keeps_every_row(spark, dates):
    from tillstar.session import fresh_path
    from tillstar.sources import landing
    df = spark.createDataFrame([(i, d) for i, d in enumerate(dates)], "id long, transaction_date string").withColumn(
        "transaction_date", F.col("transaction_date").cast("date"))
    both = landing.read_both(spark, landing.split_hot_archive(df, fresh_path(spark, "t-store")), df.schema)
    got = {r["id"]: r["store"] for r in both.collect()}
    assert got == {i: "archive" if d == "2020-01-01" else "hot" for i, d in enumerate(dates)}


def test_guarded_export_counts_truly(spark):
    from tillstar.operators import governance as gov
    from tillstar.session import fresh_path
    df = spark.range(120)
    path = fresh_path(spark, "t-export")
    ok = gov.guarded_export(df, "x", "me", path, alert=50, refuse=200).collect()[0]
    assert (ok.nb_lignes, ok.decision, ok.fichier) == (120, "ALERT", path)
    assert spark.read.option("header", True).csv(path).count() == 120
    no = gov.guarded_export(df, "x", "me", fresh_path(spark, "t-export"), alert=10, refuse=50).collect()[0]
    assert (no.nb_lignes, no.decision, no.fichier) == (120, "REFUSE", None)


@pytest.mark.parametrize("text,kind", [("+222 45 25 12 34", "PHONE"), ("+22245251234", "PHONE"), ("call 45251234 now", "PHONE"),
                                       ("+1 (168) 555-5254", "PHONE"), ("P10000012", "PHONE"), ("N20000012", "NNI"), ("1234567890", "NNI")])
def test_local_formats_are_found(spark, text, kind):
    from tillstar.operators import governance as gov
    hits = {r.pii_type: r.nb_hits for r in gov.pii_scan(spark.createDataFrame([(text,)], "t string"), "x").collect()}
    assert hits[kind] == 1


def test_export_anomaly_sums_rows_both_ways(spark):
    from tillstar.operators import governance as gov
    days = [("u", d, n) for d, n in [(1, 100), (2, 101), (3, 99), (4, 100), (5, 2000)]] + [("v", d, n) for d, n in [(1, 100), (2, 101), (3, 99), (4, 1)]]
    log = spark.createDataFrame(days, "user_id string, jour int, returned_rows long")
    flagged = {(r.user_id, r.jour) for r in gov.export_anomaly(log).filter("anomalie").collect()}
    assert flagged == {("u", 5), ("v", 4)}


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    from tillstar import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: None)

    with pytest.raises(RuntimeError, match="checkpoint"):
        session.work_root(Session())
