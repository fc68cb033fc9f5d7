"""Bind the driver's TPC-H-like tables to the payments star (FIXTURES.md, part B).

customer + nation -> users, part -> merchants, supplier + nation -> agencies,
lineitem + orders -> transactions, events -> the live transaction stream.
Every frame is derived from the input tables, so work grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.operators.dedup import latest_per_key
from tillstar.operators.delta import signed
from tillstar.operators.star import (LOOKUPS, Star, build_calendar, build_dim_node, build_fact, calendar_bounds_of, date_key,
                                     settle_lookups)
from tillstar.session import fresh_path
from tillstar.sources.tables import load

MONEY = "decimal(18,2)"


def _s(c) -> F.Column:
    return c.cast("string")


def fx_node(spark: SparkSession) -> DataFrame:
    return build_dim_node(spark).select("node_key", "node_id", "datacenter")


def fx_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole years from the first to the last order date (the dates of all transactions)."""
    return build_calendar(calendar_bounds_of(load(spark, sf_dir, "orders"), "o_orderdate"))


def fx_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "customer")
    n = F.broadcast(load(spark, sf_dir, "nation"))  # 25 rows, fixed
    k = F.col("c_custkey")
    reg_year = (F.lit(1995) + (k % 7).cast("int")).alias("reg_year")
    reg_month = (F.lit(1) + (k % 12).cast("int")).alias("reg_month")
    return (c.join(n, c["c_nationkey"] == n["n_nationkey"])
            .select(
                k.alias("user_key"), k.alias("user_id"), F.col("c_name").alias("full_name"),
                F.col("n_nationkey").alias("wilaya_id"), F.col("n_name").alias("wilaya_name"),
                F.col("c_mktsegment").alias("profile_type"),
                F.when(k % 20 == 0, "PENDING_KYC").when(k % 20 == 1, "INACTIVE")
                 .otherwise("ACTIVE").alias("status"),
                F.concat(F.lit("P"), _s(F.lit(10000000) + k)).alias("phone"),
                F.concat(F.lit("N"), _s(F.lit(20000000) + k)).alias("nni"),
                F.when(k % 100 < 59, F.lit(None).cast("string"))
                 .otherwise(F.concat(F.lit("u"), _s(k), F.lit("@example.org"))).alias("email"),
                F.lit(None).cast("string").alias("kyc_level"),
                reg_year, reg_month,
                F.lit(True).alias("is_current"))
            .withColumn("registration_date", F.make_date("reg_year", "reg_month", F.lit(1))))


def fx_merchant(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "part")
    known = p.select(
        F.col("p_partkey").alias("merchant_key"), F.col("p_partkey").alias("merchant_id"),
        F.col("p_name").alias("name"), F.when(F.col("p_partkey") % 40 != 0, F.col("p_type")).alias("category_label"),
        F.when(F.col("p_size") % 8 == 0, "INACTIVE").otherwise("ACTIVE").alias("status"))
    unknown = spark.range(1).select(
        F.lit(-1).cast("bigint").alias("merchant_key"), F.lit(-1).cast("bigint").alias("merchant_id"),
        F.lit("Sans marchand").alias("name"), F.lit(None).cast("string").alias("category_label"),
        F.lit("N/A").alias("status"))
    return known.unionByName(unknown)


def fx_agency(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = load(spark, sf_dir, "supplier")
    n = F.broadcast(load(spark, sf_dir, "nation"))
    k = F.col("s_suppkey")
    known = (s.join(n, s["s_nationkey"] == n["n_nationkey"])
             .select(k.alias("agency_key"), k.alias("agency_id"), F.col("s_name").alias("name"),
                     F.col("n_name").alias("wilaya_name"),
                     F.when(k % 3 == 0, "GOLD").when(k % 3 == 1, "SILVER").otherwise("BRONZE").alias("tier")))
    unknown = spark.range(1).select(
        F.lit(-1).cast("bigint").alias("agency_key"), F.lit(-1).cast("bigint").alias("agency_id"),
        F.lit("Sans agence").alias("name"), F.lit(None).cast("string").alias("wilaya_name"),
        F.lit(None).cast("string").alias("tier"))
    return known.unionByName(unknown)


def _versions(li: DataFrame) -> DataFrame:
    """Transaction versions as the few columns that the others follow from (``_transactions``): these are what is shuffled. The order's
    key stands where it does not follow from ``tx_id`` and line; the line is inverted, so that versions are tied in the order of their keys."""
    ok, ln = F.col("l_orderkey"), F.col("l_linenumber")
    price = F.col("l_extendedprice")
    amount = price.cast(MONEY)
    returned = F.col("l_returnflag") == "R"
    node_amounts = (ok % 64 == 0) & (F.col("l_partkey") % 75 == 0)
    tx_id = ok * 8 + ln
    return li.select(
        F.when(~F.shiftright(tx_id - ln, 3).eqNullSafe(ok), ok).alias("apart_orderkey"),
        F.when(tx_id.isNull(), ln).otherwise(F.bitwise_not(ln)).alias("line_rank"),
        tx_id.alias("tx_id"),
        amount.alias("amount"),
        F.when((ok * 8 + ln) % 29 != 0, (amount * F.col("l_tax").cast("decimal(4,2)")).cast(MONEY)).alias("fee"),
        F.coalesce(~returned, F.lit(True)).alias("succeeded"), returned.isNull().alias("unflagged"),
        F.when(node_amounts, (price + 10).cast(MONEY)).alias("amount_node_a"),
        F.when(node_amounts, (price - 10).cast(MONEY)).alias("amount_node_b"),
        F.col("l_shipdate").alias("updated_at"), "l_partkey", "l_suppkey", "l_quantity",
    )


TX_COLUMNS = ["tx_id", "user_key", "transaction_type", "merchant_key", "agency_key", "node_key",
              "datacenter", "amount", "fee", "status", "failure_reason", "sync_status",
              "amount_node_a", "amount_node_b", "transaction_date", "updated_at",
              "l_partkey", "l_suppkey", "l_quantity"]

# Version order of a transaction id: latest update first, then a total tie-break.
TX_VERSION_ORDER = [("updated_at", True), ("l_partkey", False), ("l_suppkey", False),
                    ("amount", False), ("l_quantity", False), ("status", False)]
# The same over ``_versions``: FAILED sorts before SUCCESS, false before true.
VERSION_ORDER = [*TX_VERSION_ORDER[:-1], ("succeeded", False)]


def _line() -> F.Column:
    return F.when(F.col("tx_id").isNull(), F.col("line_rank")).otherwise(F.bitwise_not("line_rank"))


def _with_orders(versions: DataFrame, orders: DataFrame) -> DataFrame:
    order_of = F.coalesce("apart_orderkey", F.shiftright(F.col("tx_id") - _line(), 3))
    o = orders.select(F.col("o_orderkey"), F.col("o_custkey").alias("user_key"),
                      F.col("o_orderdate").cast("date").alias("transaction_date"))
    return _transactions(versions.join(o, order_of == o["o_orderkey"]))


def _transactions(v: DataFrame) -> DataFrame:
    """All transaction columns of versions that met their order."""
    ok, ln = F.col("o_orderkey"), _line()
    pk, sk = F.col("l_partkey"), F.col("l_suppkey")
    by_line = (F.when(ln == 1, "TRF").when(ln == 2, "DEP").when(ln == 3, "WIT").when(ln == 4, "PAY")
               .when(ln == 5, "BIL").when(ln == 6, "AIR").otherwise("SAL"))
    return v.select(
        "tx_id", "user_key",
        F.when(ok % 50 == 7, "REV").otherwise(by_line).alias("transaction_type"),
        F.when(ln == 4, pk).otherwise(F.lit(-1).cast("bigint")).alias("merchant_key"),
        F.when(ln.isin(2, 3), sk).otherwise(F.lit(-1).cast("bigint")).alias("agency_key"),
        (F.lit(1) + (sk % 5).cast("int")).alias("node_key"),
        F.when(pk % 50 == 0, "DC-NDB").when(sk % 5 < 2, "DC-NDB").when(sk % 5 < 4, "DC-NKC-PRIMARY")
         .otherwise("DC-NKC-SECONDARY").alias("datacenter"),
        "amount", "fee",
        F.when(~F.col("succeeded"), "FAILED").otherwise("SUCCESS").alias("status"),
        F.when(F.col("succeeded") & ~F.col("unflagged"), F.lit(None).cast("string"))
         .when(sk % 20 < 16, "INSUFFICIENT_BALANCE").when(sk % 20 == 16, "INSUF_BAL")
         .when(sk % 20 == 17, "LIMIT_DAY").when(sk % 20 == 18, "WRONG_PIN").otherwise("  ")
         .alias("failure_reason"),
        F.when(ok % 64 == 0, "CONFLICT").when(ok % 64 == 1, "LAGGING").when(ok % 64 == 2, "PENDING")
         .otherwise("SYNCED").alias("sync_status"),
        "amount_node_a", "amount_node_b", "transaction_date", "updated_at", pk, sk, "l_quantity").select(*TX_COLUMNS)


def fx_tx_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All transaction versions (ids repeat: several versions of one transaction)."""
    return _with_orders(_versions(load(spark, sf_dir, "lineitem")), load(spark, sf_dir, "orders"))


def fx_tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest version per transaction id.

    The version order only uses lineitem columns, so the dedup runs before the
    join with orders (fewer rows into the join); it is a partial aggregate, safe
    for hot ids. Texts and other derived columns are made after both shuffles.
    """
    latest = latest_per_key(_versions(load(spark, sf_dir, "lineitem")), ["tx_id"], VERSION_ORDER)
    return _with_orders(latest, load(spark, sf_dir, "orders"))


def stg_transactions(spark: SparkSession, sf_dir: str, dedup: bool = True) -> DataFrame:
    """fx_tx in the shape of the raw text staging table (natural ids, text values).

    ``dedup=False`` keeps every version (what a load without the nightly dedup sees)."""
    return _staged(spark, fx_tx(spark, sf_dir) if dedup else fx_tx_raw(spark, sf_dir))


def _staged(spark: SparkSession, t: DataFrame) -> DataFrame:
    n = F.broadcast(fx_node(spark).select("node_key", "node_id"))
    natural = lambda c: F.when(F.col(c) != -1, _s(F.col(c)))  # noqa: E731 - -1 means "none"
    return t.join(n, "node_key").select(
        F.col("tx_id").alias("id"),
        F.lit(None).cast("string").alias("reference"),
        F.when(F.col("tx_id") % 3 != 0, F.concat(F.lit("K"), _s(F.floor(F.col("tx_id") / 2)))).alias("idempotency_key"),
        F.col("transaction_type"),
        _s(F.col("amount")).alias("amount"),
        F.coalesce(_s(F.col("fee")), F.lit("  ")).alias("fee"),
        _s(F.col("amount") + F.coalesce("fee", F.lit(0))).alias("total_amount"),
        _s(F.col("user_key")).alias("source_user_id"),
        natural("merchant_key").alias("merchant_id"),
        natural("agency_key").alias("agency_id"),
        F.col("status"), F.col("failure_reason"),
        F.when(F.col("tx_id") % 5 == 0, _s(F.col("amount") * 2)).otherwise("").alias("balance_before"),
        F.when(F.col("tx_id") % 5 == 0, _s(F.col("amount"))).otherwise("").alias("balance_after"),
        F.col("node_id"), F.col("datacenter"), F.col("sync_status"),
        F.date_format(F.when(F.col("tx_id") % 37 == 0, F.date_sub("transaction_date", 1)).otherwise(F.date_add("transaction_date", 1)),
                      "yyyy-MM-dd 12:00:00").alias("last_synced_at"),
        _s(F.col("amount_node_a")).alias("amount_node_a"),
        _s(F.col("amount_node_b")).alias("amount_node_b"),
        F.lit(None).cast("string").alias("channel"),
        F.lit(None).cast("string").alias("device_type"),
        F.when(F.col("tx_id") % 4 == 0, _s((F.col("tx_id") % 1000 / 10).cast("decimal(5,2)"))).otherwise(" ").alias("risk_score"),
        _s(F.col("transaction_date")).alias("transaction_date"),
        F.when(F.col("tx_id") % 11 != 0, F.format_string("%02d:30:00", F.col("tx_id") % 24)).otherwise("").alias("transaction_time"),
        F.date_format("transaction_date", "yyyy-MM-dd 08:00:00").alias("created_at"),
        _s(F.col("updated_at")).alias("updated_at"),
        F.lit(None).cast("string").alias("completed_at"),
    )


def fixture_star(spark: SparkSession, sf_dir: str, strategy: str = "node_a", lookups: tuple[str, ...] = LOOKUPS,
                 settle: bool = False) -> Star:
    """The star over the input tables; ``lookups`` names the dimension keys the fact needs. With ``settle`` (for a fact that is
    written) the transactions are written first and their distinct ids looked up, so that the fact rows are not shuffled for lookups."""
    user = fx_user(spark, sf_dir)
    merchant = fx_merchant(spark, sf_dir)
    agency = fx_agency(spark, sf_dir)
    node = fx_node(spark)
    staged, settled = stg_transactions(spark, sf_dir), None
    if settle:
        path = fresh_path(spark, "settled-star")
        tx = fx_tx(spark, sf_dir).drop("l_partkey", "l_suppkey", "l_quantity")
        tx.write.mode("errorifexists").parquet(f"{path}/transactions")
        staged = _staged(spark, spark.read.parquet(f"{path}/transactions"))
        settled = settle_lookups(staged, user, merchant, agency, node, f"{path}/lookups", lookups)
    fact = build_fact(staged, user, merchant, agency, node, strategy, lookups, settled)
    date = fx_date(spark, sf_dir)
    return Star(fact=fact, user=user, merchant=merchant, agency=agency, node=node, date=date)


def event_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The live stream bound to events: one committed-or-not transaction per event."""
    e = load(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("transaction_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("user_id"),
        F.col("event_type"),
        F.col("value").cast(MONEY).alias("amount"),
        F.when(F.col("event_type") == "error", "FAILED").otherwise("SUCCESS").alias("status"),
        F.date_format(F.col("ts"), "HH:mm:ss").alias("transaction_time"),
        F.hour(F.col("ts")).alias("tx_hour"),
    )


# ---------------------------------------------------------------- text staging of the dimensions
def _pad(c) -> F.Column:
    """Surround text with blanks (exercises trimming)."""
    return F.concat(F.lit(" "), c, F.lit("  "))


def stg_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users in the staging shape: text columns, blank = empty, padded names."""
    u = fx_user(spark, sf_dir)
    blank = F.lit("")
    none = F.lit(None).cast("string")
    return u.select(
        F.col("user_id").alias("id"),
        F.col("nni"), none.alias("first_name"), none.alias("last_name"), _pad(F.col("full_name")).alias("full_name"),
        none.alias("gender"), none.alias("birth_date"), none.alias("ethnicity"),
        F.col("phone"), F.coalesce(F.col("email"), blank).alias("email"),
        F.col("wilaya_id").cast("int").alias("wilaya_id"), F.col("wilaya_name"),
        F.lit(None).cast("int").alias("moughataa_id"), blank.alias("moughataa_name"),
        F.col("profile_type"), blank.alias("kyc_level"), F.col("status"), none.alias("device_type"),
        F.date_format("registration_date", "yyyy-MM-dd").alias("registration_date"),
        none.alias("last_login"), none.alias("created_at"), none.alias("updated_at"))


def stg_merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "part")
    k = F.col("p_partkey")
    blank = F.lit("")
    none = F.lit(None).cast("string")
    return p.select(
        k.alias("id"), F.concat(F.lit("M"), _s(k)).alias("code"), blank.alias("mcc"), _pad(F.col("p_name")).alias("name"),
        F.col("p_brand").alias("category_code"), F.when(k % 40 != 0, F.col("p_type")).otherwise(blank).alias("category_label"),
        *[none.alias(c) for c in ("owner_first_name", "owner_last_name", "owner_full_name", "owner_gender",
                                  "owner_ethnicity", "phone", "email")],
        F.lit(None).cast("int").alias("wilaya_id"), none.alias("wilaya_name"),
        F.lit(None).cast("int").alias("moughataa_id"), blank.alias("moughataa_name"),
        none.alias("address"), none.alias("latitude"), none.alias("longitude"),
        F.format_string("%.4f", (F.col("p_size") % 10).cast("double") / 100).alias("commission_rate"),
        none.alias("avg_transaction_min"), none.alias("avg_transaction_max"),
        F.when(F.col("p_size") % 8 == 0, "INACTIVE").otherwise("ACTIVE").alias("status"),
        blank.alias("registration_date"), none.alias("created_at"), none.alias("updated_at"))


def stg_agencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = load(spark, sf_dir, "supplier")
    n = F.broadcast(load(spark, sf_dir, "nation"))
    k = F.col("s_suppkey")
    none = F.lit(None).cast("string")
    return s.join(n, s["s_nationkey"] == n["n_nationkey"]).select(
        k.alias("id"), F.concat(F.lit("A"), _s(k)).alias("code"), _pad(F.col("s_name")).alias("name"),
        F.col("n_nationkey").alias("wilaya_id"), F.col("n_name").alias("wilaya_name"),
        F.lit(None).cast("int").alias("moughataa_id"), F.lit("  ").alias("moughataa_name"),
        none.alias("address"), none.alias("latitude"), none.alias("longitude"), none.alias("phone"),
        none.alias("email"), F.lit("08:00-18:00").alias("opening_hours"), F.lit("ACTIVE").alias("status"),
        F.when(k % 3 == 0, "GOLD").when(k % 3 == 1, "SILVER").otherwise("BRONZE").alias("tier"),
        _s(F.col("s_acctbal")).alias("float_balance"), none.alias("max_float"), none.alias("license_number"),
        none.alias("license_expiry"), none.alias("created_at"), none.alias("updated_at"))


def stg_transactions_with_defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging transactions with injected defects: unparsable amount (id % 97 = 0),
    unparsable date (id % 89 = 0), unknown node (id % 83 = 0)."""
    t = stg_transactions(spark, sf_dir)
    i = F.col("id")
    return t.withColumns({
        "amount": F.when(i % 97 == 0, F.lit("N/A")).otherwise(F.col("amount")),
        "transaction_date": F.when(i % 89 == 0, F.lit("2001-02-30x")).otherwise(F.col("transaction_date")),
        "node_id": F.when(i % 83 == 0, F.lit("NKC-NODE-9")).otherwise(F.col("node_id")),
    })


def staging_with_gaps(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The four staging tables, with unknown users (id % 71 = 0) and unknown nodes (id % 83 = 0) among the transactions."""
    t = stg_transactions(spark, sf_dir)
    i = F.col("id")
    t = t.withColumns({"source_user_id": F.when(i % 71 == 0, F.lit("999999999999")).otherwise(F.col("source_user_id")),
                       "node_id": F.when(i % 83 == 0, F.lit("NKC-NODE-9")).otherwise(F.col("node_id"))})
    return {"users": stg_users(spark, sf_dir), "merchants": stg_merchants(spark, sf_dir),
            "agencies": stg_agencies(spark, sf_dir), "transactions": t}


def node_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-node totals reported by the replication nodes: staging amounts per node,
    node 1 off by 1300.88 (the deliberate ledger gap)."""
    t = stg_transactions(spark, sf_dir)
    per = t.groupBy("node_id").agg(F.sum(F.col("amount").cast(MONEY)).alias("ledger_total"))
    return per.withColumn("ledger_total", F.when(F.col("node_id") == "NDB-NODE-1",
                                                 F.col("ledger_total") + F.lit(1300.88).cast(MONEY))
                          .otherwise(F.col("ledger_total")))


def ledger_replicas(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two replicas of the ledger. The second lacks ids that are multiples of 4001, has 1300.88 more in multiples of 4003, another
    status in 4007, the next day in 4013 and multiples of 4019 twice."""
    i = F.col("transaction_id")
    a = fx_tx(spark, sf_dir).join(F.broadcast(fx_node(spark).select("node_key", "node_id")), "node_key").select(
        "node_id", F.col("transaction_date").alias("jour"), F.col("tx_id").alias("transaction_id"), F.col("amount").alias("montant"),
        F.col("status").alias("statut"))
    b = a.filter(i % 4001 != 0).withColumns({
        "jour": F.when(i % 4013 == 0, F.date_add("jour", 1)).otherwise(F.col("jour")),
        "montant": F.when(i % 4003 == 0, (F.col("montant") + F.lit(1300.88).cast(MONEY)).cast(MONEY)).otherwise(F.col("montant")),
        "statut": F.when(i % 4007 == 0, "REVERSED").otherwise(F.col("statut"))})
    return a, b.unionByName(b.filter(i % 4019 == 0))


def changed_fact(spark: SparkSession, sf_dir: str, lookups: tuple[str, ...]) -> tuple[Star, DataFrame, list[DataFrame]]:
    """The star as it is now, its fact as it was before, and the changes between in two batches of signed rows: ids that are multiples of
    37 are inserted; multiples of 41 had five more and another day 40 days before; copies of multiples of 43 are deleted."""
    star = fixture_star(spark, sf_dir, lookups=lookups)
    keys = [c for c in ("user_key",) if c in star.fact.columns]
    path = fresh_path(spark, "changed-fact")
    star.fact.select("tx_pk", "date_key", "transaction_date", "amount", "fee", "status", "is_conflict", *keys).write.parquet(path)
    now = spark.read.parquet(path)
    i = F.col("tx_pk")
    inserted, changed, copied = now.filter(i % 37 == 0), now.filter((i % 41 == 0) & (i % 37 != 0)), now.filter(i % 43 == 0)
    day = F.date_sub("transaction_date", 40)
    old = changed.withColumns({"amount": (F.col("amount") + 5).cast(MONEY), "transaction_date": day, "date_key": date_key(day).cast("int")})
    before = now.filter((i % 37 != 0) & (i % 41 != 0)).unionByName(old).unionByName(copied)
    return star.with_fact(now), before, [signed(old, changed.unionByName(inserted)), signed(copied, None)]


def user_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Free text with the account number of each user: within a sentence for multiples of 3, in groups of four for multiples of 5; wrong
    check digits for multiples of 13, a digit short for multiples of 17."""
    k = F.col("user_id")
    bban = F.concat(F.lit("0002000101"), F.lpad(_s(k + 10000000), 11, "0"), F.lpad(_s(k % 97), 2, "0"))
    check = 98 - F.concat(bban, F.lit("222700")).cast("decimal(38,0)") % 97 + F.when(k % 13 == 0, 1).otherwise(0)
    number = F.concat(F.lit("MR"), F.lpad(_s(check.cast("int")), 2, "0"), F.when(k % 17 == 0, F.left(bban, F.lit(22))).otherwise(bban))
    return fx_user(spark, sf_dir).select("user_id", F.when(k % 3 == 0, F.concat(F.lit("Virement vers "), number, F.lit(".")))
                                         .when(k % 5 == 0, F.trim(F.regexp_replace(number, "(.{4})", "$1 "))).otherwise(number).alias("compte"))


def fee_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One fee row per transaction with a fee, except ids that are multiples of 101
    (missing from the ledger)."""
    t = fx_tx(spark, sf_dir)
    return (t.filter((F.col("fee") > 0) & (F.col("tx_id") % 101 != 0))
            .select(F.col("tx_id").alias("transaction_id"), F.col("fee").alias("fee_amount")))


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One branch-manager login per region (row-security profiles)."""
    n = load(spark, sf_dir, "nation")
    return n.select(F.concat(F.lit("chef_wilaya_"), _s(F.col("n_nationkey"))).alias("login"),
                    F.col("n_nationkey").alias("wilaya_id"), F.lit("chef_agence").alias("role"))


def query_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query log bound to events: elapsed time, scanned and returned rows."""
    e = load(spark, sf_dir, "events")
    i = F.col("event_id")
    return e.select(i.alias("query_id"), F.col("user_id"), F.col("ts").cast("timestamp").alias("ts"),
                    F.col("value").alias("elapsed_s"), ((i % 1000) * 1000).alias("scanned_rows"),
                    ((i % 200) * 100).alias("returned_rows"))


SCD_TRACKED = ["wilaya_id", "wilaya_name", "status"]


def user_snapshot(spark: SparkSession, sf_dir: str, version: int) -> DataFrame:
    """Source snapshots of users for SCD: v1 lacks ids that are multiples of 97;
    v2 has everyone, and ids that are multiples of 10 moved to the next region."""
    u = fx_user(spark, sf_dir).select("user_id", "full_name", "wilaya_id", "wilaya_name", "status")
    if version == 1:
        return u.filter(F.col("user_id") % 97 != 0)
    n = load(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("_nk"), F.col("n_name").alias("_nn"))
    moved = F.col("user_id") % 10 == 0
    u = u.withColumn("_to", F.when(moved, (F.col("wilaya_id") + 1) % 25).otherwise(F.col("wilaya_id")))
    return (u.join(F.broadcast(n), u["_to"] == n["_nk"])
            .select("user_id", "full_name", F.col("_nk").alias("wilaya_id"), F.col("_nn").alias("wilaya_name"),
                    "status"))
