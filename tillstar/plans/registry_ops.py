"""Registry entries for the non-mart operators: star builders, sources and sinks,
cleaning, joins, quality and reconciliation, SCD, governance, refresh, streaming.

Each key maps to a Spark callable (spark, sf_dir) -> DataFrame and, where the
operator is SQL-expressible, to an oracle SQL text over the same input tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.functions.clean import (blank_to_null, clean_text_columns, fee_or_zero, guarded_cast, lenient_cast,
                                      money)
from tillstar.functions import identifiers as ids
from tillstar.functions.share import with_share
from tillstar.operators import governance as gov
from tillstar.operators import bucketed, marts, quality, refresh, scd
from tillstar.operators.asof import merge_asof
from tillstar.operators.dedup import duplicate_keys, latest_per_key
from tillstar.operators.star import (build_calendar, build_dim_agency, build_dim_merchant, build_dim_node,
                                     build_dim_user, build_fact, calendar_bounds_of, cross_dc_flag,
                                     derived_columns, insert_if_absent, resolve_amount)
from tillstar.plans import fixtures as fx
from tillstar.plans import pipeline
from tillstar.plans.oracle_fixtures import with_fixtures as W
from tillstar.plans.oracle_marts import SQL as MART_SQL
from tillstar.session import fresh_path
from tillstar.sources import csv_staging, landing, lookups
from tillstar.sources.tables import load
from tillstar.streaming import events as ev
from tillstar.streaming import jobs

Q: dict = {}
SQL: dict[str, str] = {}


def reg(key: str, sql: str | None = None):
    def deco(fn):
        Q[key] = fn
        if sql is not None:
            SQL[key] = sql
        return fn
    return deco


def _d(c: str) -> F.Column:
    return F.col(c).cast("double")


def _ntz(c: str) -> F.Column:
    return F.col(c).cast("timestamp_ntz").alias(c)


# =================================================================== star builders
_DATE_SQL = """
SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_key, d AS full_date,
  CAST(year(d) AS SMALLINT) AS year, CAST(quarter(d) AS SMALLINT) AS quarter, CAST(month(d) AS SMALLINT) AS month,
  monthname(d) AS month_name, CAST(weekofyear(d) AS SMALLINT) AS week_of_year, CAST(day(d) AS SMALLINT) AS day_of_month,
  CAST(isodow(d) AS SMALLINT) AS day_of_week, dayname(d) AS day_name, isodow(d) IN (6, 7) AS is_weekend
FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d
      FROM (SELECT CAST(date_trunc('year', min(o_orderdate)) AS TIMESTAMP) AS lo,
                   CAST(make_date(CAST(year(max(o_orderdate)) AS INTEGER), 12, 31) AS TIMESTAMP) AS hi FROM orders) b) s"""


@reg("dim_date", _DATE_SQL)
def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar covering the years of the order dates (range derived from the data)."""
    return build_calendar(calendar_bounds_of(load(spark, sf_dir, "orders"), "o_orderdate"))


@reg("dim_node", W("""
SELECT n.node_key, n.node_id, n.datacenter, n.aws_az, 'eu-west-3' AS aws_region, COALESCE(c.nb, 0) AS nb_transactions
FROM (SELECT * FROM (VALUES (1,'NDB-NODE-1','DC-NDB','eu-west-3c'),(2,'NDB-NODE-2','DC-NDB','eu-west-3c'),
  (3,'NKC-NODE-1','DC-NKC-PRIMARY','eu-west-3a'),(4,'NKC-NODE-2','DC-NKC-PRIMARY','eu-west-3a'),
  (5,'NKC-NODE-3','DC-NKC-SECONDARY','eu-west-3b')) AS t(node_key, node_id, datacenter, aws_az)) n
LEFT JOIN (SELECT x.node_id, COUNT(*) AS nb FROM fx_tx t JOIN fx_node x ON t.node_key = x.node_key GROUP BY x.node_id) c
  ON n.node_id = c.node_id""", "fx_tx", "fx_node"))
def dim_node(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The node dimension with the staging rows each node carries."""
    per = fx.stg_transactions(spark, sf_dir).groupBy("node_id").agg(F.count(F.lit(1)).alias("nb_transactions"))
    return (build_dim_node(spark).join(per, "node_id", "left")
            .select("node_key", "node_id", "datacenter", "aws_az", "aws_region",
                    F.coalesce("nb_transactions", F.lit(0)).alias("nb_transactions")))


@reg("dim_user", W("""
SELECT user_key, user_id, nni, full_name, CAST(NULL AS VARCHAR) AS gender, phone, email,
  CAST(wilaya_id AS INTEGER) AS wilaya_id, wilaya_name, CAST(NULL AS INTEGER) AS moughataa_id,
  CAST(NULL AS VARCHAR) AS moughataa_name, profile_type, kyc_level, status, CAST(NULL AS VARCHAR) AS device_type,
  registration_date, DATE '2024-01-01' AS effective_from, CAST(NULL AS DATE) AS effective_to, TRUE AS is_current
FROM fx_user""", "fx_user"))
def dim_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users cleaned from text staging, first SCD-2 load as of 2024-01-01."""
    return build_dim_user(fx.stg_users(spark, sf_dir), "2024-01-01")


@reg("dim_merchant", """
SELECT p_partkey AS merchant_key, p_partkey AS merchant_id, 'M' || CAST(p_partkey AS VARCHAR) AS code, p_name AS name,
  p_brand AS category_code, CASE WHEN p_partkey % 40 <> 0 THEN p_type END AS category_label, CAST(NULL AS VARCHAR) AS mcc, CAST(NULL AS INTEGER) AS wilaya_id,
  CAST(NULL AS VARCHAR) AS wilaya_name, CAST(NULL AS INTEGER) AS moughataa_id, CAST(NULL AS VARCHAR) AS moughataa_name,
  CAST((p_size % 10) / 100.0 AS DECIMAL(5,4)) AS commission_rate,
  CASE WHEN p_size % 8 = 0 THEN 'INACTIVE' ELSE 'ACTIVE' END AS status, CAST(NULL AS DATE) AS registration_date
FROM part
UNION ALL SELECT -1, -1, NULL, 'Sans marchand', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'N/A', NULL""")
def dim_merchant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3: merchants cleaned from text staging, plus the unknown member."""
    return build_dim_merchant(fx.stg_merchants(spark, sf_dir))


@reg("dim_agency", """
SELECT s_suppkey AS agency_key, s_suppkey AS agency_id, 'A' || CAST(s_suppkey AS VARCHAR) AS code, s_name AS name,
  CAST(n_nationkey AS INTEGER) AS wilaya_id, n_name AS wilaya_name, CAST(NULL AS INTEGER) AS moughataa_id,
  CAST(NULL AS VARCHAR) AS moughataa_name,
  CASE WHEN s_suppkey % 3 = 0 THEN 'GOLD' WHEN s_suppkey % 3 = 1 THEN 'SILVER' ELSE 'BRONZE' END AS tier,
  'ACTIVE' AS status, '08:00-18:00' AS opening_hours
FROM supplier JOIN nation ON s_nationkey = n_nationkey
UNION ALL SELECT -1, -1, NULL, 'Sans agence', NULL, NULL, NULL, NULL, NULL, 'N/A', NULL""")
def dim_agency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Agencies cleaned from text staging, plus the unknown member."""
    return build_dim_agency(fx.stg_agencies(spark, sf_dir))


_FACT_COLS = ["tx_pk", "date_key", "user_key", "merchant_key", "agency_key", "node_key", "amount", "fee",
              "transaction_type", "status", "failure_reason", "sync_status", "is_conflict", "is_lagging",
              "is_pending_sync", "is_cross_dc", "transaction_date"]


@reg("fact_transactions", W(f"SELECT {', '.join(_FACT_COLS)} FROM fx_fact", "fx_fact"))
def fact_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact loaded from text staging (node inner join, -1 defaults, conflict amount)."""
    return fx.fixture_star(spark, sf_dir).fact.select(*_FACT_COLS)


# =================================================================== sources and sinks
@reg("csv_staging_roundtrip", W("""
SELECT t.tx_id AS id, t.transaction_type, t.amount, COALESCE(t.fee, CAST(0 AS DECIMAL(18,2))) AS fee, t.status,
  NULLIF(TRIM(t.failure_reason), '') AS failure_reason, t.sync_status, n.node_id, t.datacenter, t.transaction_date,
  t.amount_node_a
FROM fx_tx t JOIN fx_node n ON t.node_key = n.node_key""", "fx_tx", "fx_node"))
def csv_staging_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging written as text CSV, read back with a declared schema (FAILFAST),
    then typed and cleaned."""
    stg = fx.stg_transactions(spark, sf_dir)
    path = csv_staging.write_staging_csv(stg, fresh_path(spark, "staging-csv"))
    back = csv_staging.read_staging(spark, path, csv_staging.text_schema(stg))
    return back.select(
        "id", "transaction_type", money("amount").alias("amount"), fee_or_zero("fee").alias("fee"), "status",
        blank_to_null("failure_reason").alias("failure_reason"), "sync_status", "node_id", "datacenter",
        guarded_cast("transaction_date", "date").alias("transaction_date"), money("amount_node_a").alias("amount_node_a"))


_LOADED = """
SELECT *, CASE WHEN tx_pk % 71 = 0 THEN -1 ELSE user_key END AS loaded_user FROM fx_fact WHERE tx_pk % 83 <> 0"""


@reg("star_load", W("""
SELECT f.transaction_type, COALESCE(u.wilaya_name, '?') AS wilaya, COUNT(*) AS nb, COUNT(*) FILTER (WHERE loaded_user = -1) AS nb_unknown_user,
  COUNT(*) FILTER (WHERE fee = 0) AS nb_no_fee, COUNT(tx_hour) AS nb_timed, CAST(SUM(tx_hour) AS BIGINT) AS hours,
  CAST(ROUND(SUM(amount), 0) AS DOUBLE) AS volume_mru, CAST(SUM(total_amount) AS DOUBLE) AS total_mru,
  CAST(SUM(balance_after) AS DOUBLE) AS balances, COUNT(risk_score) AS nb_risk
FROM loaded f LEFT JOIN fx_user u ON u.user_key = f.loaded_user GROUP BY ALL""", "fx_fact", "fx_user", extra=[("loaded", _LOADED)]))
def star_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole load from declared text staging to the written star, with unknown users and nodes,
    blank fees, times, balances and risks; read back by the fact and its user dimension."""
    star = pipeline.load_star(spark, sf_dir, fresh_path(spark, "star-load"), fx.staging_with_gaps(spark, sf_dir))
    j = star.fact.join(star.user.select("user_key", "wilaya_name"), "user_key", "left")
    return j.groupBy("transaction_type", F.coalesce("wilaya_name", F.lit("?")).alias("wilaya")).agg(
        F.count(F.lit(1)).alias("nb"), F.sum((F.col("user_key") == -1).cast("bigint")).alias("nb_unknown_user"),
        F.sum((F.col("fee") == 0).cast("bigint")).alias("nb_no_fee"), F.count("tx_hour").alias("nb_timed"),
        F.sum("tx_hour").cast("bigint").alias("hours"), marts.r0(F.sum("amount")).alias("volume_mru"),
        F.sum("total_amount").cast("double").alias("total_mru"), F.sum("balance_after").cast("double").alias("balances"),
        F.count("risk_score").alias("nb_risk"))


@reg("star_load_report", W("""
SELECT 'stg_users' AS table_name, COUNT(*) AS nb FROM customer UNION ALL SELECT 'stg_merchants', COUNT(*) FROM part
UNION ALL SELECT 'stg_agencies', COUNT(*) FROM supplier UNION ALL SELECT 'stg_transactions', COUNT(*) FROM fx_fact
UNION ALL SELECT 'dim_user', COUNT(*) + 1 FROM customer UNION ALL SELECT 'dim_merchant', COUNT(*) + 1 FROM part
UNION ALL SELECT 'dim_agency', COUNT(*) + 1 FROM supplier UNION ALL SELECT 'dim_node', COUNT(*) FROM fx_node
UNION ALL SELECT 'dim_date', COUNT(*) FROM fx_date UNION ALL SELECT 'fact_transactions', COUNT(*) FROM fx_fact WHERE tx_pk % 83 <> 0
UNION ALL SELECT 'dropped_unknown_node', COUNT(*) FROM fx_fact WHERE tx_pk % 83 = 0""", "fx_fact", "fx_node", "fx_date"))
def star_load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S8 DQ1 T4: rows staged, loaded and dropped by the load."""
    root = fresh_path(spark, "star-report")
    pipeline.load_star(spark, sf_dir, root, fx.staging_with_gaps(spark, sf_dir))
    return pipeline.load_report(spark, root)


@reg("dq_idempotency", W("""
SELECT COUNT(*) AS nb_cles_dupliquees, CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS nb_lignes_en_trop
FROM (SELECT idempotency_key, COUNT(*) AS n FROM fx_fact WHERE idempotency_key IS NOT NULL GROUP BY ALL HAVING COUNT(*) > 1)""", "fx_fact"))
def dq_idempotency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ13: idempotency keys carried by more than one transaction (rows without a key are no duplicates)."""
    keyed = fx.fixture_star(spark, sf_dir, lookups=()).fact.filter(F.col("idempotency_key").isNotNull())
    d = duplicate_keys(keyed, ["idempotency_key"])
    return d.agg(F.count(F.lit(1)).alias("nb_cles_dupliquees"),
                 F.coalesce(F.sum(F.col("nb_versions") - 1), F.lit(0)).cast("bigint").alias("nb_lignes_en_trop"))


def _business_days(orders: DataFrame) -> DataFrame:
    return (orders.select(F.col("o_orderdate").cast("date").alias("full_date")).distinct()
            .select(((F.year("full_date") * 10000 + F.month("full_date") * 100
                      + F.dayofmonth("full_date")).cast("int")).alias("date_key"), "full_date"))


_DAYS_SQL = """
SELECT DISTINCT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_key, d AS full_date
FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders) s"""


@reg("insert_if_absent", _DAYS_SQL)
def insert_if_absent_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Add the business days of all orders to the days already known from
    finished orders, without duplicating a key."""
    o = load(spark, sf_dir, "orders")
    existing = _business_days(o.filter(F.col("o_orderstatus") == "F"))
    return insert_if_absent(existing, _business_days(o), ["date_key"])


@reg("insert_if_absent_bucketed", _DAYS_SQL)
def insert_if_absent_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same into a bucketed table: new days are appended to their buckets, no file is replaced; a repeat adds nothing."""
    o = load(spark, sf_dir, "orders")
    root = fresh_path(spark, "business-days")
    bucketed.write_table(_business_days(o.filter(F.col("o_orderstatus") == "F")), root, "date_key", buckets=8)
    for _ in range(2):
        bucketed.insert_absent(spark, root, _business_days(o), "date_key")
    return bucketed.read_table(spark, root)


@reg("dq_table_counts", W("""
SELECT 'dim_date' AS table_name, COUNT(*) AS nb FROM fx_date
UNION ALL SELECT 'dim_user', COUNT(*) FROM fx_user
UNION ALL SELECT 'dim_merchant', COUNT(*) FROM fx_merchant
UNION ALL SELECT 'dim_agency', COUNT(*) FROM fx_agency
UNION ALL SELECT 'dim_node', COUNT(*) FROM fx_node
UNION ALL SELECT 'fact_transactions', COUNT(*) FROM fx_fact""", "fx_date", "fx_user", "fx_merchant", "fx_agency",
                              "fx_node", "fx_fact"))
def dq_table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ1/S8/U1: row count of every star table, as one UNION ALL."""
    s = fx.fixture_star(spark, sf_dir)
    return quality.table_counts({"dim_date": s.date, "dim_user": s.user, "dim_merchant": s.merchant,
                                 "dim_agency": s.agency, "dim_node": s.node, "fact_transactions": s.fact})


@reg("landing_roundtrip", W("""
SELECT CAST(ts AS DATE) AS dt, CAST(hour(ts) AS INTEGER) AS hh, COUNT(*) AS nb_transactions,
  CAST(SUM(amount) AS DOUBLE) AS volume
FROM fx_events GROUP BY 1, 2""", "fx_events"))
def landing_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CDC landing written as Parquet partitioned by dt/hh, read back by partition."""
    path = landing.write_landing(fx.event_transactions(spark, sf_dir), fresh_path(spark, "landing"))
    back = landing.read_landing(spark, path)
    return back.groupBy("dt", "hh").agg(F.count(F.lit(1)).alias("nb_transactions"),
                                        F.sum("amount").cast("double").alias("volume"))


@reg("layout_pruned_scan", W("""
SELECT CAST(year(transaction_date) * 100 + month(transaction_date) AS INTEGER) AS tx_month, status,
  COUNT(*) AS nb_transactions, CAST(ROUND(SUM(amount), 0) AS DOUBLE) AS volume_mru
FROM fx_fact WHERE year(transaction_date) = 1996 GROUP BY 1, 2""", "fx_fact"))
def layout_pruned_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact written in its layout (month partitions, sorted by date/status/type),
    read back with only the needed columns and the month partitions of one year."""
    path = landing.write_fact_layout(fx.fixture_star(spark, sf_dir, lookups=()).fact, fresh_path(spark, "fact-layout"))
    f = spark.read.parquet(path).filter(landing.month_filter("tx_month", 199601, 199612))
    return f.groupBy("tx_month", "status").agg(F.count(F.lit(1)).alias("nb_transactions"),
                                               marts.r0(F.sum("amount")).alias("volume_mru"))


@reg("archive_split", W("""
SELECT CASE WHEN transaction_date < (SELECT max(transaction_date) - INTERVAL 6 MONTH FROM fx_fact)
  THEN 'archive' ELSE 'hot' END AS store,
  COUNT(*) AS nb_transactions, CAST(ROUND(SUM(amount), 0) AS DOUBLE) AS volume_mru,
  min(transaction_date) AS first_date, max(transaction_date) AS last_date
FROM fx_fact GROUP BY 1""", "fx_fact"))
def archive_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows older than 6 months before the latest day go to the archive store;
    both stores read back as one frame."""
    fact = fx.fixture_star(spark, sf_dir).fact
    both = landing.read_both(spark, landing.split_hot_archive(fact, fresh_path(spark, "stores")), fact.schema)
    return both.groupBy("store").agg(F.count(F.lit(1)).alias("nb_transactions"),
                                     marts.r0(F.sum("amount")).alias("volume_mru"),
                                     F.min("transaction_date").alias("first_date"),
                                     F.max("transaction_date").alias("last_date"))


_TYPES_VALUES = ", ".join(f"({i}, '{c}')" for i, c in lookups.TX_TYPES)


@reg("lookup_join", W(f"""
SELECT l.type_id, l.code, COUNT(*) AS nb_transactions, CAST(ROUND(SUM(f.amount), 0) AS DOUBLE) AS volume_mru
FROM fx_fact f JOIN (SELECT * FROM (VALUES {_TYPES_VALUES}) AS t(type_id, code)) l ON f.transaction_type = l.code
GROUP BY l.type_id, l.code""", "fx_fact"))
def lookup_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact joined to the transaction-type lookup, scanned from its CSV file."""
    f = fx.fixture_star(spark, sf_dir, lookups=()).fact
    path = lookups.write_lookup(spark, "tx_types", fresh_path(spark, "lookup-types"))
    t = lookups.read_lookup(spark, "tx_types", path).select(F.col("id").alias("type_id"), "code")
    return (f.join(t, f["transaction_type"] == t["code"]).groupBy("type_id", "code")
            .agg(F.count(F.lit(1)).alias("nb_transactions"), marts.r0(F.sum("amount")).alias("volume_mru")))


@reg("export_guard", W("""
SELECT export_name, demandeur, nb_lignes,
  CASE WHEN nb_lignes > 50000 THEN 'REFUSE' WHEN nb_lignes > 10000 THEN 'ALERT' ELSE 'OK' END AS decision
FROM req""", "fx_fact", "fx_user", extra=[("req", """
SELECT 'top_wilaya' AS export_name, 'analyste_junior' AS demandeur,
  LEAST((SELECT COUNT(DISTINCT u.wilaya_name) FROM fx_fact f JOIN fx_user u ON f.user_key = u.user_key
         WHERE f.is_conflict = FALSE AND u.is_current AND u.wilaya_name IS NOT NULL), 10) AS nb_lignes
UNION ALL SELECT 'dim_user_masque', 'analyste_junior', COUNT(*) FROM fx_user
UNION ALL SELECT 'fact_transactions', 'analyste_junior', COUNT(*) FROM fx_fact""")]))
def export_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Guarded CSV exports with an audit row each (alert above 10,000 rows,
    refused above 50,000; the audit row has the true count)."""
    s = fx.fixture_star(spark, sf_dir)
    path = fresh_path(spark, "export-fact")  # the warehouse's fact, which all requests read
    s.fact.select("tx_pk", "transaction_date", "amount", "user_key", "is_conflict").write.parquet(path)
    s = s.with_fact(spark.read.parquet(path))
    reqs = [("top_wilaya", marts.q4_top_wilaya(s)),
            ("dim_user_masque", gov.masked_users(s.user, "analyste_junior")),
            ("fact_transactions", s.fact.select("tx_pk", "transaction_date", "amount"))]
    audits = [gov.guarded_export(df, name, "analyste_junior", fresh_path(spark, f"export-{name}"))
              for name, df in reqs]
    return gov.union_all(audits).drop("fichier")


# =================================================================== cleaning and casting
_USER_TEXT = ["full_name", "email", "kyc_level", "moughataa_name", "registration_date", "phone"]


@reg("clean_blank_to_null", W("""
SELECT user_id AS id, full_name, email, CAST(NULL AS VARCHAR) AS kyc_level, CAST(NULL AS VARCHAR) AS moughataa_name,
  strftime(registration_date, '%Y-%m-%d') AS registration_date, phone
FROM fx_user""", "fx_user"))
def clean_blank_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULLIF(TRIM(x), '') over every text column of the user staging."""
    return clean_text_columns(fx.stg_users(spark, sf_dir)).select("id", *_USER_TEXT)


@reg("clean_casts", W("""
SELECT tx_id AS id, amount, COALESCE(fee, CAST(0 AS DECIMAL(18,2))) AS fee, amount_node_a, transaction_date,
  CAST(updated_at AS TIMESTAMP) AS updated_at
FROM fx_tx""", "fx_tx"))
def clean_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Guarded text casts to decimal, date and timestamp; blank fee = 0."""
    t = fx.stg_transactions(spark, sf_dir)
    return t.select("id", money("amount").alias("amount"), fee_or_zero("fee").alias("fee"),
                    money("amount_node_a").alias("amount_node_a"),
                    guarded_cast("transaction_date", "date").alias("transaction_date"),
                    guarded_cast("updated_at", "timestamp_ntz").alias("updated_at"))


@reg("quarantine_bad_rows", W("""
SELECT reason, COUNT(*) AS nb FROM (
  SELECT CASE WHEN TRY_CAST(amount_txt AS DECIMAL(18,2)) IS NULL THEN 'montant_invalide'
              WHEN TRY_CAST(date_txt AS DATE) IS NULL THEN 'date_invalide'
              WHEN node_id NOT IN (SELECT node_id FROM fx_node) THEN 'noeud_inconnu'
              ELSE 'valide' END AS reason
  FROM (SELECT CASE WHEN tx_id % 97 = 0 THEN 'N/A' ELSE CAST(amount AS VARCHAR) END AS amount_txt,
               CASE WHEN tx_id % 89 = 0 THEN '2001-02-30x' ELSE CAST(transaction_date AS VARCHAR) END AS date_txt,
               CASE WHEN tx_id % 83 = 0 THEN 'NKC-NODE-9' ELSE n.node_id END AS node_id
        FROM fx_tx t JOIN fx_node n ON t.node_key = n.node_key) s) r
GROUP BY reason""", "fx_tx", "fx_node"))
def quarantine_bad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose hard casts would fail, or whose node is unknown, are split off
    with a reason instead of failing the load."""
    t = fx.stg_transactions_with_defects(spark, sf_dir)
    nodes = F.broadcast(build_dim_node(spark).select(F.col("node_id").alias("_known")))
    t = t.join(nodes, t["node_id"] == nodes["_known"], "left")
    reason = (F.when(lenient_cast("amount", "decimal(18,2)").isNull(), "montant_invalide")
              .when(lenient_cast("transaction_date", "date").isNull(), "date_invalide")
              .when(F.col("_known").isNull(), "noeud_inconnu").otherwise("valide"))
    return t.groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("nb"))


@reg("resolve_conflict_amount", W("""
SELECT tx_id AS tx_pk, amount AS montant_base, amount_node_a, amount_node_b,
  CASE WHEN amount_node_a IS NOT NULL THEN amount_node_a ELSE amount END AS montant_retenu
FROM fx_tx WHERE sync_status = 'CONFLICT'""", "fx_tx"))
def resolve_conflict_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amount kept for conflicting rows (node a when present, else the base amount)."""
    t = fx.stg_transactions(spark, sf_dir).filter(F.col("sync_status") == "CONFLICT")
    return t.select(F.col("id").alias("tx_pk"), money("amount").alias("montant_base"),
                    money("amount_node_a").alias("amount_node_a"), money("amount_node_b").alias("amount_node_b"),
                    resolve_amount("node_a").alias("montant_retenu"))


@reg("sync_flags", W("""
SELECT sync_status, is_conflict, is_lagging, is_pending_sync, COUNT(*) AS nb FROM fx_fact GROUP BY 1, 2, 3, 4""",
                     "fx_fact"))
def sync_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10: quality flags derived from the sync status."""
    return (fx.fixture_star(spark, sf_dir, lookups=()).fact
            .groupBy("sync_status", "is_conflict", "is_lagging", "is_pending_sync")
            .agg(F.count(F.lit(1)).alias("nb")))


@reg("cross_dc_flag", W("""
SELECT t.datacenter, n.node_id,
  ((t.datacenter = 'DC-NDB' AND n.node_id LIKE 'NKC%') OR (t.datacenter LIKE 'DC-NKC%' AND n.node_id LIKE 'NDB%')) AS is_cross_dc,
  COUNT(*) AS nb
FROM fx_tx t JOIN fx_node n ON t.node_key = n.node_key GROUP BY 1, 2, 3""", "fx_tx", "fx_node"))
def cross_dc_flag_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions whose datacenter family differs from their node's."""
    t = fx.stg_transactions(spark, sf_dir)
    return (t.groupBy("datacenter", "node_id", cross_dc_flag().alias("is_cross_dc"))
            .agg(F.count(F.lit(1)).alias("nb")))


@reg("fn_strings", W("""
SELECT failure_reason AS brut, TRIM(failure_reason) AS nettoye, NULLIF(TRIM(failure_reason), '') AS sans_blanc,
  COALESCE(NULLIF(TRIM(failure_reason), ''), 'Non précisé') AS libelle, COUNT(*) AS nb
FROM fx_tx GROUP BY failure_reason""", "fx_tx"))
def fn_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TRIM, NULLIF and COALESCE over the raw failure reasons."""
    t = fx.stg_transactions(spark, sf_dir)
    c = F.col("failure_reason")
    return t.groupBy(c.alias("brut")).agg(F.count(F.lit(1)).alias("nb")).select(
        "brut", F.trim("brut").alias("nettoye"), F.nullif(F.trim("brut"), F.lit("")).alias("sans_blanc"),
        F.coalesce(F.nullif(F.trim("brut"), F.lit("")), F.lit("Non précisé")).alias("libelle"), "nb")


# =================================================================== joins
@reg("join_fact_date", W("""
SELECT d.year, d.quarter, COUNT(*) AS nb_transactions, CAST(ROUND(SUM(f.amount), 0) AS DOUBLE) AS volume_mru
FROM fx_fact f JOIN fx_date d ON f.date_key = d.date_key GROUP BY 1, 2""", "fx_fact", "fx_date"))
def join_fact_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact joined to the calendar (broadcast), volume per quarter."""
    s = fx.fixture_star(spark, sf_dir, lookups=())
    d = F.broadcast(s.date.select("date_key", F.col("year").cast("int").alias("year"),
                                  F.col("quarter").cast("int").alias("quarter")))
    return (s.fact.join(d, "date_key").groupBy("year", "quarter")
            .agg(F.count(F.lit(1)).alias("nb_transactions"), marts.r0(F.sum("amount")).alias("volume_mru")))


@reg("dq_orphans", W("""
SELECT 'user_key' AS foreign_key, CAST(SUM(CASE WHEN user_key = -1 THEN 1 ELSE 0 END) AS BIGINT) AS nb_unknown_member,
  CAST((SELECT COUNT(*) FROM fx_fact f WHERE f.user_key <> -1 AND NOT EXISTS (SELECT 1 FROM fx_user u WHERE u.user_key = f.user_key)) AS BIGINT) AS nb_orphans FROM fx_fact
UNION ALL SELECT 'merchant_key', CAST(SUM(CASE WHEN merchant_key = -1 THEN 1 ELSE 0 END) AS BIGINT),
  CAST((SELECT COUNT(*) FROM fx_fact f WHERE f.merchant_key <> -1 AND NOT EXISTS (SELECT 1 FROM fx_merchant m WHERE m.merchant_key = f.merchant_key)) AS BIGINT) FROM fx_fact
UNION ALL SELECT 'agency_key', CAST(SUM(CASE WHEN agency_key = -1 THEN 1 ELSE 0 END) AS BIGINT),
  CAST((SELECT COUNT(*) FROM fx_fact f WHERE f.agency_key <> -1 AND NOT EXISTS (SELECT 1 FROM fx_agency a WHERE a.agency_key = f.agency_key)) AS BIGINT) FROM fx_fact
UNION ALL SELECT 'node_key', CAST(SUM(CASE WHEN node_key = -1 THEN 1 ELSE 0 END) AS BIGINT),
  CAST((SELECT COUNT(*) FROM fx_fact f WHERE f.node_key <> -1 AND NOT EXISTS (SELECT 1 FROM fx_node n WHERE n.node_key = f.node_key)) AS BIGINT) FROM fx_fact
UNION ALL SELECT 'date_key', CAST(SUM(CASE WHEN date_key = -1 THEN 1 ELSE 0 END) AS BIGINT),
  CAST((SELECT COUNT(*) FROM fx_fact f WHERE f.date_key <> -1 AND NOT EXISTS (SELECT 1 FROM fx_date d WHERE d.date_key = f.date_key)) AS BIGINT) FROM fx_fact""",
                     "fx_fact", "fx_user", "fx_merchant", "fx_agency", "fx_node", "fx_date"))
def dq_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ4/J12: rows on the unknown member and true orphans (anti join) per foreign key."""
    return quality.orphans(fx.fixture_star(spark, sf_dir))


_RLS_COLS = "f.tx_pk, f.user_key, CAST(f.amount AS DOUBLE) AS amount, f.transaction_date"


@reg("rls_filter", W(f"""
SELECT {_RLS_COLS} FROM fx_fact f JOIN fx_user u ON f.user_key = u.user_key
WHERE u.is_current AND u.wilaya_id = (SELECT n_nationkey FROM nation WHERE 'chef_wilaya_' || CAST(n_nationkey AS VARCHAR) = 'chef_wilaya_7')""",
                     "fx_fact", "fx_user"))
def rls_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A branch manager sees the transactions of their region only."""
    s = fx.fixture_star(spark, sf_dir)
    v = gov.rls_filter(s.fact, s.user, fx.profiles(spark, sf_dir), "chef_wilaya_7", "chef_agence")
    return v.select("tx_pk", "user_key", _d("amount").alias("amount"), "transaction_date")


@reg("rls_filter_bypass", W(f"SELECT {_RLS_COLS} FROM fx_fact f", "fx_fact"))
def rls_filter_bypass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The director role bypasses the row policy."""
    s = fx.fixture_star(spark, sf_dir)
    v = gov.rls_filter(s.fact, s.user, fx.profiles(spark, sf_dir), "dg", "directeur_general")
    return v.select("tx_pk", "user_key", _d("amount").alias("amount"), "transaction_date")


@reg("recon_node_totals", W("""
SELECT COALESCE(l.node_id, f.node_id) AS node_id, CAST(l.ledger_total AS DOUBLE) AS ledger_total,
  CAST(f.fact_total AS DOUBLE) AS fact_total,
  CAST(COALESCE(l.ledger_total, 0) - COALESCE(f.fact_total, 0) AS DOUBLE) AS ecart,
  CAST(ROUND((COALESCE(l.ledger_total, 0) - COALESCE(f.fact_total, 0)) * 100 / NULLIF(f.fact_total, 0), 4) AS DOUBLE) AS ecart_pct,
  ABS((COALESCE(l.ledger_total, 0) - COALESCE(f.fact_total, 0)) * 100 / NULLIF(f.fact_total, 0)) <= 0.5 AS within_tolerance
FROM (SELECT n.node_id, SUM(t.amount) + CASE WHEN n.node_id = 'NDB-NODE-1' THEN CAST(1300.88 AS DECIMAL(18,2)) ELSE 0 END AS ledger_total
      FROM fx_tx t JOIN fx_node n ON t.node_key = n.node_key GROUP BY n.node_id) l
FULL OUTER JOIN (SELECT n.node_id, SUM(f.amount) AS fact_total FROM fx_fact f JOIN fx_node n ON f.node_key = n.node_key
                 GROUP BY n.node_id) f ON l.node_id = f.node_id""", "fx_tx", "fx_fact", "fx_node"))
def recon_node_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ7/J15: node ledger vs fact totals per node (full outer join), gap and tolerance."""
    s = fx.fixture_star(spark, sf_dir, lookups=())
    return quality.node_reconciliation(fx.node_ledger(spark, sf_dir), s.fact, s.node)


# =================================================================== aggregations and windows
@reg("dq_sync_distribution", W("""
SELECT sync_status, COUNT(*) AS nb, CAST(ROUND(COUNT(*) * 100.0 / SUM(COUNT(*)) OVER (), 2) AS DOUBLE) AS pct
FROM fx_fact GROUP BY sync_status""", "fx_fact"))
def dq_sync_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ2: sync status distribution with share."""
    return quality.distribution(fx.fixture_star(spark, sf_dir, lookups=()).fact, "sync_status", "nb", "pct", 2)


@reg("dq_status_distribution", W("SELECT status, COUNT(*) AS nb FROM fx_fact GROUP BY status", "fx_fact"))
def dq_status_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ3: status distribution."""
    return quality.distribution(fx.fixture_star(spark, sf_dir, lookups=()).fact, "status", "nb", None)


@reg("dq_volume", W("""
SELECT CAST(ROUND(SUM(amount), 0) AS DOUBLE) AS volume_total_mru, CAST(ROUND(SUM(fee), 0) AS DOUBLE) AS frais_total_mru
FROM fx_fact""", "fx_fact"))
def dq_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ3: total volume and fees (every row)."""
    return quality.volume_totals(fx.fixture_star(spark, sf_dir, lookups=()).fact)


@reg("share_of_total", W("""
SELECT n.node_id, COUNT(*) AS nb, CAST(ROUND(COUNT(*) * 100.0 / SUM(COUNT(*)) OVER (), 2) AS DOUBLE) AS pct
FROM fx_fact f JOIN fx_node n ON f.node_key = n.node_key GROUP BY n.node_id""", "fx_fact", "fx_node"))
def share_of_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of total over grouped rows (grand total joined back, no single-partition window)."""
    s = fx.fixture_star(spark, sf_dir, lookups=())
    g = (s.fact.join(F.broadcast(s.node.select("node_key", "node_id")), "node_key")
         .groupBy("node_id").agg(F.count(F.lit(1)).alias("nb")))
    return with_share(g, "nb", "pct", 2)


_DEDUP_COLS = ["tx_id", "user_key", "transaction_type", "amount", "status", "transaction_date", "updated_at",
               "l_partkey", "l_suppkey", "l_quantity"]


@reg("dedup_latest", W(f"SELECT {', '.join(_DEDUP_COLS)} FROM fx_tx", "fx_tx"))
def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W3/DQ13: latest version per transaction id (partial aggregate, hot-key safe)."""
    raw = fx.fx_tx_raw(spark, sf_dir)
    return latest_per_key(raw, ["tx_id"], fx.TX_VERSION_ORDER).select(*_DEDUP_COLS)


@reg("dq_duplicate_ids", W("""
SELECT COUNT(*) AS nb_ids_dupliques, CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS nb_versions_en_trop
FROM (SELECT tx_id, COUNT(*) AS n FROM fx_tx_raw GROUP BY tx_id HAVING COUNT(*) > 1) d""", "fx_tx_raw"))
def dq_duplicate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ13: transaction ids seen more than once, and the extra versions."""
    d = duplicate_keys(fx.fx_tx_raw(spark, sf_dir), ["tx_id"])
    return d.agg(F.count(F.lit(1)).alias("nb_ids_dupliques"),
                 F.coalesce(F.sum(F.col("nb_versions") - 1), F.lit(0)).cast("bigint").alias("nb_versions_en_trop"))


# =================================================================== data quality and reconciliation
@reg("conflict_strategy_totals", W("""
SELECT 'exclude' AS strategy, CAST(SUM(CASE WHEN sync_status <> 'CONFLICT' THEN 1 ELSE 0 END) AS BIGINT) AS nb_transactions,
  CAST(ROUND(SUM(CASE WHEN sync_status <> 'CONFLICT' THEN amount END), 0) AS DOUBLE) AS volume_mru FROM fx_tx
UNION ALL SELECT 'node_a', COUNT(*), CAST(ROUND(SUM(CASE WHEN sync_status = 'CONFLICT' AND amount_node_a IS NOT NULL THEN amount_node_a ELSE amount END), 0) AS DOUBLE) FROM fx_tx
UNION ALL SELECT 'node_b', COUNT(*), CAST(ROUND(SUM(CASE WHEN sync_status = 'CONFLICT' AND amount_node_b IS NOT NULL THEN amount_node_b ELSE amount END), 0) AS DOUBLE) FROM fx_tx
UNION ALL SELECT 'base', COUNT(*), CAST(ROUND(SUM(amount), 0) AS DOUBLE) FROM fx_tx""", "fx_tx"))
def conflict_strategy_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ5: the four conflict strategies side by side, one pass over staging."""
    return quality.conflict_strategy_totals(fx.stg_transactions(spark, sf_dir))


@reg("conflict_fill_rate", W("""
SELECT COUNT(*) AS nb_conflicts, COUNT(amount_node_a) AS nb_with_node_a, COUNT(amount_node_b) AS nb_with_node_b,
  CAST(SUM(CASE WHEN amount_node_a IS NULL AND amount_node_b IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS nb_without_node_amounts,
  CAST(ROUND(COUNT(amount_node_a) * 100.0 / NULLIF(COUNT(*), 0), 2) AS DOUBLE) AS fill_pct
FROM fx_tx WHERE sync_status = 'CONFLICT'""", "fx_tx"))
def conflict_fill_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ6: how many conflicting rows actually carry node amounts."""
    t = fx.stg_transactions(spark, sf_dir).select(
        "sync_status", blank_to_null("amount_node_a").alias("amount_node_a"),
        blank_to_null("amount_node_b").alias("amount_node_b"))
    return quality.conflict_fill_rate(t)


@reg("dq_sync_before_create", W("""
SELECT CAST(year(created_at) AS INTEGER) AS annee, COUNT(*) AS nb_transactions,
  COUNT(*) FILTER (WHERE last_synced_at < created_at) AS nb_sync_avant_creation,
  CAST(ROUND(COUNT(*) FILTER (WHERE last_synced_at < created_at) * 100.0 / COUNT(*), 2) AS DOUBLE) AS pct
FROM fx_fact GROUP BY 1""", "fx_fact"))
def dq_sync_before_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ8: rows synchronized before their creation date, per year."""
    return quality.sync_before_create(fx.fixture_star(spark, sf_dir, lookups=()).fact)


_NULL_COLS = ["user_key", "full_name", "wilaya_name", "phone", "nni", "email", "kyc_level", "status",
              "registration_date"]
_NULL_SQL = "\nUNION ALL ".join(
    f"SELECT 'dim_user' AS table_name, '{c}' AS column_name, CAST(SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS nb_null, "
    f"COUNT(*) AS nb_total, CAST(ROUND(SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) * 100.0 / COUNT(*), 2) AS DOUBLE) AS null_pct FROM fx_user"
    for c in _NULL_COLS)


@reg("dq_null_profile", W(_NULL_SQL, "fx_user"))
def dq_null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ9: NULL rate of every user column in one pass."""
    return quality.null_profile(fx.fx_user(spark, sf_dir).select(*_NULL_COLS), "dim_user")


@reg("recon_fees", W("""
SELECT statut, COUNT(*) AS nb_transactions, CAST(ROUND(SUM(COALESCE(fact_fee, ledger_fee)), 2) AS DOUBLE) AS frais_mru FROM (
  SELECT CASE WHEN l.ledger_fee IS NULL THEN 'absent_du_registre' WHEN f.fact_fee IS NULL THEN 'absent_du_fait'
              WHEN l.ledger_fee <> f.fact_fee THEN 'montant_different' ELSE 'concordant' END AS statut,
         f.fact_fee, l.ledger_fee
  FROM (SELECT tx_id AS transaction_id, SUM(fee) AS ledger_fee FROM fx_tx WHERE fee > 0 AND tx_id % 101 <> 0 GROUP BY tx_id) l
  FULL OUTER JOIN (SELECT transaction_id, fee AS fact_fee FROM fx_fact WHERE fee > 0) f
  ON l.transaction_id = f.transaction_id) x GROUP BY statut""", "fx_tx", "fx_fact"))
def recon_fees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ10: fee ledger vs fact fees per transaction."""
    return quality.fee_reconciliation(fx.fee_ledger(spark, sf_dir), fx.fixture_star(spark, sf_dir, lookups=()).fact)


_LIVE_NRT = """
SELECT COALESCE(l.jour, n.jour) AS jour, COALESCE(l.nb, 0) AS {a}, COALESCE(n.nb, 0) AS {b},
  ROUND(CAST(COALESCE(l.nb, 0) - COALESCE(n.nb, 0) AS DOUBLE) * 100 / CAST(NULLIF(COALESCE(n.nb, 0), 0) AS DOUBLE), 3) AS ecart_pct,
  {flag}
FROM (SELECT CAST(ts AS DATE) AS jour, COUNT(*) AS nb FROM fx_events GROUP BY 1) l
FULL OUTER JOIN (SELECT CAST(ts AS DATE) AS jour, COUNT(*) AS nb FROM fx_events WHERE sync_status <> 'PENDING' GROUP BY 1) n
ON l.jour = n.jour"""


@reg("recon_live_badge", W(_LIVE_NRT.format(a="nb_live", b="nb_nrt",
                                            flag="COALESCE(l.nb, 0) > COALESCE(n.nb, 0) * 1.02 AS badge"), "fx_events"))
def recon_live_badge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ11/ST9: live counter (every event) vs near-real-time (committed) per day;
    badge when live exceeds NRT by more than 2 %. Same transforms as the streams."""
    tx = ev.as_transactions(load(spark, sf_dir, "events"))
    return quality.live_badge(ev.daily_counts(tx, "nb_live"), ev.daily_counts(ev.committed(tx), "nb_nrt"))


@reg("recon_nightly", W(_LIVE_NRT.format(
    a="nb_live", b="nb_batch",
    flag="CASE WHEN ABS(ROUND(CAST(COALESCE(l.nb, 0) - COALESCE(n.nb, 0) AS DOUBLE) * 100 / "
         "CAST(NULLIF(COALESCE(n.nb, 0), 0) AS DOUBLE), 3)) > 0.5 THEN 'ALERT' ELSE 'OK' END AS statut"), "fx_events"))
def recon_nightly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ12: live daily snapshot vs the nightly batch (deduplicated, committed);
    ALERT above 0.5 %."""
    tx = ev.as_transactions(load(spark, sf_dir, "events"))
    batch = latest_per_key(ev.committed(tx), ["transaction_id"], [("ts", True)])
    return quality.nightly_reconciliation(ev.daily_counts(tx, "nb_live"), ev.daily_counts(batch, "nb_batch"))


@reg("nightly_refresh", MART_SQL["mv_daily_kpis"])
def nightly_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST10/S11: the gold daily-KPI table is first built from a load that kept every
    version of a transaction; the nightly batch deduplicates, writes the fact in its month
    layout, finds the months it touched, reads only their partitions and overwrites only those
    of the gold table. The result must equal a full recompute."""
    good = fx.fixture_star(spark, sf_dir, lookups=())
    stale = good.with_fact(build_fact(fx.stg_transactions(spark, sf_dir, dedup=False), good.user, good.merchant,
                                      good.agency, good.node, lookups=()))
    gold = fresh_path(spark, "gold-daily-kpis")
    refresh.write_gold(marts.mv_daily_kpis(stale), gold)
    raw = fx.fx_tx_raw(spark, sf_dir)
    dup_ids = duplicate_keys(raw, ["tx_id"]).select("tx_id")
    changed = (raw.join(dup_ids, "tx_id", "left_semi")
               .select(((F.year("transaction_date") * 10000 + F.month("transaction_date") * 100
                         + F.dayofmonth("transaction_date")).cast("int")).alias("date_key")))
    root = landing.write_fact_layout(good.fact, fresh_path(spark, "nightly-fact"))
    refresh.refresh_gold(good.with_fact(spark.read.parquet(root)), marts.mv_daily_kpis, gold, refresh.touched_months(changed))
    return refresh.read_gold(spark, gold)


@reg("refresh_emptied_month", MART_SQL["mv_daily_kpis"].replace("WHERE is_conflict IS FALSE", "WHERE is_conflict IS FALSE AND NOT (date_key BETWEEN 19970301 AND 19970331)"))
def refresh_emptied_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST10/S11: all rows of a month are withdrawn from the written fact; the refresh of that month reads its partition
    only and drops the gold month that came back empty."""
    star = fx.fixture_star(spark, sf_dir, settle=True)
    root = landing.write_fact_layout(star.fact, fresh_path(spark, "refresh-fact"), derived=derived_columns())
    star = star.with_fact(spark.read.parquet(root))
    gold = fresh_path(spark, "gold-emptied")
    refresh.write_gold(marts.mv_daily_kpis(star), gold)
    left = star.with_fact(star.fact.filter(F.col("tx_month") != 199703))
    refresh.refresh_gold(left, marts.mv_daily_kpis, gold, refresh.touched_months(spark.range(1).select(F.lit(19970315).alias("date_key"))))
    return refresh.read_gold(spark, gold)


# =================================================================== SCD
_D1, _D2 = "1998-01-01", "1999-01-01"
_V1 = "SELECT user_id, full_name, wilaya_id, wilaya_name, status FROM fx_user WHERE user_id % 97 <> 0"
_V2 = """SELECT u.user_id, u.full_name, n.n_nationkey AS wilaya_id, n.n_name AS wilaya_name, u.status
FROM fx_user u JOIN nation n ON n.n_nationkey = CASE WHEN u.user_id % 10 = 0 THEN (u.wilaya_id + 1) % 25 ELSE u.wilaya_id END"""


def _vk(d: str) -> str:
    return f"user_id * 100000 + CAST(DATE '{d}' - DATE '1970-01-01' AS BIGINT)"


_HIST_SQL = f"""
SELECT {_vk(_D1)} AS user_key, v1.user_id, v1.full_name, v1.wilaya_id, v1.wilaya_name, v1.status,
  DATE '{_D1}' AS effective_from, CASE WHEN v1.user_id % 10 = 0 THEN DATE '{_D2}' END AS effective_to,
  v1.user_id % 10 <> 0 AS is_current FROM v1
UNION ALL
SELECT {_vk(_D2)}, v2.user_id, v2.full_name, v2.wilaya_id, v2.wilaya_name, v2.status, DATE '{_D2}', CAST(NULL AS DATE), TRUE
FROM v2 WHERE v2.user_id % 10 = 0 OR v2.user_id % 97 = 0"""


@reg("scd2_initial", W(f"""
SELECT {_vk(_D1)} AS user_key, user_id, wilaya_id, DATE '{_D1}' AS effective_from, CAST(NULL AS DATE) AS effective_to,
  TRUE AS is_current FROM v1""", "fx_user", extra=[("v1", _V1)]))
def scd2_initial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First load of the user history (valid from the load date, open, current)."""
    h = scd.scd2_initial(fx.user_snapshot(spark, sf_dir, 1), "user_id", "user_key", _D1)
    return h.select("user_key", "user_id", "wilaya_id", "effective_from", "effective_to", "is_current")


@reg("scd1_upsert", W("SELECT user_id, full_name, wilaya_id, wilaya_name, status FROM v2", "fx_user",
                      extra=[("v2", _V2)]))
def scd1_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H2: type 1 overwrite of the users with the newer snapshot."""
    return scd.scd1_upsert(fx.user_snapshot(spark, sf_dir, 1), fx.user_snapshot(spark, sf_dir, 2), ["user_id"])


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    h1 = scd.scd2_initial(fx.user_snapshot(spark, sf_dir, 1), "user_id", "user_key", _D1)
    return scd.scd2_apply(h1, fx.user_snapshot(spark, sf_dir, 2), "user_id", "user_key", fx.SCD_TRACKED, _D2)


@reg("scd2_apply", W(_HIST_SQL, "fx_user", extra=[("v1", _V1), ("v2", _V2)]))
def scd2_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H3: type 2 apply: moved users get their version closed and a new one opened."""
    return _history(spark, sf_dir).select("user_key", "user_id", "full_name", "wilaya_id", "wilaya_name", "status",
                                          "effective_from", "effective_to", "is_current")


@reg("scd2_same_day", W(f"""
SELECT {_vk(_D2)} AS user_key, user_id, wilaya_id, status, DATE '{_D2}' AS effective_from, CAST(NULL AS DATE) AS effective_to, TRUE AS is_current
FROM (SELECT user_id, wilaya_id, 'FROZEN' AS status FROM v2 WHERE user_id % 10 = 0 OR user_id % 97 = 0)
UNION ALL
SELECT {_vk(_D1)}, user_id, wilaya_id, status, DATE '{_D1}', DATE '{_D2}', FALSE FROM v1
UNION ALL
SELECT {_vk(_D2)}, user_id, wilaya_id, 'FROZEN', DATE '{_D2}', CAST(NULL AS DATE), TRUE FROM v2 WHERE user_id % 10 <> 0 AND user_id % 97 <> 0""",
                        "fx_user", extra=[("v1", _V1), ("v2", _V2)]))
def scd2_same_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H3: a second change on the same day replaces the versions begun that day; every id keeps one version per day."""
    frozen = fx.user_snapshot(spark, sf_dir, 2).withColumn("status", F.lit("FROZEN"))
    h = scd.scd2_apply(_history(spark, sf_dir), frozen, "user_id", "user_key", fx.SCD_TRACKED, _D2)
    return h.select("user_key", "user_id", "wilaya_id", "status", "effective_from", "effective_to", "is_current")


_D3 = "2000-01-01"


@reg("scd2_bucketed", W(f"""
SELECT user_key, user_id, wilaya_id, status, effective_from, CASE WHEN is_current AND user_id % 500 = 7 THEN DATE '{_D3}' ELSE effective_to END AS effective_to,
  is_current AND user_id % 500 <> 7 AS is_current FROM hist
UNION ALL
SELECT {_vk(_D3)}, user_id, wilaya_id, 'FROZEN', DATE '{_D3}', CAST(NULL AS DATE), TRUE FROM v2 WHERE user_id % 500 = 7""",
                        "fx_user", extra=[("v1", _V1), ("v2", _V2), ("hist", _HIST_SQL)]))
def scd2_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H3: the user history in key buckets under three applies: many users moved, a few frozen (only their buckets are read and
    replaced), and the same snapshot again (none is)."""
    root = fresh_path(spark, "user-history")
    first, moved = fx.user_snapshot(spark, sf_dir, 1), fx.user_snapshot(spark, sf_dir, 2)
    frozen = moved.withColumn("status", F.when(F.col("user_id") % 500 == 7, "FROZEN").otherwise(F.col("status")))
    bucketed.write_history(scd.scd2_initial(first, "user_id", "user_key", _D1), first, root, "user_id", fx.SCD_TRACKED, _D1)
    for snapshot, day in ((moved, _D2), (frozen, _D3), (frozen, "2000-02-01")):
        bucketed.apply_snapshot(spark, root, snapshot, "user_id", "user_key", fx.SCD_TRACKED, day)
    return bucketed.read_table(spark, root).select("user_key", "user_id", "wilaya_id", "status", "effective_from", "effective_to", "is_current")


@reg("scd2_asof_join", W("""
SELECT h.wilaya_name, COUNT(*) AS nb_transactions, CAST(ROUND(SUM(f.amount), 0) AS DOUBLE) AS volume_mru
FROM fx_fact f JOIN hist h ON f.user_key = h.user_id AND h.effective_from <= f.transaction_date
  AND f.transaction_date < COALESCE(h.effective_to, DATE '9999-12-31')
GROUP BY h.wilaya_name""", "fx_fact", "fx_user", extra=[("v1", _V1), ("v2", _V2), ("hist", _HIST_SQL)]))
def scd2_asof_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each transaction with the user version valid on its date, by merging facts and versions in one sorted stream; volume
    per region as it was then."""
    fact = fx.fixture_star(spark, sf_dir, lookups=("user",)).fact
    h = _history(spark, sf_dir).select("user_id", "wilaya_name", "effective_from", "effective_to")
    j = merge_asof(fact.select("user_key", "transaction_date", "amount"), h, "user_key", "user_id", "transaction_date", ["wilaya_name"],
                   until=load(spark, sf_dir, "orders").agg(F.max("o_orderdate").cast("date")).scalar())
    return j.groupBy("wilaya_name").agg(F.count(F.lit(1)).alias("nb_transactions"),
                                        marts.r0(F.sum("amount")).alias("volume_mru"))


# =================================================================== governance
@reg("rls_users", W("""
SELECT user_id, wilaya_id, status FROM fx_user
WHERE wilaya_id = (SELECT n_nationkey FROM nation WHERE 'chef_wilaya_' || CAST(n_nationkey AS VARCHAR) = 'chef_wilaya_7')""", "fx_user"))
def rls_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1: the row policy on the user dimension itself."""
    return gov.rls_users(fx.fx_user(spark, sf_dir), fx.profiles(spark, sf_dir), "chef_wilaya_7", "chef_agence").select("user_id", "wilaya_id", "status")


@reg("mask_pii", W("""
SELECT user_id, '***-****-' || right(phone, 4) AS phone, '**********' AS nni,
  '****@' || split_part(email, '@', 2) AS email FROM fx_user""", "fx_user"))
def mask_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user dimension as a junior analyst reads it."""
    return gov.masked_users(fx.fx_user(spark, sf_dir), "analyste_junior").select("user_id", "phone", "nni", "email")


@reg("mask_pii_clear", W("SELECT user_id, phone, nni, email FROM fx_user", "fx_user"))
def mask_pii_clear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The DPO reads clear values."""
    return gov.masked_users(fx.fx_user(spark, sf_dir), "dpo").select("user_id", "phone", "nni", "email")


# What makes a hit h well formed, for DuckDB.
_DIGITS = "regexp_replace(h, '[^0-9]', '', 'g')"
_PII_VALID = {
    "EMAIL": f"regexp_matches(h, '{ids.EMAIL_FORM}') AND instr(h, '@') <= {ids.MAX_LOCAL_PART + 1}",
    "PHONE": f"""CASE WHEN h LIKE 'P%' THEN TRUE WHEN h LIKE '+222%' OR h NOT LIKE '+%' THEN regexp_matches({_DIGITS}, '{ids.NATIONAL_PHONE}')
      WHEN h LIKE '+1%' AND length({_DIGITS}) = 11 THEN regexp_matches({_DIGITS}, '{ids.NORTH_AMERICAN_PHONE}')
      ELSE length({_DIGITS}) BETWEEN 8 AND 15 END""",
    "NNI": "replace(h, left(h, 1), '') <> ''",
    "IBAN": f"""list_contains([{', '.join(f"'{c}'" for c in ids.IBAN_LENGTHS)}], left(h, 2) || CAST(length(replace(h, ' ', '')) AS VARCHAR))
      AND list_reduce(list_prepend(0, list_transform(string_split(substr(replace(h, ' ', ''), 5) || left(h, 4), ''),
            lambda c: CASE WHEN ascii(c) <= 57 THEN ascii(c) - 48 ELSE ascii(c) - 55 END)),
          lambda a, x: (a * CASE WHEN x > 9 THEN 100 ELSE 10 END + x) % 97) = 1""",
    "CARD": f"""list_sum(list_transform(string_split(reverse({_DIGITS}), ''),
      lambda c, i: CASE WHEN i % 2 = 1 THEN ascii(c) - 48 ELSE (ascii(c) - 48) * 2 - CASE WHEN c > '4' THEN 9 ELSE 0 END END)) % 10 = 0""",
}


def _pii_sql(table: str, col: str) -> str:
    parts = []
    for kind, pat in gov.PII_PATTERNS.items():
        parts.append(f"""SELECT '{table}' AS table_name, '{col}' AS column_name, '{kind}' AS pii_type,
  CAST(SUM(CASE WHEN len(hits) > 0 THEN 1 ELSE 0 END) AS BIGINT) AS nb_rows, CAST(SUM(COALESCE(len(hits), 0)) AS BIGINT) AS nb_hits,
  CAST(SUM(COALESCE(len(list_filter(hits, lambda h: {_PII_VALID[kind]})), 0)) AS BIGINT) AS nb_valid
FROM (SELECT regexp_extract_all({col}, '{pat}') AS hits FROM {table})""")
    return "\nUNION ALL ".join(parts)


_PII_COLUMNS = [("documents", "text"), ("conversations", "text"), ("pages", "html"), ("pages", "url"),
                ("fx_user", "full_name"), ("fx_user", "phone"), ("fx_user", "nni"), ("fx_user", "email"), ("fx_account", "compte")]


@reg("pii_scan", W("\nUNION ALL ".join(_pii_sql(t, c) for t, c in _PII_COLUMNS).replace("'fx_user' AS", "'dim_user' AS"), "fx_account"))
def pii_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PII detection over whole texts (documents, conversations, pages), the user dimension and account texts: hits, and how many
    of them are well formed."""
    tables = {"documents": load(spark, sf_dir, "documents"), "conversations": load(spark, sf_dir, "conversations"),
              "pages": load(spark, sf_dir, "pages"), "fx_user": fx.fx_user(spark, sf_dir), "fx_account": fx.user_accounts(spark, sf_dir)}
    return gov.union_all([
        gov.pii_scan(df, "dim_user" if t == "fx_user" else t, [c for name, c in _PII_COLUMNS if name == t]) for t, df in tables.items()])


@reg("project_by_class", W("SELECT user_key, user_id, wilaya_id, wilaya_name, profile_type, status FROM fx_user",
                           "fx_user"))
def project_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns tagged PII / INTERNAL / PUBLIC; a junior analyst gets no PII column."""
    u = fx.fx_user(spark, sf_dir).select("user_key", "user_id", "full_name", "wilaya_id", "wilaya_name",
                                         "profile_type", "status", "phone", "nni", "email")
    return gov.project_by_class(gov.with_classification(u), "analyste_junior")


_LOG = """SELECT event_id AS query_id, user_id, CAST(ts AS TIMESTAMP) AS ts, value AS elapsed_s,
  (event_id % 1000) * 1000 AS scanned_rows, (event_id % 200) * 100 AS returned_rows FROM events"""


@reg("audit_rules", W("""
SELECT 'kill_long_queries' AS rule, CAST(SUM(CASE WHEN elapsed_s > 300 THEN 1 ELSE 0 END) AS BIGINT) AS nb_hits, COUNT(*) AS nb_queries FROM qlog
UNION ALL SELECT 'limit_full_scan', CAST(SUM(CASE WHEN scanned_rows > 500000 THEN 1 ELSE 0 END) AS BIGINT), COUNT(*) FROM qlog
UNION ALL SELECT 'alert_no_filter', CAST(SUM(CASE WHEN scanned_rows > 90000 AND returned_rows > 10000 THEN 1 ELSE 0 END) AS BIGINT), COUNT(*) FROM qlog""",
                      extra=[("qlog", _LOG)]))
def audit_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monitoring rules applied to a query log."""
    return gov.audit_rules(fx.query_log(spark, sf_dir))


@reg("export_anomaly", W("""
SELECT user_id, jour, v AS lignes_exportees, ROUND(m, 4) AS moyenne_7j, ROUND(s, 4) AS ecart_type_7j,
  (h >= 3 AND ABS(v - m) > 3.0 * COALESCE(s, 0.0)) AS anomalie
FROM (SELECT user_id, jour, v, AVG(v) OVER w AS m, STDDEV_SAMP(v) OVER w AS s, COUNT(*) OVER w AS h
      FROM (SELECT user_id, CAST(ts AS DATE) AS jour, CAST(SUM(returned_rows) AS BIGINT) AS v FROM qlog GROUP BY 1, 2) d
      WINDOW w AS (PARTITION BY user_id ORDER BY jour ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)) x""",
                         extra=[("qlog", _LOG)]))
def export_anomaly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user and day, exported rows vs the trailing 7-day mean +- 3 sigma."""
    log = fx.query_log(spark, sf_dir).withColumn("jour", F.to_date("ts"))
    return gov.export_anomaly(log)


# =================================================================== streaming
_EV = "fx_events"


@reg("stream_cdc_clean", W("""
SELECT transaction_id, ts, amount, status, sync_status FROM fx_events WHERE sync_status <> 'PENDING'""", _EV))
def stream_cdc_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST1: near-real-time micro-batch ingest (committed rows, deduplicated)."""
    return jobs.stream_cdc_clean(spark, sf_dir).select("transaction_id", _ntz("ts"), "amount", "status",
                                                       "sync_status")


def _win_sql(unit: str, volume: bool = False) -> str:
    vol = ", CAST(SUM(amount) AS DOUBLE) AS volume" if volume else ""
    return W(f"""
SELECT date_trunc('{unit}', ts) AS window_start, date_trunc('{unit}', ts) + INTERVAL 1 {unit} AS window_end,
  COUNT(*) AS nb_transactions{vol}
FROM fx_events GROUP BY 1, 2""", _EV)


def _win_out(df: DataFrame) -> DataFrame:
    return df.select(_ntz("window_start"), _ntz("window_end"), *[c for c in df.columns if not c.startswith("window_")])


@reg("stream_hourly_count", _win_sql("hour"))
def stream_hourly_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _win_out(jobs.stream_hourly_count(spark, sf_dir))


@reg("stream_daily_count", _win_sql("day"))
def stream_daily_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _win_out(jobs.stream_daily_count(spark, sf_dir))


@reg("stream_daily_volume", _win_sql("day", volume=True))
def stream_daily_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _win_out(jobs.stream_daily_volume(spark, sf_dir))


@reg("stream_rate_5min", W("""
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, COUNT(*) AS nb_transactions
FROM (SELECT date_trunc('minute', ts) - k * INTERVAL 1 MINUTE AS window_start
      FROM fx_events, range(0, 5) r(k)) s GROUP BY 1, 2""", _EV))
def stream_rate_5min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _win_out(jobs.stream_rate_5min(spark, sf_dir))


@reg("stream_region_latest", W("""
SELECT u.wilaya_id, CAST(arg_max(e.amount, e.ts) AS DOUBLE) AS dernier_montant, max(e.ts) AS dernier_ts
FROM fx_events e JOIN fx_user u ON e.user_id = u.user_id GROUP BY u.wilaya_id""", _EV, "fx_user"))
def stream_region_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.stream_region_latest(spark, sf_dir).select("wilaya_id", "dernier_montant", _ntz("dernier_ts"))


@reg("stream_region_volume", W("""
SELECT u.wilaya_id, COUNT(*) AS nb_transactions, CAST(SUM(e.amount) AS DOUBLE) AS volume
FROM fx_events e JOIN fx_user u ON e.user_id = u.user_id GROUP BY u.wilaya_id""", _EV, "fx_user"))
def stream_region_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.stream_region_volume(spark, sf_dir)


@reg("stream_daily_snapshot", W("""
SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end,
  COUNT(*) AS nb_transactions, CAST(SUM(amount) AS DOUBLE) AS volume
FROM fx_events GROUP BY 1, 2
HAVING date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM fx_events) - INTERVAL 10 MINUTE""", _EV))
def stream_daily_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _win_out(jobs.stream_daily_snapshot(spark, sf_dir))


@reg("stream_late_report", W("""
SELECT CAST(ts AS DATE) AS jour, COUNT(*) FILTER (WHERE seen) AS nb_stream, COUNT(*) AS nb_batch, COUNT(*) FILTER (WHERE NOT seen) AS nb_tardives
FROM (SELECT ts, transaction_id % 50 <> 0 OR date_trunc('day', ts) + INTERVAL 1 DAY
        > (SELECT MAX(ts) - INTERVAL 10 MINUTE FROM fx_events WHERE transaction_id % 50 <> 0) AS seen FROM fx_events)
GROUP BY ALL""", _EV))
def stream_late_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.stream_late_report(spark, sf_dir)


def queries() -> dict:
    return dict(Q)


def oracle_sql() -> dict:
    return dict(SQL)
