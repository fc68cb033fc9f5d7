"""Registry entries: sketches, policy views, co-located tables, null rates observed while writing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.operators import colocated, observed, sketches
from tillstar.operators.policy_views import create_policy_views
from tillstar.plans import fixtures as fx
from tillstar.plans.oracle_fixtures import with_fixtures as W
from tillstar.session import fresh_path

Q: dict = {}
SQL: dict[str, str] = {}


def reg(key: str, sql: str):
    def deco(fn):
        Q[key], SQL[key] = fn, sql
        return fn
    return deco


# =================================================================== sketches
_FIRST, _LAST = "1995-03-10", "1996-08-20"


@reg("approx_active_users", W(f"""
SELECT transaction_type, COUNT(DISTINCT user_key) AS nb_utilisateurs, TRUE AS estimation_dans_la_borne FROM fx_fact
WHERE transaction_date BETWEEN DATE '{_FIRST}' AND DATE '{_LAST}' GROUP BY transaction_type""", "fx_fact"))
def approx_active_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3/A4 (opt-in): distinct users per transaction type over a range of days from stored daily sketches, next to the exact
    count, and whether the estimate keeps its error bound."""
    fact = fx.fixture_star(spark, sf_dir, lookups=("user",)).fact
    path = sketches.write_daily(fact, ["transaction_type"], "transaction_date", fresh_path(spark, "sketches"), distinct="user_key")
    guess = sketches.distinct_over(sketches.read_range(spark, path, _FIRST, _LAST), ["transaction_type"], "estimation")
    exact = (fact.filter(F.col("transaction_date").between(F.lit(_FIRST).cast("date"), F.lit(_LAST).cast("date")))
             .groupBy("transaction_type").agg(F.countDistinct("user_key").alias("nb_utilisateurs")))
    return exact.join(guess, "transaction_type").select(
        "transaction_type", "nb_utilisateurs", sketches.within(F.col("estimation"), F.col("nb_utilisateurs")).alias("estimation_dans_la_borne"))


@reg("approx_basket", W("""
SELECT transaction_type, COUNT(*) AS nb_transactions, TRUE AS rang_dans_la_borne FROM fx_fact GROUP BY transaction_type""", "fx_fact"))
def approx_basket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8 (opt-in): the median amount per transaction type from merged daily quantile sketches: whether its true rank is near
    one half. The exact median (``q14_basket``) stays the default."""
    fact = fx.fixture_star(spark, sf_dir, lookups=()).fact
    path = sketches.write_daily(fact, ["transaction_type"], "transaction_date", fresh_path(spark, "sketches"), quantile="amount")
    guess = sketches.quantile_over(spark.read.parquet(path), ["transaction_type"])
    amount = F.col("amount").cast("double")
    ranked = fact.join(F.broadcast(guess), "transaction_type").groupBy("transaction_type").agg(  # one row a type
        F.count(F.lit(1)).alias("nb_transactions"), F.sum(F.when(amount < F.col("quantile"), 1).otherwise(0)).alias("below"),
        F.sum(F.when(amount <= F.col("quantile"), 1).otherwise(0)).alias("up_to"))
    n = F.col("nb_transactions")
    near = (F.col("below") / n <= 0.5 + sketches.RANK_ERROR) & (F.col("up_to") / n >= 0.5 - sketches.RANK_ERROR)
    return ranked.select("transaction_type", "nb_transactions", near.alias("rang_dans_la_borne"))


# =================================================================== policy views
_REGION = 7


@reg("policy_view_fact", W(f"""
SELECT f.tx_pk, f.user_key, CAST(f.amount AS DOUBLE) AS amount, f.transaction_date FROM fx_fact f JOIN fx_user u ON f.user_key = u.user_key
WHERE u.is_current AND u.wilaya_id = {_REGION}""", "fx_fact", "fx_user"))
def policy_view_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transactions a session user sees through the policy view; the login comes from ``current_user()``."""
    fact, _ = _views(spark, sf_dir)
    return spark.sql(f"SELECT tx_pk, user_key, CAST(amount AS DOUBLE) AS amount, transaction_date FROM {fact}")


@reg("policy_view_users", W(f"""
SELECT user_id, wilaya_id, '***-****-' || right(phone, 4) AS phone, '**********' AS nni, '****@' || split_part(email, '@', 2) AS email
FROM fx_user WHERE wilaya_id = {_REGION}""", "fx_user"))
def policy_view_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user dimension as the session user sees it: own region, masked columns."""
    _, users = _views(spark, sf_dir)
    return spark.sql(f"SELECT user_id, wilaya_id, phone, nni, email FROM {users}")


def _views(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """The session user is the branch manager of one region."""
    star = fx.fixture_star(spark, sf_dir, lookups=("user",))
    me = spark.range(1).select(F.current_user().alias("login"), F.lit(_REGION).cast("long").alias("wilaya_id"), F.lit("chef_agence").alias("role"))
    profiles = fx.profiles(spark, sf_dir).select("login", F.col("wilaya_id").cast("long").alias("wilaya_id"), "role").unionByName(me)
    return create_policy_views(spark, star.fact, star.user, profiles)


# =================================================================== co-located tables
@reg("colocated_region_volume", W("""
SELECT u.wilaya_id, u.wilaya_name, COUNT(*) AS nb_transactions, CAST(ROUND(SUM(f.amount), 0) AS DOUBLE) AS volume_mru
FROM fx_fact f JOIN fx_user u ON f.user_key = u.user_key WHERE u.is_current GROUP BY ALL""", "fx_fact", "fx_user"))
def colocated_region_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Volume per region from fact and user tables bucketed by user: the join itself shuffles nothing."""
    star = fx.fixture_star(spark, sf_dir, lookups=("user",))
    fact = colocated.write_bucketed(star.fact.select("user_key", "amount", "transaction_date"), "fact_by_user", "user_key")
    users = colocated.write_bucketed(star.user.select("user_key", "wilaya_id", "wilaya_name", "is_current"), "users_by_key", "user_key")
    return colocated.region_volume(fact, users)


# =================================================================== observed writes
_NULLS = ["amount", "fee", "failure_reason", "tx_hour", "risk_score", "balance_after", "idempotency_key"]
_NULLS_SQL = "\nUNION ALL ".join(
    f"""SELECT 'fact_transactions' AS table_name, '{c}' AS column_name, COUNT(*) - COUNT({c}) AS nb_null, COUNT(*) AS nb_total,
  CAST(ROUND((COUNT(*) - COUNT({c})) * 100.0 / COUNT(*), 2) AS DOUBLE) AS null_pct FROM fx_fact""" for c in _NULLS)


@reg("observed_null_rates", W(_NULLS_SQL, "fx_fact"))
def observed_null_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ9/S8: null rates of the fact, counted by the write of the fact itself."""
    fact = fx.fixture_star(spark, sf_dir, lookups=()).fact.select(*_NULLS)
    path = fresh_path(spark, "observed-fact")
    return observed.null_report(spark, "fact_transactions", observed.observed_write(fact, lambda df: df.write.parquet(path), nulls=True))


def queries() -> dict:
    return dict(Q)


def oracle_sql() -> dict:
    return dict(SQL)
