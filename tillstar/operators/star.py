"""Star schema builders: five dimensions and the transaction fact.

Join strategy. ``dim_node`` (one row per replication node) and ``dim_date``
(one row per calendar day of a given range) have a size bound that does not
grow with the data, so they are broadcast explicitly. User, merchant and agency
dimensions grow with the business; no hint is given for them: AQE turns the
shuffle join into a broadcast join at run time when the materialized side is
below ``spark.sql.adaptive.autoBroadcastJoinThreshold`` and keeps the sort-merge
join (with skew splitting) otherwise. A load that writes the fact looks the distinct
natural ids up first (``settle_lookups``), so that whole rows need not be shuffled for it.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar.functions.clean import (blank_to_null, date_key, fee_or_zero, guarded_cast,
                                      hour_of_time_text, iso_day_of_week, money)

UNKNOWN_KEY = -1


@dataclass(frozen=True)
class Star:
    fact: DataFrame
    user: DataFrame
    merchant: DataFrame
    agency: DataFrame
    node: DataFrame
    date: DataFrame

    def with_fact(self, fact: DataFrame) -> "Star":
        return replace(self, fact=fact)


# ---------------------------------------------------------------- dim_date
def build_dim_date(spark: SparkSession, start: str | _dt.date, end: str | _dt.date) -> DataFrame:
    """One row per day in [start, end]; calendar attributes, ISO week and weekday."""
    bounds = spark.range(1).select(F.lit(str(start)).cast("date").alias("_start"),
                                   F.lit(str(end)).cast("date").alias("_end"))
    return build_calendar(bounds)


def calendar_bounds_of(df: DataFrame, date_col: str) -> DataFrame:
    """One-row frame: first day of the first year to last day of the last year of ``date_col``."""
    b = df.agg(F.min(F.col(date_col).cast("date")).alias("_lo"), F.max(F.col(date_col).cast("date")).alias("_hi"))
    return b.select(F.trunc("_lo", "year").alias("_start"),
                    F.make_date(F.year("_hi"), F.lit(12), F.lit(31)).alias("_end"))


def build_calendar(bounds: DataFrame) -> DataFrame:
    """Calendar rows for a one-row (_start, _end) frame. Size: days in the range."""
    days = bounds.select(F.explode(F.sequence("_start", "_end", F.expr("INTERVAL 1 DAY"))).alias("full_date"))
    d = F.col("full_date")
    dow = iso_day_of_week(d)
    return days.select(
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.year(d).cast("short").alias("year"),
        F.quarter(d).cast("short").alias("quarter"),
        F.month(d).cast("short").alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).cast("short").alias("week_of_year"),
        F.dayofmonth(d).cast("short").alias("day_of_month"),
        dow.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        dow.isin(6, 7).alias("is_weekend"),
    )


def insert_if_absent(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``INSERT ... ON CONFLICT (keys) DO NOTHING`` as a snapshot: existing rows plus
    the new rows whose key is not present yet."""
    return existing.unionByName(new.join(existing.select(*keys), keys, "left_anti"))


# ---------------------------------------------------------------- dim_node
# The five replication nodes and their datacenters.
NODES = [
    (1, "NDB-NODE-1", "DC-NDB", "eu-west-3c"),
    (2, "NDB-NODE-2", "DC-NDB", "eu-west-3c"),
    (3, "NKC-NODE-1", "DC-NKC-PRIMARY", "eu-west-3a"),
    (4, "NKC-NODE-2", "DC-NKC-PRIMARY", "eu-west-3a"),
    (5, "NKC-NODE-3", "DC-NKC-SECONDARY", "eu-west-3b"),
]


def build_dim_node(spark: SparkSession) -> DataFrame:
    schema = "node_key int, node_id string, datacenter string, aws_az string"
    return (spark.createDataFrame(NODES, schema)
            .withColumn("aws_region", F.lit("eu-west-3")))


# ---------------------------------------------------------------- dim_user
def build_dim_user(stg_users: DataFrame, as_of: str | _dt.date) -> DataFrame:
    """Cleaned users, first SCD-2 load: valid from ``as_of``, open-ended, current.

    The surrogate key is the natural id (no global sort); see ``scd.version_key``
    for keys of later versions.
    """
    u = stg_users
    return u.select(
        F.col("id").alias("user_key"),
        F.col("id").alias("user_id"),
        blank_to_null("nni").alias("nni"),
        blank_to_null("full_name").alias("full_name"),
        blank_to_null("gender").alias("gender"),
        blank_to_null("phone").alias("phone"),
        blank_to_null("email").alias("email"),
        F.col("wilaya_id"),
        blank_to_null("wilaya_name").alias("wilaya_name"),
        F.col("moughataa_id"),
        blank_to_null("moughataa_name").alias("moughataa_name"),
        blank_to_null("profile_type").alias("profile_type"),
        blank_to_null("kyc_level").alias("kyc_level"),
        blank_to_null("status").alias("status"),
        blank_to_null("device_type").alias("device_type"),
        guarded_cast("registration_date", "date").alias("registration_date"),
        F.lit(str(as_of)).cast("date").alias("effective_from"),
        F.lit(None).cast("date").alias("effective_to"),
        F.lit(True).alias("is_current"),
    )


def unknown_user_row(like: DataFrame) -> DataFrame:
    """Unknown member (key -1) for facts whose user is not in the dimension."""
    return _unknown_like(like, user_key=UNKNOWN_KEY, user_id=UNKNOWN_KEY, full_name="Utilisateur inconnu", is_current=True)


# ------------------------------------------------------------ dim_merchant
def build_dim_merchant(stg_merchants: DataFrame) -> DataFrame:
    m = stg_merchants
    dims = m.select(
        F.col("id").alias("merchant_key"),
        F.col("id").alias("merchant_id"),
        blank_to_null("code").alias("code"),
        blank_to_null("name").alias("name"),
        blank_to_null("category_code").alias("category_code"),
        blank_to_null("category_label").alias("category_label"),
        blank_to_null("mcc").alias("mcc"),
        F.col("wilaya_id"),
        blank_to_null("wilaya_name").alias("wilaya_name"),
        F.col("moughataa_id"),
        blank_to_null("moughataa_name").alias("moughataa_name"),
        guarded_cast("commission_rate", T.DecimalType(5, 4)).alias("commission_rate"),
        blank_to_null("status").alias("status"),
        guarded_cast("registration_date", "date").alias("registration_date"),
    )
    return dims.unionByName(_unknown_like(dims, merchant_key=UNKNOWN_KEY, merchant_id=UNKNOWN_KEY,
                                          name="Sans marchand", status="N/A"))


# -------------------------------------------------------------- dim_agency
def build_dim_agency(stg_agencies: DataFrame) -> DataFrame:
    a = stg_agencies
    dims = a.select(
        F.col("id").alias("agency_key"),
        F.col("id").alias("agency_id"),
        blank_to_null("code").alias("code"),
        blank_to_null("name").alias("name"),
        F.col("wilaya_id"),
        blank_to_null("wilaya_name").alias("wilaya_name"),
        F.col("moughataa_id"),
        blank_to_null("moughataa_name").alias("moughataa_name"),
        blank_to_null("tier").alias("tier"),
        blank_to_null("status").alias("status"),
        blank_to_null("opening_hours").alias("opening_hours"),
    )
    return dims.unionByName(_unknown_like(dims, agency_key=UNKNOWN_KEY, agency_id=UNKNOWN_KEY,
                                          name="Sans agence", status="N/A"))


def _unknown_like(df: DataFrame, **values) -> DataFrame:
    """A one-row frame with df's schema: given values, NULL elsewhere (no driver data)."""
    cols = []
    for f in df.schema.fields:
        v = values.get(f.name)
        cols.append(F.lit(v).cast(f.dataType).alias(f.name))
    return df.sparkSession.range(1).select(*cols)


# ------------------------------------------------------------------- fact
CONFLICT_STRATEGIES = ("node_a", "node_b", "base", "exclude")


def resolve_amount(strategy: str = "node_a"):
    """Amount of a row given the replication conflict strategy.

    ``node_a``: node-a amount when the row is in CONFLICT and node a has one, else
    the base amount (the load's rule). ``node_b``: same with node b. ``base``:
    always the base amount. ``exclude``: base amount, rows are dropped by the
    caller (``is_conflict = FALSE``).
    """
    conflict = F.col("sync_status") == F.lit("CONFLICT")
    base = money("amount")
    if strategy == "node_a":
        alt = money("amount_node_a")
        return F.when(conflict & alt.isNotNull(), alt).otherwise(base)
    if strategy == "node_b":
        alt = money("amount_node_b")
        return F.when(conflict & alt.isNotNull(), alt).otherwise(base)
    if strategy in ("base", "exclude"):
        return base
    raise ValueError(f"unknown conflict strategy {strategy!r}")


def cross_dc_flag(datacenter: str = "datacenter", node_id: str = "node_id"):
    """Datacenter family of the row differs from the prefix of its node."""
    dc, node = F.col(datacenter), F.col(node_id)
    return (((dc == F.lit("DC-NDB")) & node.startswith("NKC"))
            | (dc.startswith("DC-NKC") & node.startswith("NDB")))


NULL_KEY_SPREAD = 1 << 20


def lookup_key(natural: str, row_id: str = "id"):
    """Join key for a dimension lookup: the natural id, or - when the row has none -
    a negative key that no dimension row carries, spread by the row id.

    Most transactions have no merchant or agency; with a plain NULL key a shuffle
    join would send all of them to the one task that owns NULL's hash. Spread
    keys land on every task, find no match and become the -1 member like NULL.
    """
    spread = F.lit(-2).cast("bigint") - F.pmod(F.xxhash64(F.col(row_id)), F.lit(NULL_KEY_SPREAD))
    return F.coalesce(F.col(natural).cast("bigint"), spread)


LOOKUPS = ("user", "merchant", "agency")


def _dimensions(user: DataFrame, merchant: DataFrame, agency: DataFrame) -> dict[str, tuple[DataFrame, str, str]]:
    """Lookup name -> (dimension, its natural id, the staging column that holds it)."""
    return {"user": (user.filter(F.col("is_current")), "user_id", "source_user_id"),
            "merchant": (merchant, "merchant_id", "merchant_id"), "agency": (agency, "agency_id", "agency_id")}


def _with_node(stg_tx: DataFrame, node: DataFrame) -> DataFrame:
    nodes = F.broadcast(node.select(F.col("node_id").alias("_nid"), "node_key"))
    return stg_tx.join(nodes, stg_tx["node_id"] == nodes["_nid"], "inner")


def settle_lookups(stg_tx: DataFrame, user: DataFrame, merchant: DataFrame, agency: DataFrame, node: DataFrame,
                   path: str, lookups: tuple[str, ...] = LOOKUPS) -> DataFrame:
    """Look the natural ids of the staging rows up, each distinct id once, and write to ``path`` (a new one) those that do not simply
    become the surrogate key: (lookup, id, key), where the key is NULL for an id without a member, and an id with several members has a
    row for each.

    ``build_fact(settled=...)`` joins its rows with these instead of the dimensions. The dimensions are keyed by their natural ids, so
    these are the unknown ids: mostly few, and as the written table has a known size, Spark broadcasts them below its threshold. With
    other surrogate keys, or very many unknown ids, the rows are shuffled as they are without it.
    """
    dims = _dimensions(user, merchant, agency)
    of = {name: F.col(dims[name][2]).cast("bigint").alias(name) for name in lookups}
    ids = (_with_node(stg_tx, node).select(*of.values()).unpivot([], list(of), "lookup", "id")
           .filter(F.col("id").isNotNull()).distinct())
    members = None
    for name in lookups:
        dim, natural, _ = dims[name]
        part = dim.select(F.lit(name).alias("lookup"), F.col(natural).cast("bigint").alias("id"), F.col(f"{name}_key").alias("key"))
        members = part if members is None else members.unionByName(part)
    found = (ids.join(members, ["lookup", "id"], "left")
             .withColumn("_members", F.count(F.lit(1)).over(Window.partitionBy("lookup", "id"))))
    apart = found.filter(F.col("key").isNull() | (F.col("key") != F.col("id")) | (F.col("_members") > 1))
    apart.select("lookup", "id", "key").write.mode("errorifexists").parquet(path)
    return stg_tx.sparkSession.read.schema("lookup string, id bigint, key bigint").parquet(path)


def build_fact(stg_tx: DataFrame, user: DataFrame, merchant: DataFrame, agency: DataFrame,
               node: DataFrame, strategy: str = "node_a", lookups: tuple[str, ...] = LOOKUPS,
               settled: DataFrame | None = None) -> DataFrame:
    """One fact row per staging row whose node is known (inner join on node).

    ``lookups`` names the dimensions whose keys the caller needs; the others are not joined, and
    their key columns are left out. ``settled`` is what ``settle_lookups`` found over the same tables.

    Unknown user / merchant / agency map to the -1 member. Dimension natural ids
    are non-negative, so the spread keys of ``lookup_key`` never match.
    """
    dims = _dimensions(user, merchant, agency)
    j = _with_node(stg_tx, node)
    # Texts become typed columns before the lookups, whose shuffles so carry no more than the columns that are asked for.
    j = j.select(
        F.col("id").alias("tx_pk"),
        F.col("reference"),
        F.col("idempotency_key"),
        *[F.col(dims[name][2]).cast("bigint").alias(f"_of_{name}") for name in lookups],
        F.col("node_key"),
        resolve_amount(strategy).alias("amount"),
        fee_or_zero("fee").alias("fee"),
        money("total_amount").alias("total_amount"),
        money("balance_before").alias("balance_before"),
        money("balance_after").alias("balance_after"),
        guarded_cast("risk_score", T.DecimalType(5, 2)).alias("risk_score"),
        F.col("transaction_type"),
        F.col("status"),
        blank_to_null("failure_reason").alias("failure_reason"),
        blank_to_null("channel").alias("channel"),
        blank_to_null("device_type").alias("device_type"),
        F.col("sync_status"),
        cross_dc_flag("datacenter", "_nid").alias("is_cross_dc"),
        F.col("transaction_date").cast("date").alias("transaction_date"),
        blank_to_null("transaction_time").alias("transaction_time"),
        guarded_cast("created_at", "timestamp").alias("created_at"),
        guarded_cast("updated_at", "timestamp").alias("updated_at"),
        guarded_cast("completed_at", "timestamp").alias("completed_at"),
        guarded_cast("last_synced_at", "timestamp").alias("last_synced_at"),
    )
    for name in lookups:
        dim, natural, _ = dims[name]
        if settled is None:
            keys = dim.select(F.col(natural).alias(f"_{name}"), F.col(f"{name}_key"))
        else:
            keys = settled.filter(F.col("lookup") == name).select(F.col("id").alias(f"_{name}"), F.col("key").alias(f"{name}_key"))
        j = j.join(keys, lookup_key(f"_of_{name}", "tx_pk") == keys[f"_{name}"], "left")
        if settled is not None:
            j = j.withColumn(f"{name}_key", F.when(F.col(f"_{name}").isNull(), F.col(f"_of_{name}")).otherwise(F.col(f"{name}_key")))

    derived = derived_columns()
    fact = j.select(
        "tx_pk",
        derived["transaction_id"].alias("transaction_id"),
        "reference",
        "idempotency_key",
        derived["date_key"].alias("date_key"),
        *[F.coalesce(f"{name}_key", F.lit(UNKNOWN_KEY).cast("bigint")).alias(f"{name}_key") for name in LOOKUPS if name in lookups],
        "node_key", "amount", "fee", "total_amount", "balance_before", "balance_after", "risk_score",
        "transaction_type", "status", "failure_reason", "channel", "device_type", "sync_status",
        *[derived[c].alias(c) for c in ("is_conflict", "is_lagging", "is_pending_sync")],
        "is_cross_dc", "transaction_date", "transaction_time",
        derived["tx_hour"].alias("tx_hour"),
        "created_at", "updated_at", "completed_at", "last_synced_at",
    )
    if strategy == "exclude":
        fact = fact.filter(~F.col("is_conflict"))
    return fact


def derived_columns() -> dict[str, Column]:
    """The fact columns that follow from others of its row: a shuffle of whole fact rows may leave them out."""
    sync = F.col("sync_status")
    return {"transaction_id": F.col("tx_pk"), "date_key": date_key("transaction_date"), "is_conflict": sync == "CONFLICT",
            "is_lagging": sync == "LAGGING", "is_pending_sync": sync == "PENDING", "tx_hour": hour_of_time_text("transaction_time")}
