"""Point-in-time join by merging: facts and versions in one sorted stream.

Facts and versions are put under one another; a window over (key, date range), ordered by date with
versions before facts of the same day, carries the last version forward. There is no range condition, so no
pair of a fact and a version that does not hold for it is ever made. Every key is cut into date ranges
(``slice_months``), and the version in force at the start of a range is repeated there; a key
that holds a third of all facts is spread over as many tasks as there are ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE_MONTHS = 12


def _slice(date: Column, months: int) -> Column:
    """Number of the date range that holds a date."""
    return F.floor((F.year(date) * 12 + F.month(date) - 1) / months).cast("int")


def merge_asof(fact: DataFrame, history: DataFrame, fact_key: str, hist_key: str, fact_date: str, carry: list[str],
               how: str = "inner", slice_months: int = SLICE_MONTHS, until: Column | None = None) -> DataFrame:
    """``fact`` with the columns ``carry`` of the version valid on its date (``effective_from <= date <
    coalesce(effective_to, open)``; versions of a key do not overlap).

    ``how``: "inner" drops facts without a valid version, "left" keeps them with nulls. Facts with a null key or date have
    none. ``until``: a date that no fact lies after, where the caller knows one (else the facts are read once more for it). Columns of ``carry`` must not be named like columns of the fact. One shuffle of both inputs, no join.
    """
    clash = set(carry) & set(fact.columns)
    if clash:
        raise ValueError(f"columns of both sides: {sorted(clash)}")
    date = F.col(fact_date).cast("date")
    facts = fact.select(
        F.col(fact_key).alias("_key"), date.alias("_at"), _slice(date, slice_months).alias("_slice"), F.lit(1).alias("_kind"),
        F.struct(*fact.columns).alias("_fact"))
    # A version stands at the start of its life and again at the start of each later range it reaches; ranges without facts cost a
    # row each, so open versions end with the latest fact.
    last = facts.agg(F.max("_slice")).scalar() if until is None else _slice(until, slice_months)
    first = _slice(F.col("effective_from"), slice_months)
    final = F.least(_slice(F.coalesce("effective_to", F.lit("9999-12-31").cast("date")), slice_months), last)
    versions = history.filter(F.col(hist_key).isNotNull() & F.col("effective_from").isNotNull()).withColumn(
        "_slice", F.explode(F.when(final >= first, F.sequence(first, final)).otherwise(F.array().cast("array<int>"))))
    begin = F.when(F.col("_slice") > first, F.make_date(F.floor(F.col("_slice") * slice_months / 12).cast("int"),
                                                        (F.col("_slice") * slice_months % 12 + 1).cast("int"), F.lit(1)))
    versions = versions.select(
        F.col(hist_key).alias("_key"), F.coalesce(begin, F.col("effective_from")).alias("_at"), "_slice", F.lit(0).alias("_kind"),
        F.struct(F.col("effective_to").alias("_to"), *carry).alias("_version"))
    stream = facts.unionByName(versions, allowMissingColumns=True)
    order = Window.partitionBy("_key", "_slice").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    merged = stream.withColumn("_last", F.last("_version", ignorenulls=True).over(order)).filter("_kind = 1")
    valid = F.col("_last").isNotNull() & F.col("_key").isNotNull() & (F.col("_last._to").isNull() | (F.col("_at") < F.col("_last._to")))
    merged = merged.filter(valid) if how == "inner" else merged
    return merged.select("_fact.*", *[F.when(valid, F.col(f"_last.{c}")).alias(c) for c in carry])
