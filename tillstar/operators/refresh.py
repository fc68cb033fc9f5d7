"""Materialized marts as gold tables, and their incremental refresh.

A gold table is partitioned by month. A refresh reads the fact partitions of the touched months
only, replaces those months and drops the ones that come back empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.operators.star import Star
from tillstar.session import fresh_path, remove_path

PART = "ym"
FACT_MONTH = "tx_month"


def month_of_key(date_key_col: str = "date_key"):
    return (F.col(date_key_col) / 100).cast("int")


def _by_month(mart: DataFrame, date_col: str) -> DataFrame:
    return mart.withColumn(PART, (F.year(date_col) * 100 + F.month(date_col)).cast("int"))


def write_gold(mart: DataFrame, path: str, date_col: str = "full_date") -> None:
    # Gold rows are aggregates (one per day, or per day and region).
    (_by_month(mart, date_col).repartition(PART)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(path))


def touched_months(changed_rows: DataFrame, date_key_col: str = "date_key") -> DataFrame:
    """Distinct months (yyyyMM) of a set of new or changed fact rows."""
    return changed_rows.select(month_of_key(date_key_col).alias(PART)).distinct()


def fact_of_months(fact: DataFrame, months: list[int]) -> DataFrame:
    """The fact rows of some months: a partition filter when the fact has its month column."""
    month = F.col(FACT_MONTH) if FACT_MONTH in fact.columns else month_of_key()
    return fact.filter(month.isin(months))


def refresh_gold(star: Star, mart_fn: Callable[[Star], DataFrame], path: str, months: DataFrame,
                 date_col: str = "full_date") -> None:
    """Recompute ``mart_fn`` over the touched months and replace exactly those partitions.

    The list of months reaches the driver (calendar months, not rows). The new rows are computed
    once, into a fresh folder, before the gold table is touched.
    """
    spark = star.fact.sparkSession
    touched = sorted(r[PART] for r in months.collect() if r[PART] is not None)
    if not touched:
        return
    fresh = fresh_path(spark, "gold-refresh")
    mart = mart_fn(star.with_fact(fact_of_months(star.fact, touched)))
    write_gold(mart, fresh, date_col)
    new = spark.read.schema(_by_month(mart, date_col).schema).parquet(fresh)
    (new.filter(F.col(PART).isin(touched)).repartition(PART)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(path))
    filled = {r[PART] for r in new.select(PART).distinct().collect()}
    for month in touched:
        if month not in filled:
            remove_path(spark, f"{path}/{PART}={month}")


def read_gold(spark, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(PART)
