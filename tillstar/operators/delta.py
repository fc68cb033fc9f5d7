"""Gold marts kept by signed changes instead of recomputed months.

A mart whose measures are sums and counts is stored as those sums per key (``base``), in month
partitions. A batch of changes brings old row versions (sign -1) and new ones (sign +1); its sums per key are
one more small table (``deltas/batch=...``). The mart is the sum of both, so no fact row is read again. A batch
that is replayed overwrites its own delta, so applying it twice changes nothing. ``fold``
adds the deltas up into a new base.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegerType, LongType, StructField, StructType

from tillstar.functions.share import pct_of
from tillstar.operators.marts import SUCCESS, r0
from tillstar.operators.star import Star

SIGN, MONTH, BATCH, ROWS = "_sign", "ym", "batch", "_rows"


@dataclass(frozen=True)
class AdditiveMart:
    """A mart as sums per key: which rows count, their keys (``date_key`` among them), the summed measures (SQL expressions), and
    the published columns from keys and sums. ``enrich`` joins what a key needs onto (changed) fact rows."""
    keys: tuple[str, ...]
    measures: dict[str, str]
    publish: Callable[[DataFrame, Star], DataFrame]
    enrich: Callable[[DataFrame, Star], DataFrame] = lambda rows, star: rows
    where: str = "true"

    def sums(self, rows: DataFrame, star: Star) -> DataFrame:
        """Signed sums per key of rows with a sign. ``_rows`` counts rows, so a key whose rows all went can be told from one whose amounts cancel."""
        kept = self.enrich(rows.filter(self.where), star)
        measured = kept.select(*self.keys, F.col(SIGN).alias(ROWS), *[(F.col(SIGN) * F.expr(m)).alias(n) for n, m in self.measures.items()])
        return self.added([measured])

    def added(self, parts: list[DataFrame]) -> DataFrame:
        columns = [ROWS, *self.measures]
        rows = reduce(DataFrame.unionByName, [p.select(*self.keys, *columns) for p in parts])
        return rows.groupBy(*self.keys).agg(*[F.sum(c).alias(c) for c in columns]).withColumn(MONTH, (F.col("date_key") / 100).cast("int"))


def signed(before: DataFrame | None, after: DataFrame | None) -> DataFrame:
    """Old row versions counted off, new ones counted in: insert (only after), delete (only before), change (both)."""
    parts = [rows.withColumn(SIGN, F.lit(sign).cast("long")) for rows, sign in ((before, -1), (after, 1)) if rows is not None]
    return reduce(DataFrame.unionByName, parts)


def build(mart: AdditiveMart, star: Star, root: str) -> str:
    """The first base, from the whole fact."""
    sums = mart.sums(signed(None, star.fact), star)
    sums.repartitionByRange(MONTH, *mart.keys).write.mode("errorifexists").partitionBy(MONTH).parquet(f"{root}/base")
    return root


def apply_batch(mart: AdditiveMart, star: Star, root: str, changes: DataFrame, batch: int) -> None:
    """Add a batch of signed rows. The same number overwrites what an earlier attempt wrote; numbers are used once."""
    sums = mart.sums(changes, star).withColumn(BATCH, F.lit(batch).cast("long"))
    (sums.repartitionByRange(MONTH, *mart.keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(BATCH, MONTH).parquet(f"{root}/deltas"))


def _parts(mart: AdditiveMart, star: Star, spark: SparkSession, root: str) -> list[DataFrame]:
    """Base and deltas (an empty table before the first batch)."""
    base = spark.read.parquet(f"{root}/base")
    types: dict[str, DataType] = {f.name: f.dataType for f in base.schema.fields}
    schema = StructType([*[StructField(c, types[c]) for c in (*mart.keys, ROWS, *mart.measures)], StructField(BATCH, LongType()), StructField(MONTH, IntegerType())])
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/deltas")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return [base]
    return [base, spark.read.schema(schema).parquet(f"{root}/deltas")]


def read_sums(mart: AdditiveMart, star: Star, spark: SparkSession, root: str, months: list[int] | None = None) -> DataFrame:
    """Base plus deltas per key, of some months only if given (a partition filter on both); emptied keys are gone."""
    parts = _parts(mart, star, spark, root)
    if months is not None:
        parts = [p.filter(F.col(MONTH).isin(months)) for p in parts]
    return mart.added(parts).filter(F.col(ROWS) != 0)


def read_mart(mart: AdditiveMart, star: Star, spark: SparkSession, root: str, months: list[int] | None = None) -> DataFrame:
    return mart.publish(read_sums(mart, star, spark, root, months), star)


def fold(mart: AdditiveMart, star: Star, spark: SparkSession, root: str, new_root: str) -> str:
    """A new base that holds the deltas so far; readers switch to it. Sums are read, never the fact."""
    sums = read_sums(mart, star, spark, root)
    sums.repartitionByRange(MONTH, *mart.keys).write.mode("errorifexists").partitionBy(MONTH).parquet(f"{new_root}/base")
    return new_root


# ------------------------------------------------------------------ the two materialized views
_NO_CONFLICT = "NOT is_conflict"


def _daily(sums: DataFrame, star: Star) -> DataFrame:
    days = F.broadcast(star.date.select("date_key", "full_date", "year", "month", "day_of_month"))
    return sums.join(days, "date_key").select(
        "full_date", *[F.col(c).cast("int").alias(c) for c in ("year", "month", "day_of_month")], F.col(ROWS).alias("nb_transactions"),
        r0(F.col("volume")).alias("volume_mru"), r0(F.col("frais")).alias("frais_mru"), F.col("succes").alias("nb_succes"),
        pct_of(F.col("succes"), F.col(ROWS), 1).alias("taux_succes_pct"))


def _with_region(rows: DataFrame, star: Star) -> DataFrame:
    """Only the rows at hand meet the user dimension; a null key matches no user and drops out, as in the mart."""
    return rows.join(star.user.filter("is_current").select("user_key", "wilaya_id", "wilaya_name"), "user_key")


def _by_region(sums: DataFrame, star: Star) -> DataFrame:
    days = F.broadcast(star.date.select("date_key", "full_date"))
    return sums.join(days, "date_key").select("wilaya_id", "wilaya_name", "full_date", F.col(ROWS).alias("nb_transactions"), r0(F.col("volume")).alias("volume_mru"))


DAILY_KPIS = AdditiveMart(
    keys=("date_key",), where=_NO_CONFLICT, publish=_daily,
    measures={"volume": "amount", "frais": "fee", "succes": f"CASE WHEN status = '{SUCCESS}' THEN 1 ELSE 0 END"})
REGION_VOLUME = AdditiveMart(
    keys=("wilaya_id", "wilaya_name", "date_key"), where=_NO_CONFLICT, publish=_by_region, enrich=_with_region, measures={"volume": "amount"})
