"""Partitioned Parquet storage: CDC landing by date/hour, the fact layout, and
the hot/archive split.

Layout rules: partition directories on a date; rows range-partitioned on
(date, unique id) before the write, so each task holds a contiguous slice of
days (few directories, few files per task) while a hot day or month is still
split over many tasks by the id; rows sorted inside each task by the columns
most queries filter on so Parquet row-group min/max statistics skip data.
Never ``repartition(month)``: that would send a whole month to one task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

STORE = "store"
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


def write_landing(df: DataFrame, path: str, ts_col: str = "ts", id_col: str = "transaction_id") -> str:
    """CDC landing: Parquet (Snappy), partitioned by ``dt=yyyy-MM-dd/hh=HH``."""
    ts = F.col(ts_col)
    (df.withColumn("dt", F.to_date(ts)).withColumn("hh", F.hour(ts))
       .repartitionByRange(ts, F.col(id_col))
       .write.mode("errorifexists").partitionBy("dt", "hh").parquet(path))
    return path


def read_landing(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    r = spark.read
    if schema:
        r = r.schema(schema)
    return r.parquet(path)


def write_fact_layout(fact: DataFrame, path: str, partition_col: str = "tx_month", id_col: str = "tx_pk",
                      sort_cols: tuple[str, ...] = ("transaction_date", "status", "transaction_type"),
                      watch: Callable[[DataFrame], DataFrame] = lambda rows: rows,
                      derived: dict[str, Column] | None = None) -> str:
    """Fact table layout: month partitions, sorted by (date, status, type) inside. ``watch`` may add observation metrics to the rows
    that reach the writer. ``derived`` names columns that follow from others of their row: these are computed after the shuffle."""
    derived = {c: e for c, e in (derived or {}).items() if c in fact.columns}
    out = fact.withColumn(partition_col, (F.year("transaction_date") * 100 + F.month("transaction_date")).cast("int"))
    sent = out.select(*_fixed_first(out.drop(*derived), sort_cols))
    # The month first: rows that stand in the order of the folders are not sorted once more by the writer.
    placed = sent.repartitionByRange(F.col("transaction_date"), F.col(id_col)).sortWithinPartitions(partition_col, *sort_cols)
    whole = placed.select(*[derived[c].alias(c) if c in derived else c for c in out.columns])
    watch(whole).write.mode("errorifexists").partitionBy(partition_col).parquet(path)
    return path


def _fixed_first(df: DataFrame, sort_cols: tuple[str, ...]) -> list[str]:
    """Columns in an order that compresses well in a shuffle: fixed widths first, then texts, the sorted (short, never missing) ones
    before others: a text that varies in length moves the offsets of those behind it."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return [c for c in df.columns if c not in texts] + sorted(texts, key=lambda c: c not in sort_cols)


def archive_cutoff(fact: DataFrame, months: int = 6, date_col: str = "transaction_date") -> DataFrame:
    """One-row frame: the hot/cold boundary ``max(date) - months``."""
    return fact.agg(F.add_months(F.max(date_col), -months).alias("_cutoff"))


def split_hot_archive(fact: DataFrame, base_path: str, months: int = 6, date_col: str = "transaction_date") -> str:
    """Rows older than ``months`` before the latest date go to the archive store, all others (also
    those without a date) to the hot one: two partition folders of ``base_path``, one pass."""
    cut = archive_cutoff(fact, months, date_col).scalar()
    tagged = fact.withColumn(STORE, F.coalesce(F.when(F.col(date_col) < cut, F.lit("archive")), F.lit("hot")))
    conf = fact.sparkSession.conf
    before = conf.get(OPEN_FILES, None)
    conf.set(OPEN_FILES, "2")  # one file a store open in a task: the rows are not sorted by store first
    try:
        tagged.write.mode("errorifexists").partitionBy(STORE).parquet(base_path)
    finally:
        conf.unset(OPEN_FILES) if before is None else conf.set(OPEN_FILES, before)
    return base_path


def read_both(spark: SparkSession, base_path: str, schema: StructType) -> DataFrame:
    """Hot and archive stores as one frame with a ``store`` column; either may be empty. A filter on
    ``store`` reads only that folder."""
    return spark.read.schema(StructType([*schema.fields, StructField(STORE, StringType())])).parquet(base_path)


def month_filter(col: str, first: int, last: int) -> Column:
    return (F.col(col) >= first) & (F.col(col) <= last)
