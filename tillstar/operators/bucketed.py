"""A dimension kept in key buckets: an apply reads and replaces only the buckets in which something changed.

Rows lie in one partition a bucket (hash of the key). Next to them stand the digests of the snapshot applied last, one row a bucket:
rows, and the exclusive or of two hashes over key and tracked columns. A new snapshot is digested in one aggregation; buckets
with equal digests hold the same tracked values as last time, so neither their history nor their snapshot rows are read again.

The new rows of a bucket are computed into a folder of their own before any bucket is replaced (dynamic partition overwrite). From then
until all are replaced the digests of these buckets are null, so an apply that breaks off is repeated, and repeating changes nothing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.operators import scd
from tillstar.session import fresh_path, remove_path

BUCKET = "seau"
BUCKETS = 64  # as many as give buckets of some hundred megabytes; fixed when the table is first written
DIGEST_SCHEMA = f"{BUCKET} int, n long, x1 long, x2 long, as_of date"


def bucket_of(key: str, n: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")


def _write_rows(rows: DataFrame, path: str, mode: str) -> None:
    (rows.repartition(BUCKET).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path))


def _write_digests(digests: DataFrame, root: str, as_of: str) -> None:
    """One row a bucket, so one file."""
    (digests.withColumn("as_of", F.lit(as_of).cast("date")).coalesce(1).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("as_of").parquet(f"{root}/digests"))


def snapshot_digests(snapshot: DataFrame, key: str, tracked: Sequence[str], n: int) -> DataFrame:
    """(bucket, n, x1, x2) for every one of the ``n`` buckets. Hashes pass over nulls, so whether a value is null is hashed too."""
    values = [v for c in tracked for v in (F.col(c), F.col(c).isNull())]
    hashes = [F.bit_xor(F.xxhash64(F.lit(seed), F.col(key), *values)).alias(name) for seed, name in ((1, "x1"), (2, "x2"))]
    found = snapshot.groupBy(bucket_of(key, n).alias(BUCKET)).agg(F.count(F.lit(1)).alias("n"), *hashes)
    every = snapshot.sparkSession.range(n).select(F.col("id").cast("int").alias(BUCKET))
    return every.join(found, BUCKET, "left").select(BUCKET, *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n", "x1", "x2")])


def write_table(rows: DataFrame, root: str, key: str, buckets: int = BUCKETS) -> None:
    """A new bucketed table of ``rows`` at ``root``; keys are not null. The schema is kept apart with the number of buckets, so an
    empty table can be read."""
    rows.limit(0).withColumn(BUCKET, F.lit(0).alias(BUCKET, metadata={"buckets": buckets})).write.parquet(f"{root}/schema")
    _write_rows(rows.withColumn(BUCKET, bucket_of(key, buckets)), f"{root}/rows", "errorifexists")


def write_history(history: DataFrame, snapshot: DataFrame, root: str, key: str, tracked: Sequence[str], as_of: str,
                  buckets: int = BUCKETS) -> None:
    """A new bucketed type 2 history that stands at ``snapshot``, the one applied at ``as_of``."""
    write_table(history, root, key, buckets)
    _write_digests(snapshot_digests(snapshot, key, tracked, buckets), root, as_of)


def _rows(spark: SparkSession, root: str) -> tuple[DataFrame, int]:
    """The rows with their bucket, and the number of buckets."""
    schema = spark.read.parquet(f"{root}/schema").schema
    return spark.read.schema(schema).parquet(f"{root}/rows"), schema[BUCKET].metadata["buckets"]


def read_table(spark: SparkSession, root: str) -> DataFrame:
    return _rows(spark, root)[0].drop(BUCKET)


def apply_snapshot(spark: SparkSession, root: str, snapshot: DataFrame, key: str, sk: str, tracked: Sequence[str], as_of: str) -> list[int]:
    """``scd.scd2_apply`` on the buckets whose digest differs from the last applied snapshot's; returns these buckets.

    Keys of a snapshot are unique and not null. An ``as_of`` before that of the last apply is an error. Only bucket numbers reach the driver.
    """
    stored = spark.read.schema(DIGEST_SCHEMA).parquet(f"{root}/digests")
    last = stored.agg(F.max("as_of")).first()[0]
    if last > dt.date.fromisoformat(as_of):
        raise ValueError(f"as_of {as_of} lies before the last apply, {last}")
    stored = stored.filter(F.col("as_of") == F.lit(last))
    rows, n = _rows(spark, root)
    fresh = fresh_path(spark, "bucket-digests")
    snapshot_digests(snapshot, key, tracked, n).write.parquet(fresh)
    new = spark.read.schema(DIGEST_SCHEMA).parquet(fresh).drop("as_of")
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"d.{c}")) for c in ("n", "x1", "x2")]
    differing = new.alias("d").join(stored.alias("s"), BUCKET).filter(~(same[0] & same[1] & same[2])).select(BUCKET)
    touched = sorted(r[0] for r in differing.collect())
    if touched:
        here = F.col(BUCKET).isin(touched)
        old = rows.filter(here).drop(BUCKET)
        wanted = snapshot.filter(bucket_of(key, n).isin(touched))
        applied = scd.scd2_apply(old, wanted, key, sk, list(tracked), as_of).withColumn(BUCKET, bucket_of(key, n))
        staged = fresh_path(spark, "bucket-rows")
        _write_rows(applied, staged, "errorifexists")
        _write_digests(new.select(BUCKET, *[F.when(~here, F.col(c)).alias(c) for c in ("n", "x1", "x2")]), root, as_of)
        _write_rows(spark.read.schema(applied.schema).parquet(staged), f"{root}/rows", "overwrite")
        _write_digests(new, root, as_of)
        remove_path(spark, staged)
    remove_path(spark, fresh)
    return touched


def insert_absent(spark: SparkSession, root: str, rows: DataFrame, key: str) -> None:
    """Append the rows whose key the table lacks: only the keys of the buckets that ``rows`` fall into are read, no file is replaced.

    Keys of ``rows`` are unique and not null; a repeated insert adds nothing."""
    table, n = _rows(spark, root)
    rows = rows.withColumn(BUCKET, bucket_of(key, n)).select(*table.columns)
    touched = sorted(r[0] for r in rows.select(BUCKET).distinct().collect())
    if touched:
        known = table.filter(F.col(BUCKET).isin(touched)).select(key)
        _write_rows(rows.join(known, key, "left_anti").select(*table.columns), f"{root}/rows", "append")
