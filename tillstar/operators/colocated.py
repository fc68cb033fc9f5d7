"""Fact and user tables bucketed by user, so that their join needs no exchange.

Both are written once as bucketed, sorted tables of the session catalog; every later join of the two reads matching buckets side
by side. A user who holds a large share of all transactions fills one bucket: joins that only need sums first add up per user within the bucket (no
exchange either), so one row a user meets the dimension; row-level joins of a very hot user are better left to the shuffled join, which AQE splits.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.operators.marts import r0
from tillstar.session import fresh_path

BUCKETS = 64


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int = BUCKETS) -> DataFrame:
    """``df`` as a bucketed table (a new one under the shared folder, with a unique name); every task writes whole buckets."""
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex[:12]}"
    (df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", fresh_path(spark, table))
     .format("parquet").saveAsTable(table))
    return spark.table(table)


def region_volume(fact: DataFrame, users: DataFrame) -> DataFrame:
    """Count and volume per region of the current users: summed per user, joined, summed per region."""
    per_user = fact.groupBy("user_key").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("volume"))
    current = users.filter("is_current").select("user_key", "wilaya_id", "wilaya_name")
    return (per_user.join(current.hint("merge"), "user_key").groupBy("wilaya_id", "wilaya_name")
            .agg(F.sum("n").alias("nb_transactions"), r0(F.sum("volume")).alias("volume_mru")))


def drop_bucketed(spark: SparkSession, df_table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {df_table}")
