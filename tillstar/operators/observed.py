"""Load counts and null rates taken by the write itself, so that no table is read again to be counted.

The metrics are Spark's observation metrics: aggregates computed on the rows as they pass to the writer. They stand
directly below the write, above every shuffle, as a range partitioning runs what is below it twice (once for its sample).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillstar.functions.share import pct_of

ROWS = "_rows"
REPORT_SCHEMA = "table_name string, nb long"
PROFILE_SCHEMA = "table_name string, column_name string, nb_null long, nb_total long"


def observed_write(df: DataFrame, write: Callable[[DataFrame], object], nulls: bool = False, **metrics: Column) -> dict[str, int]:
    """Run ``write(df)`` and return the rows it wrote (``_rows``), the nulls of every column (``nulls``; under the column's name) and
    further aggregates by name. An empty table has zero of each."""
    seen = Observation()
    columns = [F.count(F.lit(1)).alias(ROWS)]
    if nulls:
        columns += [F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).alias(f"null_{i}") for i, c in enumerate(df.columns)]
    columns += [c.alias(name) for name, c in metrics.items()]
    write(df.observe(seen, *columns))
    got = seen.get
    out = {ROWS: got[ROWS], **{name: got[name] or 0 for name in metrics}}
    if nulls:
        out |= {c: got[f"null_{i}"] or 0 for i, c in enumerate(df.columns)}
    return out


def null_report(spark: SparkSession, table: str, counts: dict[str, int]) -> DataFrame:
    """The null profile of a written table from what its write observed: one row per column, nothing is read."""
    rows = [(table, c, n, counts[ROWS]) for c, n in counts.items() if c != ROWS]
    return spark.createDataFrame(rows, PROFILE_SCHEMA).withColumn("null_pct", pct_of(F.col("nb_null"), F.col("nb_total"), 2))
