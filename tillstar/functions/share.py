"""Share of total over grouped rows: ``ROUND(n * 100.0 / SUM(n) OVER (), scale)``.

The total is taken over the already grouped rows. Groups of a code list (types, regions,
hours, categories, statuses: tens of rows) meet in one small window, so the input
is read and shuffled once. For groups without such a bound ``bounded=False`` takes the total as
a scalar subquery over the grouped frame, which never gathers the groups in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pct_of(num: Column, total: Column, scale: int) -> Column:
    """``ROUND(num * 100.0 / NULLIF(total, 0), scale)`` for counts, as DOUBLE.

    Exact decimal division (18 digits of scale) then one HALF_UP rounding, like
    NUMERIC arithmetic; no intermediate rounding that could move a .x5 boundary."""
    q = (num * F.lit(100)).cast("decimal(20,0)") / F.nullif(total, F.lit(0)).cast("decimal(20,0)")
    return F.round(q, scale).cast("double")


def with_share(grouped: DataFrame, count_col: str, out_col: str, scale: int = 1, bounded: bool = True) -> DataFrame:
    """Add ``out_col`` = share of ``count_col`` in its total over all rows of ``grouped``."""
    total = (F.sum(count_col).over(Window.partitionBy(F.lit(0))) if bounded
             else grouped.select(F.sum(count_col)).scalar())
    return grouped.withColumn(out_col, pct_of(F.col(count_col), total, scale))
