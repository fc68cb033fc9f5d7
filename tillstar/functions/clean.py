"""Column expressions for cleaning late-typed text.

All are built-in expressions (whole-stage codegen, no Python per row).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: str | Column) -> Column:
    """``NULLIF(TRIM(x), '')``: trimmed text, NULL when nothing is left."""
    t = F.trim(_c(c))
    return F.when(t != F.lit(""), t)


def clean_text_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> DataFrame:
    """Apply :func:`blank_to_null` to every string column in one projection."""
    cols = {f.name: blank_to_null(f.name) for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in exclude}
    return df.withColumns(cols)


def guarded_cast(c: str | Column, to: str | T.DataType) -> Column:
    """Blank text becomes NULL, anything else is cast (ANSI: bad text raises)."""
    return blank_to_null(c).cast(to)


def lenient_cast(c: str | Column, to: str | T.DataType) -> Column:
    """Blank or unparsable text becomes NULL (used to split bad rows off)."""
    return F.try_cast(blank_to_null(c), to) if hasattr(F, "try_cast") else blank_to_null(c).try_cast(to)


def money(c: str | Column) -> Column:
    return guarded_cast(c, T.DecimalType(18, 2))


def fee_or_zero(c: str | Column) -> Column:
    """Fee default: blank or NULL text is a zero fee."""
    return F.coalesce(money(c), F.lit(0).cast(T.DecimalType(18, 2)))


def hour_of_time_text(c: str | Column) -> Column:
    """Hour of a ``HH:MM[:SS]`` text (no TIME type needed)."""
    return F.split_part(blank_to_null(c), F.lit(":"), F.lit(1)).cast("int")


def date_key(d: str | Column) -> Column:
    """DATE -> INT ``yyyyMMdd``."""
    d = _c(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def iso_day_of_week(d: str | Column) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return (F.weekday(_c(d)) + 1).cast("short")


