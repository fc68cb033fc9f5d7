"""Keep the latest version per key (nightly dedup) and find duplicate keys.

``latest_per_key`` is a grouped ``min`` over a struct whose leading fields
encode the requested order, so it is an aggregate with a map-side partial
step: every task first reduces its rows to one candidate per key before the
shuffle. A key that holds a large share of all rows therefore ships one row
per map task, unlike ``row_number()`` over a window, which sends every row of
the key to one task and sorts them there. The trade: a ``min`` of a struct sorts
(it has no hash aggregation), so ids with few versions each are sorted twice, on
both sides of one shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _sortable(df: DataFrame, name: str, desc: bool) -> list[Column]:
    """Struct fields that order ``name`` with NULLs last, ascending or descending; the last one holds the value (``_restored``)."""
    c = F.col(name)
    dt = df.schema[name].dataType
    keys = [c.isNull()] if df.schema[name].nullable else []
    if not desc:
        keys.append(c)
        return keys
    if isinstance(dt, T.TimestampNTZType):
        keys.append(_epoch() - c)
    elif isinstance(dt, T.TimestampType):
        keys.append(-F.unix_micros(c))
    elif isinstance(dt, T.DateType):
        keys.append(-F.unix_date(c))
    elif isinstance(dt, (T.NumericType,)):
        keys.append(-c)
    elif isinstance(dt, T.BooleanType):
        keys.append(~c)
    else:
        raise TypeError(f"descending order on {dt.simpleString()} column {name!r} is not supported")
    return keys


def _restored(df: DataFrame, name: str, desc: bool, key: str) -> Column:
    """The value of ``name`` from its order field."""
    c = F.col(key)
    dt = df.schema[name].dataType
    if not desc:
        return c
    if isinstance(dt, T.TimestampNTZType):
        return _epoch() - c
    if isinstance(dt, T.TimestampType):
        return F.timestamp_micros(-c)
    if isinstance(dt, T.DateType):
        return F.date_from_unix_date(-c)
    return ~c if isinstance(dt, T.BooleanType) else -c


def _epoch() -> Column:
    return F.lit("1970-01-01").cast("timestamp_ntz")


def latest_per_key(df: DataFrame, keys: list[str], order: list[tuple[str, bool]]) -> DataFrame:
    """One row per ``keys``: the first row by ``order`` = [(column, descending), ...].

    Remaining ties are broken by the whole row, so the result is deterministic. An order column is sent once: it is
    taken from the order fields.
    """
    ord_fields, carried = [], {}
    for i, (name, desc) in enumerate(order):
        for j, e in enumerate(_sortable(df, name, desc)):
            ord_fields.append(e.alias(f"_o{i}_{j}"))
        carried.setdefault(name, _restored(df, name, desc, f"_best._o{i}_{j}"))
    payload = [c for c in df.columns if c not in keys and c not in carried]
    row = [F.struct(*payload).alias("_row")] if payload else []
    best = F.min(F.struct(*ord_fields, *row)).alias("_best")
    found = {c: carried.get(c, F.col(f"_best._row.{c}")).alias(c) for c in df.columns if c not in keys}
    return df.groupBy(*keys).agg(best).select(*[found.get(c, c) for c in df.columns])


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("nb_versions"))
            .filter(F.col("nb_versions") > 1))
