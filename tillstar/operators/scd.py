"""Slowly changing dimensions: type 1 upsert, type 2 apply, current and as-of views.

No MERGE on Parquet: every apply produces a new snapshot of the dimension
(written to a new path by the caller, then switched), never an in-place update.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN_END = "9999-12-31"


def version_key(natural_key: Column, effective_from: Column) -> Column:
    """Surrogate key of a version: natural id x 100000 + day number of its start.

    Deterministic and unique (``scd2_apply`` keeps one version per id and day), no
    global sort or sequence needed."""
    return natural_key.cast("bigint") * F.lit(100000) + F.unix_date(effective_from).cast("bigint")


def scd1_upsert(current: DataFrame, snapshot: DataFrame, keys: list[str]) -> DataFrame:
    """Type 1: the snapshot's row wins for every key it has; other rows are kept."""
    return snapshot.unionByName(current.join(snapshot.select(*keys), keys, "left_anti"))


def scd2_initial(dim: DataFrame, key: str, sk: str, as_of: str) -> DataFrame:
    """Type 2 first load: every row opens a version at ``as_of``."""
    d = F.lit(as_of).cast("date")
    return (dim.withColumn("effective_from", d)
            .withColumn("effective_to", F.lit(None).cast("date"))
            .withColumn("is_current", F.lit(True))
            .withColumn(sk, version_key(F.col(key), d)))


def _same(cols: list[str]) -> Column:
    """Null-safe equality of tracked columns between current (c_) and snapshot (s_)."""
    return reduce(lambda a, b: a & b, [F.col(f"c_{c}").eqNullSafe(F.col(f"s_{c}")) for c in cols])


def scd2_apply(history: DataFrame, snapshot: DataFrame, key: str, sk: str, tracked: list[str],
               as_of: str) -> DataFrame:
    """Type 2 apply of a full snapshot at ``as_of``.

    Changed rows: the current version is closed (effective_to = as_of) and a new
    one opened. New keys: a version is opened. Unchanged keys and keys absent
    from the snapshot: the current version stays. Closed history is untouched.
    A second change on the day a version began replaces that version in place; an
    ``as_of`` before the start of a current version fails the job.
    """
    d = F.lit(as_of).cast("date")
    attrs = [c for c in snapshot.columns if c != key]
    hist_cols = history.columns
    closed_before = history.filter(~F.col("is_current"))
    current = history.filter(F.col("is_current"))

    cur = current.select(F.col(key).alias("_k"), *[F.col(c).alias(f"c_{c}") for c in hist_cols if c != key])
    snap = snapshot.select(F.col(key).alias("_k2"), *[F.col(c).alias(f"s_{c}") for c in attrs])
    j = cur.join(snap, cur["_k"] == snap["_k2"], "full_outer").withColumn("_key", F.coalesce("_k", "_k2"))

    in_cur, in_snap = F.col("_k").isNotNull(), F.col("_k2").isNotNull()
    late = F.when(in_cur & (F.col("c_effective_from") > d),
                  F.raise_error(F.lit(f"as_of {as_of} lies before a current version"))).otherwise(F.lit(True))
    changed = late.cast("boolean") & in_cur & in_snap & ~_same(tracked)
    same_day = changed & (F.col("c_effective_from") == d)

    def from_current(closing: bool) -> list[Column]:
        out = []
        for c in hist_cols:
            if c == key:
                out.append(F.col("_key").alias(key))
            elif closing and c == "effective_to":
                out.append(d.alias(c))
            elif closing and c == "is_current":
                out.append(F.lit(False).alias(c))
            else:
                out.append(F.col(f"c_{c}").alias(c))
        return out

    def opened() -> list[Column]:
        out = []
        for c in hist_cols:
            if c == key:
                out.append(F.col("_key").alias(key))
            elif c == sk:
                out.append(version_key(F.col("_key"), d).alias(c))
            elif c == "effective_from":
                out.append(d.alias(c))
            elif c == "effective_to":
                out.append(F.lit(None).cast("date").alias(c))
            elif c == "is_current":
                out.append(F.lit(True).alias(c))
            else:
                out.append(F.col(f"s_{c}").alias(c))
        return out

    # One pass over the join: each key emits its kept, closed and/or opened version.
    versions = F.array(
        F.when(in_cur & ~changed, F.struct(*from_current(False))),
        F.when(changed & ~same_day, F.struct(*from_current(True))),
        F.when((in_snap & ~in_cur) | changed, F.struct(*opened())),
    )
    applied = (j.select(F.explode(F.filter(versions, lambda v: v.isNotNull())).alias("_v"))
               .select(*[F.col(f"_v.{c}").alias(c) for c in hist_cols]))
    return reduce(DataFrame.unionByName, [closed_before.select(*hist_cols), applied])


def asof_join(fact: DataFrame, history: DataFrame, fact_key: str, hist_key: str, fact_date: str,
              how: str = "inner") -> DataFrame:
    """Point-in-time join: the version valid on the fact's date
    (``effective_from <= d < coalesce(effective_to, open end)``).

    Planned as an equi join on the natural key plus a range condition: one
    shuffle per side, each key's few versions meet its facts; a hot key's fact
    rows are split by AQE skew handling, its versions replicated.
    """
    h = history
    cond = ((fact[fact_key] == h[hist_key])
            & (h["effective_from"] <= fact[fact_date])
            & (fact[fact_date] < F.coalesce(h["effective_to"], F.lit(OPEN_END).cast("date"))))
    return fact.join(h, cond, how)
