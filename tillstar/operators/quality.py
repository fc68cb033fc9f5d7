"""Data quality and reconciliation checks (DQ1-DQ13).

Each check returns a DataFrame (the report); ``assert_*`` helpers raise when a
hard invariant fails. Counts are one-pass aggregates; reconciliations join
per-key aggregates (never raw rows) so their shuffles carry one row per key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.functions.share import pct_of, with_share
from tillstar.operators.star import Star, resolve_amount


def table_counts(tables: dict[str, DataFrame], expected: dict[str, int] | None = None) -> DataFrame:
    """DQ1: one row per table (table_name, nb[, expected, ok]) as a UNION ALL of counts."""
    parts = [df.agg(F.count(F.lit(1)).alias("nb")).select(F.lit(name).alias("table_name"), "nb")
             for name, df in tables.items()]
    out = reduce(DataFrame.unionByName, parts)
    if expected:
        exp = out.sparkSession.createDataFrame(list(expected.items()), "table_name string, expected long")
        out = out.join(F.broadcast(exp), "table_name", "left").withColumn("ok", F.col("nb") == F.col("expected"))
    return out


def distribution(df: DataFrame, col: str, count_name: str = "nb", pct_name: str | None = "pct",
                 scale: int = 2) -> DataFrame:
    """DQ2/DQ3: value counts of a column, optional share of total."""
    g = df.groupBy(col).agg(F.count(F.lit(1)).alias(count_name))
    return with_share(g, count_name, pct_name, scale) if pct_name else g


def volume_totals(fact: DataFrame) -> DataFrame:
    """DQ3: total volume and fees over every fact row."""
    return fact.agg(F.round(F.sum("amount"), 0).cast("double").alias("volume_total_mru"),
                    F.round(F.sum("fee"), 0).cast("double").alias("frais_total_mru"))


def orphans(star: Star) -> DataFrame:
    """DQ4: per foreign key, rows on the unknown member (-1) and rows whose key has no dimension row
    at all (-1 excluded: that member exists only for some dimensions).

    The fact is read once: every row is unpivoted to its five (foreign key, key) pairs and counted per pair, so each task sends
    the distinct keys it met (not the combinations, which are nearly as many as rows); one left join with the
    dimension keys then yields both counts in one aggregate.
    """
    specs = [("user_key", star.user), ("merchant_key", star.merchant), ("agency_key", star.agency),
             ("node_key", star.node), ("date_key", star.date)]
    keys = star.fact.select(*[F.col(k).cast("bigint").alias(k) for k, _ in specs])
    per_key = keys.unpivot([], [k for k, _ in specs], "foreign_key", "key").groupBy("foreign_key", "key").agg(F.count(F.lit(1)).alias("_n"))
    dim_keys = reduce(DataFrame.unionByName, [
        d.select(F.lit(k).alias("foreign_key"), F.col(k).cast("bigint").alias("key")) for k, d in specs]).distinct()
    known = per_key.join(dim_keys.withColumn("_known", F.lit(True)), ["foreign_key", "key"], "left")

    def rows(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("_n")).otherwise(0)).cast("bigint")

    return known.groupBy("foreign_key").agg(rows(F.col("key") == -1).alias("nb_unknown_member"),
                                            rows(F.col("_known").isNull() & (F.col("key") != -1)).alias("nb_orphans"))


def conflict_strategy_totals(stg_fact_base: DataFrame) -> DataFrame:
    """DQ5: row count and volume of the fact under each conflict strategy, one pass.

    Input: rows with text ``amount``, ``amount_node_a``, ``amount_node_b`` and
    ``sync_status`` (the staging columns the strategies read).
    """
    conflict = F.col("sync_status") == "CONFLICT"
    aggs = []
    for s in ("node_a", "node_b", "base"):
        aggs += [F.count(F.lit(1)).alias(f"n_{s}"), F.sum(resolve_amount(s)).alias(f"v_{s}")]
    aggs += [F.sum(F.when(~conflict, 1).otherwise(0)).cast("bigint").alias("n_exclude"),
             F.sum(F.when(~conflict, resolve_amount("exclude"))).alias("v_exclude")]
    one = stg_fact_base.agg(*aggs)
    rows = [F.struct(F.lit(s).alias("strategy"), F.col(f"n_{s}").cast("bigint").alias("nb_transactions"),
                     F.round(F.col(f"v_{s}"), 0).cast("double").alias("volume_mru"))
            for s in ("exclude", "node_a", "node_b", "base")]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def conflict_fill_rate(fact: DataFrame) -> DataFrame:
    """DQ6: conflicts, how many carry node amounts, fill ratio."""
    c = fact.filter(F.col("sync_status") == "CONFLICT")
    return c.agg(
        F.count(F.lit(1)).alias("nb_conflicts"),
        F.count("amount_node_a").alias("nb_with_node_a"),
        F.count("amount_node_b").alias("nb_with_node_b"),
        F.sum(F.when(F.col("amount_node_a").isNull() & F.col("amount_node_b").isNull(), 1).otherwise(0))
         .cast("bigint").alias("nb_without_node_amounts"),
    ).withColumn("fill_pct", pct_of(F.col("nb_with_node_a"), F.col("nb_conflicts"), 2))


def node_reconciliation(ledger: DataFrame, fact: DataFrame, node: DataFrame, tolerance_pct: float = 0.5) -> DataFrame:
    """DQ7: node ledger totals vs fact totals per node (full outer join of per-node sums)."""
    f = fact.groupBy("node_key").agg(F.sum("amount").alias("fact_total"))
    f = f.join(F.broadcast(node.select("node_key", "node_id")), "node_key").drop("node_key")
    j = ledger.join(f, "node_id", "full_outer")
    gap = F.coalesce(F.col("ledger_total"), F.lit(0)) - F.coalesce(F.col("fact_total"), F.lit(0))
    return j.select(
        "node_id",
        F.col("ledger_total").cast("double").alias("ledger_total"),
        F.col("fact_total").cast("double").alias("fact_total"),
        gap.cast("double").alias("ecart"),
        F.round(gap * 100 / F.nullif(F.col("fact_total"), F.lit(0)), 4).cast("double").alias("ecart_pct"),
        (F.abs(gap * 100 / F.nullif(F.col("fact_total"), F.lit(0))) <= F.lit(tolerance_pct)).alias("within_tolerance"),
    )


def sync_before_create(fact: DataFrame, sync_col: str = "last_synced_at", create_col: str = "created_at") -> DataFrame:
    """DQ8: rows synchronized before they were created, per year of creation."""
    early = F.col(sync_col) < F.col(create_col)
    g = fact.groupBy(F.year(create_col).alias("annee")).agg(
        F.count(F.lit(1)).alias("nb_transactions"),
        F.sum(F.when(early, 1).otherwise(0)).cast("bigint").alias("nb_sync_avant_creation"))
    return g.withColumn("pct", pct_of(F.col("nb_sync_avant_creation"), F.col("nb_transactions"), 2))


def null_profile(df: DataFrame, table_name: str) -> DataFrame:
    """DQ9: NULL count and rate of every column, in one aggregate, unpivoted."""
    cols = df.columns
    agg = df.agg(F.count(F.lit(1)).alias("_total"),
                 *[F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).cast("bigint").alias(f"_n{i}")
                   for i, c in enumerate(cols)])
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"_n{i}").alias("nb_null")) for i, c in enumerate(cols)]
    return (agg.select("_total", F.explode(F.array(*rows)).alias("r"))
            .select(F.lit(table_name).alias("table_name"), "r.column_name", "r.nb_null",
                    F.col("_total").alias("nb_total"),
                    pct_of(F.col("r.nb_null"), F.col("_total"), 2).alias("null_pct")))


def fee_reconciliation(fee_ledger: DataFrame, fact: DataFrame) -> DataFrame:
    """DQ10: fee ledger (one row per fee) vs fact fees, per transaction, then summarized."""
    ledger = fee_ledger.groupBy("transaction_id").agg(F.sum("fee_amount").alias("ledger_fee"))
    facts = fact.filter(F.col("fee") > 0).select(F.col("transaction_id"), F.col("fee").alias("fact_fee"))
    j = ledger.join(facts, "transaction_id", "full_outer")
    status = (F.when(F.col("ledger_fee").isNull(), "absent_du_registre")
              .when(F.col("fact_fee").isNull(), "absent_du_fait")
              .when(F.col("ledger_fee") != F.col("fact_fee"), "montant_different")
              .otherwise("concordant"))
    return j.groupBy(status.alias("statut")).agg(
        F.count(F.lit(1)).alias("nb_transactions"),
        F.round(F.sum(F.coalesce("fact_fee", "ledger_fee")), 2).cast("double").alias("frais_mru"))


def daily_gap(left: DataFrame, right: DataFrame, left_name: str, right_name: str, day_col: str = "jour") -> DataFrame:
    """Join two per-day counts (full outer) and compute the relative gap."""
    j = left.join(right, day_col, "full_outer")
    l_, r_ = F.coalesce(F.col(left_name), F.lit(0)), F.coalesce(F.col(right_name), F.lit(0))
    return j.select(day_col, l_.alias(left_name), r_.alias(right_name),
                    F.round((l_ - r_).cast("double") * 100 / F.nullif(r_, F.lit(0)).cast("double"), 3)
                     .alias("ecart_pct"))


def live_badge(live_daily: DataFrame, nrt_daily: DataFrame, ratio: float = 1.02) -> DataFrame:
    """DQ11: warning badge when live > near-real-time x ratio."""
    d = daily_gap(live_daily, nrt_daily, "nb_live", "nb_nrt")
    return d.withColumn("badge", F.col("nb_live") > F.col("nb_nrt") * F.lit(ratio))


def nightly_reconciliation(live_snapshot: DataFrame, batch_daily: DataFrame, tolerance_pct: float = 0.5) -> DataFrame:
    """DQ12: live snapshot vs nightly batch per day; ALERT above the tolerance."""
    d = daily_gap(live_snapshot, batch_daily, "nb_live", "nb_batch")
    return d.withColumn("statut", F.when(F.abs(F.col("ecart_pct")) > F.lit(tolerance_pct), "ALERT").otherwise("OK"))


def assert_unique(df: DataFrame, keys: list[str], name: str) -> None:
    """Raise if a dimension key repeats (a repeated key would fan the fact out)."""
    dup = df.groupBy(*keys).count().filter("count > 1").limit(1).count()
    if dup:
        raise AssertionError(f"{name}: key {keys} is not unique")
