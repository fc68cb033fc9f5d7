"""Registry entries: ledger replicas compared by digests, and marts kept by signed changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillstar.operators import delta, replica_diff
from tillstar.plans import fixtures as fx
from tillstar.plans.oracle_fixtures import with_fixtures as W
from tillstar.plans.oracle_marts import SQL as MART_SQL
from tillstar.session import fresh_path

Q: dict = {}
SQL: dict[str, str] = {}


def reg(key: str, sql: str):
    def deco(fn):
        Q[key], SQL[key] = fn, sql
        return fn
    return deco


# =================================================================== ledger replicas
_A = """SELECT n.node_id, t.transaction_date AS jour, t.tx_id AS transaction_id, t.amount AS montant, t.status AS statut
FROM fx_tx t JOIN fx_node n ON t.node_key = n.node_key"""
_B = """SELECT node_id, CASE WHEN transaction_id % 4013 = 0 THEN CAST(jour + INTERVAL 1 DAY AS DATE) ELSE jour END AS jour, transaction_id,
  CASE WHEN transaction_id % 4003 = 0 THEN montant + 1300.88 ELSE montant END AS montant,
  CASE WHEN transaction_id % 4007 = 0 THEN 'REVERSED' ELSE statut END AS statut
FROM ledger_a, range(0, 2) r(k) WHERE transaction_id % 4001 <> 0 AND (k = 0 OR transaction_id % 4019 = 0)"""
_REPLICAS = [("ledger_a", _A), ("ledger_b", _B)]

_PER_ID = """SELECT node_id, jour, transaction_id, COUNT(*) AS n, SUM(montant) AS total, list_sort(list(montant || ' ' || statut)) AS content
FROM {} GROUP BY ALL"""

_ROWS_SQL = W("""
SELECT COALESCE(a.node_id, b.node_id) AS node_id, COALESCE(a.jour, b.jour) AS jour, COALESCE(a.transaction_id, b.transaction_id) AS transaction_id,
  CASE WHEN a.n IS NULL THEN 'absent_a' WHEN b.n IS NULL THEN 'absent_b' WHEN a.total <> b.total THEN 'montant' WHEN a.n <> b.n THEN 'lignes'
       ELSE 'contenu' END AS ecart_type,
  COALESCE(a.n, 0) AS lignes_a, COALESCE(b.n, 0) AS lignes_b, CAST(a.total AS DOUBLE) AS montant_a, CAST(b.total AS DOUBLE) AS montant_b,
  CAST(COALESCE(a.total, 0) - COALESCE(b.total, 0) AS DOUBLE) AS ecart
FROM id_a a FULL OUTER JOIN id_b b ON a.node_id = b.node_id AND a.jour = b.jour AND a.transaction_id = b.transaction_id
WHERE a.content IS DISTINCT FROM b.content""", "fx_tx", "fx_node",
              extra=[*_REPLICAS, ("id_a", _PER_ID.format("ledger_a")), ("id_b", _PER_ID.format("ledger_b"))])


def _level_sql(name: str, keys: tuple[str, ...]) -> str:
    on = " AND ".join(f"a.{k} = b.{k}" for k in keys)
    side = f"""(SELECT {', '.join(keys)}, COUNT(*) AS n, SUM(montant) AS total,
      list_sort(list(transaction_id || ' ' || jour || ' ' || montant || ' ' || statut)) AS content
      FROM (SELECT *, CAST(transaction_id % 64 AS INT) AS seau FROM ledger_{{}}) GROUP BY {', '.join(keys)})"""
    return f"""SELECT '{name}' AS niveau, COUNT(*) AS nb_differents, CAST(COALESCE(SUM(a.n), 0) AS BIGINT) AS lignes_a,
  CAST(COALESCE(SUM(b.n), 0) AS BIGINT) AS lignes_b, CAST(COALESCE(SUM(COALESCE(a.total, 0) - COALESCE(b.total, 0)), 0) AS DOUBLE) AS ecart
FROM {side.format('a')} a FULL OUTER JOIN {side.format('b')} b ON {on} WHERE a.content IS DISTINCT FROM b.content"""


_LEVELS_SQL = W("\nUNION ALL ".join(_level_sql(n, k) for n, k in zip(("noeud", "jour", "seau"), replica_diff.LEVELS)), "fx_tx", "fx_node", extra=_REPLICAS)


def _written_replicas(spark: SparkSession, sf_dir: str) -> list[str]:
    return [replica_diff.write_replica(ledger, fresh_path(spark, name))
            for ledger, name in zip(fx.ledger_replicas(spark, sf_dir), ("ledger-a", "ledger-b"))]


@reg("ledger_gap_rows", _ROWS_SQL)
def ledger_gap_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ7/J15: the transactions behind the gap between two replicas of the ledger, found through digests of nodes, days and buckets."""
    return replica_diff.differing_rows(spark, *_written_replicas(spark, sf_dir))


@reg("ledger_gap_levels", _LEVELS_SQL)
def ledger_gap_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ7/J15: how many nodes, days and buckets differ, and the gap of their sums; no row of either replica is read."""
    a, b = (replica_diff.read_digests(spark, root) for root in _written_replicas(spark, sf_dir))
    return replica_diff.level_report(replica_diff.descend(a, b))


# =================================================================== marts kept by signed changes
def _maintained(spark: SparkSession, sf_dir: str, mart: delta.AdditiveMart, lookups: tuple[str, ...]) -> DataFrame:
    """A stored mart of an outdated fact, brought up to date by two batches of changes (the second one delivered twice)."""
    star, stale, batches = fx.changed_fact(spark, sf_dir, lookups)
    root = delta.build(mart, star.with_fact(stale), fresh_path(spark, "gold-sums"))
    for number, changes in enumerate([*batches, batches[-1]]):
        delta.apply_batch(mart, star, root, changes, batch=min(number, len(batches) - 1))
    return delta.read_mart(mart, star, spark, root)


@reg("delta_daily_kpis", MART_SQL["mv_daily_kpis"])
def delta_daily_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S11/ST10: daily KPIs after inserts, changes and deletes, from stored sums and signed deltas; equal to a full rebuild."""
    return _maintained(spark, sf_dir, delta.DAILY_KPIS, ())


@reg("delta_wilaya_volume", MART_SQL["mv_wilaya_volume"])
def delta_wilaya_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S11/ST10: the region view kept the same way; only changed rows meet the user dimension."""
    return _maintained(spark, sf_dir, delta.REGION_VOLUME, ("user",))


def queries() -> dict:
    return dict(Q)


def oracle_sql() -> dict:
    return dict(SQL)
