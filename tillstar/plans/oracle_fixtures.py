"""Fixture views as SQL text (DuckDB and Spark SQL), used by the oracle queries.

``with_fixtures(body)`` prefixes a query with the CTEs it needs.
"""

from __future__ import annotations

FX = {}

# The replication nodes.
FX["fx_node"] = """SELECT * FROM (VALUES (1,'NDB-NODE-1','DC-NDB'),(2,'NDB-NODE-2','DC-NDB'),
  (3,'NKC-NODE-1','DC-NKC-PRIMARY'),(4,'NKC-NODE-2','DC-NKC-PRIMARY'),(5,'NKC-NODE-3','DC-NKC-SECONDARY'))
  AS t(node_key, node_id, datacenter)"""

FX["fx_user"] = """SELECT c_custkey AS user_key, c_custkey AS user_id, c_name AS full_name,
  n_nationkey AS wilaya_id, n_name AS wilaya_name, c_mktsegment AS profile_type,
  CASE WHEN c_custkey % 20 = 0 THEN 'PENDING_KYC' WHEN c_custkey % 20 = 1 THEN 'INACTIVE' ELSE 'ACTIVE' END AS status,
  'P' || CAST(10000000 + c_custkey AS VARCHAR(20)) AS phone,
  'N' || CAST(20000000 + c_custkey AS VARCHAR(20)) AS nni,
  CASE WHEN c_custkey % 100 < 59 THEN CAST(NULL AS VARCHAR(200)) ELSE 'u' || CAST(c_custkey AS VARCHAR(20)) || '@example.org' END AS email,
  CAST(NULL AS VARCHAR(20)) AS kyc_level,
  1995 + CAST(c_custkey % 7 AS INT) AS reg_year, 1 + CAST(c_custkey % 12 AS INT) AS reg_month,
  make_date(1995 + CAST(c_custkey % 7 AS INT), 1 + CAST(c_custkey % 12 AS INT), 1) AS registration_date,
  TRUE AS is_current
FROM customer JOIN nation ON c_nationkey = n_nationkey"""

# Free text with the account number of each user.
FX["fx_account"] = r"""SELECT user_id, CASE WHEN user_id % 3 = 0 THEN 'Virement vers ' || x || '.'
  WHEN user_id % 5 = 0 THEN trim(regexp_replace(x, '(.{4})', '\1 ', 'g')) ELSE x END AS compte
FROM (SELECT user_id, 'MR' || lpad(CAST(98 - CAST(bban || '222700' AS HUGEINT) % 97 + CASE WHEN user_id % 13 = 0 THEN 1 ELSE 0 END AS VARCHAR), 2, '0')
        || CASE WHEN user_id % 17 = 0 THEN left(bban, 22) ELSE bban END AS x
      FROM (SELECT user_id, '0002000101' || lpad(CAST(10000000 + user_id AS VARCHAR), 11, '0') || lpad(CAST(user_id % 97 AS VARCHAR), 2, '0') AS bban
            FROM fx_user))"""

FX["fx_merchant"] = """SELECT p_partkey AS merchant_key, p_partkey AS merchant_id, p_name AS name, CASE WHEN p_partkey % 40 <> 0 THEN p_type END AS category_label,
  CASE WHEN p_size % 8 = 0 THEN 'INACTIVE' ELSE 'ACTIVE' END AS status
FROM part
UNION ALL SELECT -1, -1, 'Sans marchand', CAST(NULL AS VARCHAR(20)), 'N/A'"""

FX["fx_agency"] = """SELECT s_suppkey AS agency_key, s_suppkey AS agency_id, s_name AS name, n_name AS wilaya_name,
  CASE WHEN s_suppkey % 3 = 0 THEN 'GOLD' WHEN s_suppkey % 3 = 1 THEN 'SILVER' ELSE 'BRONZE' END AS tier
FROM supplier JOIN nation ON s_nationkey = n_nationkey
UNION ALL SELECT -1, -1, 'Sans agence', CAST(NULL AS VARCHAR(20)), CAST(NULL AS VARCHAR(20))"""

FX["fx_tx_raw"] = """SELECT l_orderkey * 8 + l_linenumber AS tx_id, o_custkey AS user_key,
  CASE WHEN l_orderkey % 50 = 7 THEN 'REV' ELSE CASE l_linenumber WHEN 1 THEN 'TRF' WHEN 2 THEN 'DEP' WHEN 3 THEN 'WIT'
    WHEN 4 THEN 'PAY' WHEN 5 THEN 'BIL' WHEN 6 THEN 'AIR' ELSE 'SAL' END END AS transaction_type,
  CASE WHEN l_linenumber = 4 THEN l_partkey ELSE -1 END AS merchant_key,
  CASE WHEN l_linenumber IN (2, 3) THEN l_suppkey ELSE -1 END AS agency_key,
  1 + CAST(l_suppkey % 5 AS INT) AS node_key,
  CASE WHEN l_partkey % 50 = 0 THEN 'DC-NDB' WHEN l_suppkey % 5 < 2 THEN 'DC-NDB' WHEN l_suppkey % 5 < 4 THEN 'DC-NKC-PRIMARY' ELSE 'DC-NKC-SECONDARY' END AS datacenter,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
  CASE WHEN (l_orderkey * 8 + l_linenumber) % 29 <> 0 THEN CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,2)) END AS fee,
  CASE WHEN l_returnflag = 'R' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
  CASE WHEN l_returnflag <> 'R' THEN CAST(NULL AS VARCHAR(40)) WHEN l_suppkey % 20 < 16 THEN 'INSUFFICIENT_BALANCE'
    WHEN l_suppkey % 20 = 16 THEN 'INSUF_BAL' WHEN l_suppkey % 20 = 17 THEN 'LIMIT_DAY' WHEN l_suppkey % 20 = 18 THEN 'WRONG_PIN' ELSE '  ' END AS failure_reason,
  CASE l_orderkey % 64 WHEN 0 THEN 'CONFLICT' WHEN 1 THEN 'LAGGING' WHEN 2 THEN 'PENDING' ELSE 'SYNCED' END AS sync_status,
  CASE WHEN l_orderkey % 64 = 0 AND l_partkey % 75 = 0 THEN CAST(l_extendedprice + 10 AS DECIMAL(18,2)) END AS amount_node_a,
  CASE WHEN l_orderkey % 64 = 0 AND l_partkey % 75 = 0 THEN CAST(l_extendedprice - 10 AS DECIMAL(18,2)) END AS amount_node_b,
  CAST(o_orderdate AS DATE) AS transaction_date, l_shipdate AS updated_at, l_partkey, l_suppkey, l_quantity
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

FX["fx_tx"] = """SELECT * FROM (SELECT *, sync_status = 'CONFLICT' AS is_conflict,
  row_number() OVER (PARTITION BY tx_id ORDER BY updated_at DESC, l_partkey, l_suppkey, amount, l_quantity, status) AS rn
  FROM fx_tx_raw) t WHERE rn = 1"""

# The fact as the load builds it: conflict amount from node a, fee default 0,
# blank failure reason -> NULL, sync flags, cross-datacenter flag, yyyyMMdd date key.
FX["fx_fact"] = """SELECT t.tx_id AS tx_pk, t.tx_id AS transaction_id,
  CAST(year(t.transaction_date) * 10000 + month(t.transaction_date) * 100 + day(t.transaction_date) AS INT) AS date_key,
  t.user_key, t.merchant_key, t.agency_key, n.node_key,
  CASE WHEN t.sync_status = 'CONFLICT' AND t.amount_node_a IS NOT NULL THEN t.amount_node_a ELSE t.amount END AS amount,
  COALESCE(t.fee, CAST(0 AS DECIMAL(18,2))) AS fee,
  t.transaction_type, t.status,
  CASE WHEN TRIM(t.failure_reason) = '' THEN NULL ELSE TRIM(t.failure_reason) END AS failure_reason,
  t.sync_status, t.sync_status = 'CONFLICT' AS is_conflict, t.sync_status = 'LAGGING' AS is_lagging,
  t.sync_status = 'PENDING' AS is_pending_sync,
  ((t.datacenter = 'DC-NDB' AND n.node_id LIKE 'NKC%') OR (t.datacenter LIKE 'DC-NKC%' AND n.node_id LIKE 'NDB%')) AS is_cross_dc,
  CASE WHEN t.tx_id % 11 <> 0 THEN CAST(t.tx_id % 24 AS INT) END AS tx_hour,
  CAST(t.transaction_date AS TIMESTAMP) + INTERVAL 8 HOUR AS created_at,
  CAST(t.transaction_date AS TIMESTAMP) + INTERVAL 12 HOUR + CASE WHEN t.tx_id % 37 = 0 THEN INTERVAL (-1) DAY ELSE INTERVAL 1 DAY END AS last_synced_at,
  CASE WHEN t.tx_id % 3 <> 0 THEN 'K' || CAST(t.tx_id // 2 AS VARCHAR) END AS idempotency_key,
  CASE WHEN t.tx_id % 4 = 0 THEN CAST((t.tx_id % 1000) / 10.0 AS DECIMAL(5,2)) END AS risk_score,
  CASE WHEN t.tx_id % 5 = 0 THEN t.amount END AS balance_after, t.amount + COALESCE(t.fee, 0) AS total_amount,
  t.transaction_date, t.updated_at, t.amount_node_a, t.amount_node_b, t.amount AS base_amount, t.datacenter
FROM fx_tx t JOIN fx_node n ON t.node_key = n.node_key"""

# Calendar for the fact range (one row per day).
FX["fx_date"] = """SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INT) AS date_key, d AS full_date,
  CAST(year(d) AS INT) AS year, CAST(quarter(d) AS INT) AS quarter, CAST(month(d) AS INT) AS month,
  monthname(d) AS month_name,
  CAST(day(d) AS INT) AS day_of_month
FROM (SELECT CAST(unnest(generate_series((SELECT make_date(year(MIN(o_orderdate)), 1, 1) FROM orders), (SELECT make_date(year(MAX(o_orderdate)), 12, 31) FROM orders), INTERVAL 1 DAY)) AS DATE) AS d) s"""

# The live stream bound to events.
FX["fx_events"] = """SELECT event_id AS transaction_id, CAST(ts AS TIMESTAMP) AS ts, user_id, event_type,
  CAST(value AS DECIMAL(18,2)) AS amount,
  CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
  CASE event_id % 64 WHEN 0 THEN 'CONFLICT' WHEN 1 THEN 'LAGGING' WHEN 2 THEN 'PENDING' ELSE 'SYNCED' END AS sync_status,
  CAST(hour(ts) AS INT) AS tx_hour
FROM events"""

ORDER = ["fx_node", "fx_user", "fx_account", "fx_merchant", "fx_agency", "fx_tx_raw", "fx_tx", "fx_fact", "fx_date",
         "fx_events"]

DEPS = {
    "fx_account": ["fx_user"],
    "fx_tx": ["fx_tx_raw"],
    "fx_fact": ["fx_tx", "fx_node"],
}


def _closure(names: list[str]) -> list[str]:
    need: set[str] = set()
    stack = list(names)
    while stack:
        n = stack.pop()
        if n in need:
            continue
        need.add(n)
        stack.extend(DEPS.get(n, []))
    return [n for n in ORDER if n in need]


def with_fixtures(body: str, *names: str, extra: list[tuple[str, str]] | None = None) -> str:
    """``WITH <fixture CTEs>, <extra CTEs> <body>``."""
    ctes = [f"{n} AS ({FX[n]})" for n in _closure(list(names))]
    ctes += [f"{n} AS ({sql})" for n, sql in (extra or [])]
    return ("WITH " + ",\n".join(ctes) + "\n" + body) if ctes else body
