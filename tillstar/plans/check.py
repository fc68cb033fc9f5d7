"""Run registered queries against their oracle SQL on DuckDB and compare.

Usage: python -m tillstar.plans.check [sf_dir] [key ...]
Order-insensitive: rows are compared as sorted tuples with columns sorted by name;
floats are compared after rounding to 6 significant decimals.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int,)):
        return float(v)
    if isinstance(v, (float, decimal.Decimal)):
        f = float(v)
        return None if math.isnan(f) else round(f, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def duck(sf_dir: str):
    import duckdb
    from tillstar.sources.tables import TABLES, table_path
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


def compare(spark, sf_dir: str, keys=None, verbose=True):
    from tillstar.plans.registry import oracle_sql, queries
    qs, sqls = queries(), oracle_sql()
    con = duck(sf_dir)
    results = {}
    for k in keys or sorted(qs):
        t0 = time.time()
        try:
            df = qs[k](spark, sf_dir)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
        except Exception as e:  # noqa: BLE001
            results[k] = ("spark-error", str(e).splitlines()[0][:300])
            if verbose:
                print(f"{k:40s} SPARK ERROR {results[k][1]}", flush=True)
            continue
        ts = time.time() - t0
        if k not in sqls:
            results[k] = ("no-oracle", len(srows))
            if verbose:
                print(f"{k:40s} rows={len(srows):7d} (no oracle) {ts:.1f}s", flush=True)
            continue
        try:
            res = con.sql(sqls[k])
            dcols = res.columns
            drows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            results[k] = ("oracle-error", str(e).splitlines()[0][:300])
            if verbose:
                print(f"{k:40s} ORACLE ERROR {results[k][1]}", flush=True)
            continue
        ok_cols = sorted(scols) == sorted(dcols)
        a, b = _rows(scols, srows), _rows(dcols, drows)
        ok = ok_cols and a == b
        results[k] = ("ok" if ok else "mismatch", len(srows), len(drows))
        if verbose:
            msg = "OK" if ok else "MISMATCH"
            print(f"{k:40s} rows={len(srows):7d}/{len(drows):7d} {msg} {ts:.1f}s", flush=True)
            if not ok_cols:
                print("   spark cols:", sorted(scols), "\n   duck cols: ", sorted(dcols))
            elif not ok:
                diff_a = [x for x in a if x not in set(b)][:3]
                diff_b = [x for x in b if x not in set(a)][:3]
                print("   cols:", sorted(scols))
                print("   spark only:", diff_a)
                print("   duck only: ", diff_b)
    return results


if __name__ == "__main__":
    from tillstar.session import get_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or None
    spark = get_session()
    res = compare(spark, sf, keys)
    bad = {k: v for k, v in res.items() if v[0] not in ("ok", "no-oracle")}
    print(f"{len(res) - len(bad)}/{len(res)} ok-or-unchecked; problems: {sorted(bad)}")
