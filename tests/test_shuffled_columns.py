"""What the dedup, the lookups and the stores carry through their shuffles and sorts, on rows built here."""

import datetime as dt

from conftest import SF_SMALL
from pyspark.sql import functions as F
from tillstar.operators.dedup import latest_per_key
from tillstar.plans import fixtures as fx
from tillstar.session import fresh_path
from tillstar.sources import landing


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_the_dedup_shuffles_no_derived_texts(spark):
    grouped = optimized(fx.fx_tx(spark, SF_SMALL)).split("Aggregate", 1)[1]
    assert not any(text in grouped for text in ("INSUFFICIENT_BALANCE", "DC-NDB", "SYNCED", "FAILED"))


def test_an_ascending_order_column_is_sent_once(spark):
    rows = [(1, 5, "b", None), (1, 5, "a", 2.0), (1, 4, "a", 1.0), (2, None, None, None), (None, 3, "x", 9.0), (None, 3, "w", 8.0)]
    best = latest_per_key(spark.createDataFrame(rows, "k int, v int, t string, x double"), ["k"], [("v", True), ("t", False)])
    assert sorted(map(tuple, best.collect()), key=str) == sorted([(1, 5, "a", 2.0), (2, None, None, None), (None, 3, "w", 8.0)], key=str)
    inner = optimized(best).split("_row, struct(")[1].split(")")[0]
    assert "x, x#" in inner and "t, t#" not in inner


def test_versions_without_a_flag_or_line_stay_apart(spark):
    day = dt.datetime(1995, 1, 2)
    rows = [(1, 1, None), (2, 1, "R"), (3, 2, "N"), (4, None, "R"), (4, None, "N")]
    li = spark.createDataFrame([(ok, 7, 8, ln, 1.0, 10.0, 0.02, flag, day) for ok, ln, flag in rows],
                               "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                               "l_tax double, l_returnflag string, l_shipdate timestamp_ntz")
    orders = spark.createDataFrame([(k, 100 + k, day) for k in (1, 2, 3, 4)], "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz")
    latest = latest_per_key(fx._versions(li), ["tx_id"], fx.VERSION_ORDER)
    got = {r.user_key: (r.tx_id, r.status, r.failure_reason) for r in fx._with_orders(latest, orders).collect()}
    assert got == {101: (9, "SUCCESS", "INSUFFICIENT_BALANCE"), 102: (17, "FAILED", "INSUFFICIENT_BALANCE"), 103: (26, "SUCCESS", None),
                   104: (None, "FAILED", "INSUFFICIENT_BALANCE")}


def test_lookups_carry_typed_columns_only(spark):
    fact = fx.fixture_star(spark, SF_SMALL).fact.select("tx_pk", "amount", "fee", "user_key", "merchant_key")
    above = optimized(fact).split("Join LeftOuter", 1)[0]
    assert "amount_node_a" not in above and "trim" not in above


def test_stores_are_split_without_a_sort(spark):
    rows = spark.createDataFrame([(i, dt.date(2020, 1 + i % 12, 1) if i % 7 else None) for i in range(300)], "tx_pk long, transaction_date date")
    seen = []
    before = spark.conf.get(landing.OPEN_FILES, None)
    path = landing.split_hot_archive(rows.filter(F.col("tx_pk") >= 0), fresh_path(spark, "stores"))
    assert spark.conf.get(landing.OPEN_FILES, None) == before
    both = landing.read_both(spark, path, rows.schema)
    for r in both.collect():
        old = r.transaction_date is not None and r.transaction_date < dt.date(2020, 6, 1)
        seen.append(r.tx_pk)
        assert r.store == ("archive" if old else "hot")
    assert sorted(seen) == list(range(300))


def test_remainders_and_needs_of_identifiers(spark):
    from tillstar.functions.identifiers import mod97
    from tillstar.operators import governance as gov
    spelt = lambda s: int("".join(str(int(x, 36)) for x in s)) % 97
    texts = ["0", "97", "MR1300020001010000123456753", "Z" * 34, "9" * 75, "1" + "A" * 37, "A" * 60, "00000000000000000001", "GB82WEST12345698765432"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r.t: r.m for r in df.select("t", mod97(F.col("t")).alias("m")).collect()} == {t: spelt(t) for t in texts}
    import re
    samples = ["a@b.org", "+222 21 22 23 24", "+1 (202) 555-0143", "23456789", "P12345678", "1234567890", "N12345678", "MR13 0002 0001 0100 0012 3456 753",
               "1111-2222-3333-4444", "4111111111111111", "no digits", "", None, "12 34"]
    rows = spark.createDataFrame([(t,) for t in samples], "t string")
    got = {r.pii_type: r.nb_hits for r in gov.pii_scan(rows, "x").collect()}
    assert got == {k: sum(len(re.findall(f"(?:{p})", t)) for t in samples if t) for k, p in gov.PII_PATTERNS.items()}


def test_staging_text_is_written_compressed_and_read_back(spark):
    from tillstar.sources import csv_staging
    rows = [(i, None if i % 3 else " padded, \"quoted\" ") for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, t string")
    path = csv_staging.write_staging_csv(df, fresh_path(spark, "staging"))
    assert all(r.path.endswith(".csv.snappy") for r in spark.read.format("binaryFile").load(path).select("path").collect())
    assert sorted(map(tuple, csv_staging.read_staging(spark, path, csv_staging.text_schema(df)).collect())) == sorted(rows, key=lambda r: r[0])
