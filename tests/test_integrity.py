"""Identifier checks, replica digests, signed changes, merged point-in-time joins."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tillstar.functions import identifiers
from tillstar.operators import delta, governance, replica_diff
from tillstar.operators.asof import merge_asof
from tillstar.operators.scd import asof_join
from tillstar.plans import fixtures as fx
from tillstar.session import fresh_path
from test_plans import plan


# ------------------------------------------------------------------ identifiers
@pytest.mark.parametrize("kind, good, bad", [
    ("IBAN", ["GB82WEST12345698765432", "FR1420041010050500013M02606", "DE89370400440532013000", "MR1300020001010000123456753", "GB82 WEST 1234 5698 7654 32"],
     ["GB82WEST12345698765431", "GB82WEST1234569876543", "FR1420041010050500013M02607", "ZZ82WEST12345698765432", "DE8937040044053201300"]),
    ("CARD", ["4111111111111111", "5500-0000-0000-0004", "378282246310005", "4111 1111 1111 1111"], ["4111111111111112", "5500-0000-0000-0005", "1234567890123"]),
    ("EMAIL", ["a.b+c@ex-ample.org", "x@a.io"], ["a..b@example.org", ".a@example.org", "a@-example.org", "a@example..org", "a" * 65 + "@example.org"]),
    ("PHONE", ["+1 (310) 555-4510", "+222 22 33 44 55", "22334455", "P10000001", "+33 145 678 9012"], ["+1 (110) 555-4510", "+222 92 33 44 55", "+1 (310) 155-4510"]),
    ("NNI", ["1234567890", "N20000001"], ["0000000000", "7777777777"]),
])
def test_identifier_checks(spark, kind, good, bad):
    df = spark.createDataFrame([(h,) for h in good + bad], "h string")
    got = {r.h for r in df.filter(identifiers.VALID[kind](F.col("h"))).collect()}
    assert got == set(good)


def test_checksums_against_arithmetic(spark):
    rng = random.Random(4)
    numbers = ["".join(rng.choices("0123456789ABCXYZ", k=rng.randint(1, 34))) for _ in range(300)]
    df = spark.createDataFrame([(n,) for n in numbers], "n string")
    want = {n: int("".join(str(int(c, 36)) for c in n)) % 97 for n in numbers}
    assert {r.n: r.m for r in df.select("n", identifiers.mod97(F.col("n")).alias("m")).collect()} == want
    cards = ["".join(rng.choices("0123456789", k=rng.randint(13, 19))) for _ in range(300)]

    def luhn(card):
        return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(card))) % 10 == 0

    df = spark.createDataFrame([(c,) for c in cards], "c string")
    assert {r.c: r.v for r in df.select("c", identifiers.card_valid(F.col("c")).alias("v")).collect()} == {c: luhn(c) for c in cards}


def test_scan_counts_valid_hits_in_whole_texts(spark):
    far = "x " * 50_000
    rows = [(f"{far}GB82WEST12345698765432 and GB82WEST12345698765431 4111111111111111",), (None,), ("",), ("4111111111111112 a..b@c.org",)]
    got = {r.pii_type: (r.nb_rows, r.nb_hits, r.nb_valid) for r in governance.pii_scan(spark.createDataFrame(rows, "t string"), "x").collect()}
    assert got["IBAN"] == (1, 2, 1) and got["CARD"] == (2, 2, 1) and got["EMAIL"] == (1, 1, 0) and got["NNI"] == (0, 0, 0)


# ------------------------------------------------------------------ replicas
DAY = dt.date(2024, 1, 1)


def ledger(spark, rows):
    return spark.createDataFrame(rows, "node_id string, jour date, transaction_id long, montant decimal(18,2), statut string")


def ledger_rows(n, rng):
    return [(f"N{rng.randint(1, 3)}", DAY + dt.timedelta(days=rng.randint(0, 150)), i, round(rng.random() * 100, 2), rng.choice(["A", "B"])) for i in range(n)]


def test_differing_rows_are_named_and_only_their_folders_read(spark):
    rows = [(*r[:3], Decimal(str(r[3])), r[4]) for r in ledger_rows(3000, random.Random(2))]
    other = list(rows)
    node, day, i, amount, status = other[10]
    other[10] = (node, day, i, amount + 1, status)
    del other[500]
    other.append((rows[900][0], rows[900][1], 10_000, amount, "A"))
    other.append(rows[1200])
    a, b = (replica_diff.write_replica(ledger(spark, r), fresh_path(spark, "t")) for r in (rows, other))
    got = {(r.transaction_id, r.ecart_type) for r in replica_diff.differing_rows(spark, a, b).collect()}
    kind = "lignes" if rows[1200][3] == 0 else "montant"
    assert got == {(10, "montant"), (500, "absent_b"), (10_000, "absent_a"), (1200, kind)}
    # Only folders of differing buckets are read, and only differing buckets of those.
    buckets = replica_diff.descend(replica_diff.read_digests(spark, a), replica_diff.read_digests(spark, b))[-1].select(*replica_diff.LEVELS[-1])
    folders = replica_diff.folders_of(buckets)
    assert buckets.count() <= 4 and len(folders) <= 2
    held = replica_diff.rows_of(replica_diff.read_rows(spark, a), buckets, folders)
    p = plan(held)
    assert "PartitionFilters: [mois#" in p and "PushedFilters: [In(node_id" in p
    near = replica_diff.in_folders(replica_diff.read_rows(spark, a), folders)
    read = {r.f.split("/")[-2] for r in near.select(F.input_file_name().alias("f")).distinct().collect()}
    assert read and read <= {f"mois={m}" for m in folders}
    assert held.select(*replica_diff.LEVELS[-1]).distinct().count() <= buckets.count() and held.count() < 60


def test_equal_replicas_read_no_rows(spark):
    rows = [("N1", None, None, None, None), (None, DAY, 5, None, "A"), ("N1", DAY, 5, Decimal("1.00"), None)]
    a, b = (replica_diff.write_replica(ledger(spark, r), fresh_path(spark, "t")) for r in (rows, rows[::-1]))
    assert all(level.count() == 0 for level in replica_diff.descend(replica_diff.read_digests(spark, a), replica_diff.read_digests(spark, b)))
    assert replica_diff.differing_rows(spark, a, b).count() == 0
    c = replica_diff.write_replica(ledger(spark, rows[1:]), fresh_path(spark, "t"))
    assert [(r.node_id, r.jour, r.ecart_type) for r in replica_diff.differing_rows(spark, a, c).collect()] == [("N1", None, "absent_b")]
    empty = replica_diff.write_replica(ledger(spark, []), fresh_path(spark, "t"))
    assert replica_diff.differing_rows(spark, a, empty).count() == 3


def test_repeated_rows_do_not_cancel(spark):
    rows = ledger_rows(5, random.Random(9))
    rows = [(*r[:3], Decimal(str(r[3])), r[4]) for r in rows]
    a, b = (replica_diff.write_replica(ledger(spark, r), fresh_path(spark, "t")) for r in (rows, rows + [rows[0]] * 2))
    assert [r.transaction_id for r in replica_diff.differing_rows(spark, a, b).collect()] == [0]


def test_a_row_on_another_day_is_found_though_its_node_has_the_same_rows(spark):
    rows = [(*r[:3], Decimal(str(r[3])), r[4]) for r in ledger_rows(200, random.Random(6))]
    moved = [(*rows[7][:1], rows[7][1] + dt.timedelta(days=1), *rows[7][2:])]
    a, b = (replica_diff.write_replica(ledger(spark, r), fresh_path(spark, "t")) for r in (rows, rows[:7] + moved + rows[8:]))
    levels = replica_diff.descend(replica_diff.read_digests(spark, a), replica_diff.read_digests(spark, b))
    assert [level.count() for level in levels] == [1, 2, 2]
    got = {(r.transaction_id, r.ecart_type, r.jour) for r in replica_diff.differing_rows(spark, a, b).collect()}
    assert got == {(7, "absent_b", rows[7][1]), (7, "absent_a", moved[0][1])}


# ------------------------------------------------------------------ signed changes
def test_deltas_equal_a_rebuild_after_every_batch_and_after_folding(spark):
    star, stale, batches = fx.changed_fact(spark, SF_SMALL, ("user",))
    for mart in (delta.DAILY_KPIS, delta.REGION_VOLUME):
        root = delta.build(mart, star.with_fact(stale), fresh_path(spark, "t"))
        rows = stale.withColumn("_sign", F.lit(1).cast("long"))
        for number, changes in enumerate(batches):
            delta.apply_batch(mart, star, root, changes, number)
            delta.apply_batch(mart, star, root, changes, number)  # delivered twice
            rows = rows.unionByName(changes)
            rebuilt = mart.publish(mart.sums(rows, star).filter("_rows <> 0"), star)
            got = delta.read_mart(mart, star, spark, root)
            assert sorted(map(str, got.collect())) == sorted(map(str, rebuilt.collect()))
        folded = delta.fold(mart, star, spark, root, fresh_path(spark, "t"))
        assert sorted(map(str, delta.read_mart(mart, star, spark, folded).collect())) == sorted(map(str, got.collect()))


def test_delta_reads_touch_no_fact_and_prune_months(spark):
    star, stale, batches = fx.changed_fact(spark, SF_SMALL, ())
    root = delta.build(delta.DAILY_KPIS, star.with_fact(stale), fresh_path(spark, "t"))
    delta.apply_batch(delta.DAILY_KPIS, star, root, batches[0], 0)
    p = plan(delta.read_mart(delta.DAILY_KPIS, star, spark, root, months=[199501]))
    assert "lineitem" not in p and "amount" not in p
    assert p.count("PartitionFilters: [isnotnull(ym") == 2


def test_cancelled_rows_leave_no_key(spark):
    star, _, _ = fx.changed_fact(spark, SF_SMALL, ())
    root = delta.build(delta.DAILY_KPIS, star.with_fact(star.fact), fresh_path(spark, "t"))
    day = star.fact.agg(F.min("date_key")).first()[0]
    gone = star.fact.filter(F.col("date_key") == day)
    delta.apply_batch(delta.DAILY_KPIS, star, root, delta.signed(gone, None), 0)
    assert delta.read_sums(delta.DAILY_KPIS, star, spark, root).filter(F.col("date_key") == day).count() == 0


# ------------------------------------------------------------------ as-of join
def _asof_inputs(spark, seed):
    rng = random.Random(seed)
    base = dt.date(1995, 1, 1)
    versions = []
    for k in range(12):
        cuts = sorted(rng.sample(range(2500), rng.randint(0, 5)))
        for n, (lo, hi) in enumerate(zip(cuts, cuts[1:] + [None])):
            if n % 3 != 2:  # leaves gaps
                versions.append((k, base + dt.timedelta(days=lo), base + dt.timedelta(days=hi) if hi else None, f"v{k}-{n}"))
    facts = [(i, rng.choice([*range(13), None]), None if rng.random() < 0.03 else base + dt.timedelta(days=rng.randint(-50, 2600)), "x") for i in range(800)]
    facts += [(1000 + i, 1, v[1], "on the day") for i, v in enumerate(versions) if v[0] == 1]
    return (spark.createDataFrame(facts, "id long, k long, d date, _at string"),
            spark.createDataFrame(versions, "key long, effective_from date, effective_to date, name string"))


@pytest.mark.parametrize("seed, months", [(1, 1), (2, 5), (3, 12), (4, 1200)])
def test_merged_join_equals_range_join(spark, seed, months):
    facts, versions = _asof_inputs(spark, seed)
    want = sorted(tuple(r) for r in asof_join(facts, versions, "k", "key", "d").select("id", "name").collect())
    merged = merge_asof(facts, versions, "k", "key", "d", ["name"], slice_months=months)
    assert merged.columns == [*facts.columns, "name"]
    assert sorted(tuple(r) for r in merged.select("id", "name").collect()) == want
    left = merge_asof(facts, versions, "k", "key", "d", ["name"], how="left", slice_months=months)
    names = dict(want)
    assert {r.id: r.name for r in left.collect()} == {r.id: names.get(r.id) for r in facts.collect()}


def test_merged_join_has_no_join_and_refuses_clashes(spark):
    facts, versions = _asof_inputs(spark, 5)
    p = plan(merge_asof(facts, versions, "k", "key", "d", ["name"]))
    assert "Join" not in p
    assert merge_asof(facts.limit(0), versions, "k", "key", "d", ["name"]).count() == 0
    assert merge_asof(facts, versions.limit(0), "k", "key", "d", ["name"]).count() == 0
    with pytest.raises(ValueError):
        merge_asof(facts, versions.withColumn("id", F.lit(1)), "k", "key", "d", ["id"])
