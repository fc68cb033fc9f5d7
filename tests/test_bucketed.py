"""Bucketed dimensions: applies touch the buckets with changes only."""

import os

import pytest

from tillstar.operators import bucketed, scd
from tillstar.session import fresh_path

TRACKED = ["region", "status"]


def snap(spark, rows):
    return spark.createDataFrame(rows, "uid long, name string, region long, status string")


def files(root):
    """File -> time of change, by bucket."""
    path = root.removeprefix("file:") + "/rows"
    return {d: {(f, os.stat(f"{path}/{d}/{f}").st_mtime_ns) for f in os.listdir(f"{path}/{d}")} for d in os.listdir(path) if "=" in d}


def test_apply_equals_whole_apply_and_leaves_other_buckets_alone(spark):
    rows = [(i, f"n{i}", i % 5, "A" if i % 3 else None) for i in range(200)]
    steps = [("2024-02-01", [*rows[:150], *[(i, n, r, "B") for i, n, r, _ in rows[150:153]]]),        # few change
             ("2024-03-01", rows[20:]),                                                              # back again, some absent
             ("2024-03-01", [*rows[:7], (7, "n7", None, "7"), *rows[8:], (900, "new", 1, "A")]),     # twice on one day
             ("2024-04-01", [(i, "renamed", r, s) for i, _, r, s in rows] + [(900, "new", 1, "A")]),  # untracked column; 7 as at first
             ("2024-05-01", [])]                                                                     # all absent: nothing closes
    whole = scd.scd2_initial(snap(spark, rows), "uid", "uk", "2024-01-01")
    root = fresh_path(spark, "t")
    bucketed.write_history(whole, snap(spark, rows), root, "uid", TRACKED, "2024-01-01", buckets=16)
    assert len(files(root)) == 16
    seen = []
    for day, step in steps:
        before, new = files(root), snap(spark, step)
        touched = bucketed.apply_snapshot(spark, root, new, "uid", "uk", TRACKED, day)
        seen.append(len(touched))
        whole = spark.createDataFrame(scd.scd2_apply(whole, new, "uid", "uk", TRACKED, day).collect(), whole.schema)
        got = bucketed.read_table(spark, root)
        assert sorted(map(str, got.select(whole.columns).collect())) == sorted(map(str, whole.collect()))
        after = files(root)
        assert {d for d in after if after[d] != before.get(d)} == {f"{bucketed.BUCKET}={b}" for b in touched}
        assert bucketed.apply_snapshot(spark, root, new, "uid", "uk", TRACKED, day) == [] and files(root) == after
    assert seen[2] <= 16 and 1 <= seen[3] <= 2
    with pytest.raises(ValueError):
        bucketed.apply_snapshot(spark, root, snap(spark, rows), "uid", "uk", TRACKED, "2024-01-15")


def test_a_value_that_moves_between_columns_changes_the_digest(spark):
    df = lambda a, b: spark.createDataFrame([(1, a, b)], "k long, a string, b string")
    one, two = (bucketed.snapshot_digests(d, "k", ["a", "b"], 4).collect() for d in (df("x", None), df(None, "x")))
    assert len(one) == 4 and one != two


def test_an_apply_that_broke_off_is_repeated(spark):
    """Digests of buckets under replacement are null: whatever snapshot comes next, these buckets are read again."""
    rows = [(i, "n", 1, "A") for i in range(40)]
    root = fresh_path(spark, "t")
    bucketed.write_history(scd.scd2_initial(snap(spark, rows), "uid", "uk", "2024-01-01"), snap(spark, rows), root, "uid", TRACKED, "2024-01-01", 4)
    digests = bucketed.snapshot_digests(snap(spark, rows), "uid", TRACKED, 4)
    bucketed._write_digests(digests.selectExpr(bucketed.BUCKET, *[f"if({bucketed.BUCKET} = 2, null, {c}) AS {c}" for c in ("n", "x1", "x2")]), root, "2024-02-01")
    assert bucketed.apply_snapshot(spark, root, snap(spark, rows), "uid", "uk", TRACKED, "2024-02-01") == [2]
    assert bucketed.read_table(spark, root).count() == 40


def test_empty_tables_and_inserts(spark):
    empty = snap(spark, [])
    root = fresh_path(spark, "t")
    bucketed.write_history(scd.scd2_initial(empty, "uid", "uk", "2024-01-01"), empty, root, "uid", TRACKED, "2024-01-01", 4)
    assert bucketed.read_table(spark, root).count() == 0
    assert bucketed.apply_snapshot(spark, root, empty, "uid", "uk", TRACKED, "2024-01-02") == []
    assert len(bucketed.apply_snapshot(spark, root, snap(spark, [(5, "n", 1, "A")]), "uid", "uk", TRACKED, "2024-01-03")) == 1
    assert [r.uid for r in bucketed.read_table(spark, root).collect()] == [5]
    days = fresh_path(spark, "t")
    table = spark.createDataFrame([(i, "old") for i in range(0, 40, 2)], "k long, v string")
    bucketed.write_table(table, days, "k", 4)
    before = files(days)
    for _ in range(2):
        bucketed.insert_absent(spark, days, spark.createDataFrame([("new", k) for k in (1, 2, 3)], "v string, k long"), "k")
    bucketed.insert_absent(spark, days, table.limit(0), "k")
    assert {r.k: r.v for r in bucketed.read_table(spark, days).collect()} == {i: "old" for i in range(0, 40, 2)} | {1: "new", 3: "new"}
    after = files(days)
    assert all(before[d] <= after[d] for d in before)
