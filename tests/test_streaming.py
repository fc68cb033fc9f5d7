"""Streaming: a restarted query resumes from its checkpoint and loses nothing."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tillstar.plans.check import duck
from tillstar.plans.registry import oracle_sql
from tillstar.session import fresh_path
from tillstar.sources.tables import load
from tillstar.streaming import events as ev
from tillstar.streaming import jobs


def test_restart_from_checkpoint_equals_batch(spark):
    src = load(spark, SF_SMALL, "events")
    landing_dir = fresh_path(spark, "t-landing")
    mid = src.agg(F.percentile_approx("event_id", 0.5)).first()[0]
    # first drop
    src.filter(F.col("event_id") <= mid).coalesce(1).write.parquet(landing_dir, mode="append")
    root, ckpt = fresh_path(spark, "t-counters"), fresh_path(spark, "t-ckpt")

    def run_once():
        tx = ev.as_transactions(ev.read_stream(spark, landing_dir, max_files=1))
        daily = ev.windowed_count(tx, "1 day")
        ev.run(daily.writeStream.outputMode("update").foreachBatch(ev.counter_table_sink(root, ev.WINDOW_DAY)), ckpt)
        return daily.schema

    run_once()
    # second drop arrives after the driver "restarted": same checkpoint, only new files are read
    src.filter(F.col("event_id") > mid).coalesce(1).write.parquet(landing_dir, mode="append")
    schema = run_once()
    got = {r["window_start"].date(): r["nb_transactions"]
           for r in ev.flat_window(ev.read_counters(spark, root, schema, ["w"])).collect()}
    want = {r["jour"]: r["nb"] for r in ev.daily_counts(ev.as_transactions(src)).collect()}
    assert got == want


def test_replayed_batch_is_harmless(spark):
    root = fresh_path(spark, "t-replay")
    sink, schema = ev.counter_table_sink(root), spark.createDataFrame([], "k string, n long").schema
    sink(spark.createDataFrame([("a", 1), ("b", 2)], "k string, n long"), 0)
    for _ in range(2):  # the same batch written twice
        sink(spark.createDataFrame([("a", 5)], "k string, n long"), 1)
    sink(spark.createDataFrame([("c", 7)], "k string, n long"), 2)
    def counters(path):
        return {r["k"]: r["n"] for r in ev.read_counters(spark, path, schema, ["k"]).collect()}

    assert counters(root) == {"a": 5, "b": 2, "c": 7}
    compacted = ev.compact_counters(spark, root, schema, ["k"], fresh_path(spark, "t-compact"), up_to=1)
    assert counters(compacted) == {"a": 5, "b": 2, "c": 7}
    assert spark.read.parquet(compacted).count() == 3 and spark.read.parquet(root).count() == 4
    ev.counter_table_sink(compacted)(spark.createDataFrame([("c", 9)], "k string, n long"), 3)
    assert counters(compacted) == {"a": 5, "b": 2, "c": 9}


def test_counters_of_a_day_read_its_folder_only(spark):
    events = ev.as_transactions(load(spark, SF_SMALL, "events"))
    hourly, root = ev.windowed_count(events, "1 hour"), fresh_path(spark, "t-days")
    ev.counter_table_sink(root, ev.WINDOW_DAY)(hourly, 0)
    day = hourly.select(F.expr(ev.WINDOW_DAY).alias("d")).agg(F.min("d")).first()[0]
    some = ev.read_counters(spark, root, hourly.schema, ["w"], days=F.col("jour") == F.lit(day))
    assert "PartitionFilters: [isnotnull(jour" in some._jdf.queryExecution().executedPlan().toString()
    assert some.count() == hourly.filter(F.expr(ev.WINDOW_DAY) == F.lit(day)).count() > 0


def test_rolling_rate_from_panes_over_micro_batches(spark):
    """Panes of several micro-batches add up to the sliding windows of the whole, also where a pane is updated later."""
    events = load(spark, SF_SMALL, "events")
    path, root, ckpt, session = fresh_path(spark, "t-panes"), fresh_path(spark, "t-pane-counters"), fresh_path(spark, "t-pane-ckpt"), ev.counter_session(spark)
    for part in range(3):  # every minute gets events in every drop, and the watermark holds none back
        (events.filter(F.col("event_id") % 3 == part).withColumn("ts", F.expr("timestamp_ntz'2024-05-01 00:00:00' + make_dt_interval(0, 0, 0, event_id % 400)"))
         .coalesce(1).write.mode("append").parquet(path))
        panes = ev.windowed_count(ev.as_transactions(ev.read_stream(session, path, max_files=1)), "1 minute")
        ev.run(panes.writeStream.outputMode("update").foreachBatch(ev.counter_table_sink(root, ev.WINDOW_DAY)), ckpt)
    stored = ev.read_counters(spark, root, panes.schema, ["w"])
    assert stored.agg(F.sum("nb_transactions")).first()[0] == events.count() and stored.count() == 7
    got = {r.window_start: r.nb_transactions for r in ev.flat_window(ev.rolling_from_panes(stored, 5)).collect()}
    one = ev.as_transactions(spark.read.schema(ev.EVENT_SCHEMA).parquet(path))
    want = {r.window_start: r.nb_transactions for r in ev.flat_window(ev.windowed_count(one, "5 minutes", "1 minute")).collect()}
    assert got == want and len(got) == 11


def test_one_pass_of_panes_makes_no_sliding_copies(spark):
    events = ev.as_transactions(load(spark, SF_SMALL, "events"))
    panes = ev.windowed_count(events, "1 minute")
    plan = ev.rolling_from_panes(panes, 5)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.index("Aggregate [window")  # panes are counted below the explode, events are not


def test_interval_trigger_runs_as_a_service(spark):
    path = ev.land_events(load(spark, SF_SMALL, "events"), fresh_path(spark, "t-service"))
    root = fresh_path(spark, "t-service-counters")
    daily = ev.windowed_count(ev.as_transactions(ev.read_stream(ev.counter_session(spark), path)), "1 day")
    ev.run(daily.writeStream.outputMode("update").foreachBatch(ev.counter_table_sink(root, ev.WINDOW_DAY)),
           fresh_path(spark, "t-service-ckpt"), interval="1 second", timeout=25)
    assert sum(r["nb_transactions"] for r in ev.read_counters(spark, root, daily.schema, ["w"]).collect()) == load(spark, SF_SMALL, "events").count()


@pytest.mark.parametrize("rows_per_file", [50, 1_000_000])
def test_late_rows_do_not_depend_on_files(spark, monkeypatch, rows_per_file):
    monkeypatch.setattr(ev, "ROWS_PER_FILE", rows_per_file)
    got = sorted(map(tuple, jobs.stream_late_report(spark, SF_SMALL).collect()))
    assert got == sorted(duck(SF_SMALL).sql(oracle_sql()["stream_late_report"]).fetchall())
