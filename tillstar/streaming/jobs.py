"""The streaming jobs (ST1-ST8), each returning its result table as a batch DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.plans import fixtures as fx
from tillstar.session import fresh_path
from tillstar.sources.tables import load
from tillstar.streaming import events as ev


def _landed(spark: SparkSession, sf_dir: str) -> str:
    return ev.land_events(load(spark, sf_dir, "events"), fresh_path(spark, "landing-events"))


def _users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The static side of the region counters: a two-column user -> region lookup, written once so every
    micro-batch reads a compact file. Spark broadcasts it when its size in bytes is within
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles the join otherwise."""
    path = fresh_path(spark, "user-region-lookup")
    fx.fx_user(spark, sf_dir).select("user_id", "wilaya_id").write.parquet(path)
    return spark.read.parquet(path)


def stream_cdc_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST1: committed rows only, duplicates of a transaction id (every 40th event lands twice) dropped within
    the watermark, appended exactly once to a Parquet table."""
    events = load(spark, sf_dir, "events")
    path = ev.land_events(events.unionByName(events.filter(F.col("event_id") % 40 == 0)), fresh_path(spark, "landing-events"))
    src = ev.committed(ev.as_transactions(ev.read_stream(spark, path)))
    clean = src.withWatermark("ts", ev.WATERMARK).dropDuplicatesWithinWatermark(["transaction_id"])
    out = fresh_path(spark, "nrt-transactions")
    ev.run(clean.writeStream.format("parquet").option("path", out).outputMode("append"), fresh_path(spark, "nrt-ckpt"))
    return spark.read.parquet(out)


def _windowed(spark: SparkSession, sf_dir: str, name: str, duration: str, slide: str | None = None,
              volume: bool = False) -> DataFrame:
    tx = ev.as_transactions(ev.read_stream(ev.counter_session(spark), _landed(spark, sf_dir)))
    out = ev.flat_window(ev.run_counter(spark, ev.windowed_count(tx, duration, slide, volume), ["w"], name, ev.WINDOW_DAY))
    return out.withColumn("volume", F.col("volume").cast("double")) if volume else out


def stream_hourly_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST2: transactions per hour (the hourly counter that resets each hour)."""
    return _windowed(spark, sf_dir, "hourly", "1 hour")


def stream_daily_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST3: transactions per day (reset at midnight)."""
    return _windowed(spark, sf_dir, "daily", "1 day")


def stream_daily_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST4: count and volume per day (decimal sum, no lost cents)."""
    return _windowed(spark, sf_dir, "daily-volume", "1 day", volume=True)


def stream_rate_5min(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST6: rolling 5-minute count, sliding every minute: the stream keeps one-minute panes, each event counted once; a window is
    the sum of its five panes."""
    tx = ev.as_transactions(ev.read_stream(ev.counter_session(spark), _landed(spark, sf_dir)))
    panes = ev.run_counter(spark, ev.windowed_count(tx, "1 minute"), ["w"], "panes", ev.WINDOW_DAY)
    return ev.flat_window(ev.rolling_from_panes(panes, 5))


def stream_region_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST5: per region, the latest amount (set, not added). Stream-static join to users."""
    tx = ev.as_transactions(ev.read_stream(spark, _landed(spark, sf_dir)))
    out = ev.run_counter(spark, ev.region_latest(tx, _users(spark, sf_dir)), ["wilaya_id"], "region-latest")
    return out.withColumn("dernier_montant", F.col("dernier_montant").cast("double"))


def stream_region_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST5 (cumulative variant): count and volume per region."""
    tx = ev.as_transactions(ev.read_stream(spark, _landed(spark, sf_dir)))
    out = ev.run_counter(spark, ev.region_volume(tx, _users(spark, sf_dir)), ["wilaya_id"], "region-volume")
    return out.withColumn("volume", F.col("volume").cast("double"))


def stream_daily_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST7: midnight snapshot. Append-mode daily windows are emitted once the
    watermark passes the day's end, and archived to Parquet; the day still open
    at the end of the input is not in the archive yet."""
    tx = ev.as_transactions(ev.read_stream(ev.counter_session(spark), _landed(spark, sf_dir)))
    daily = tx.withWatermark("ts", ev.WATERMARK).groupBy(F.window("ts", "1 day").alias("w")).agg(
        F.count(F.lit(1)).alias("nb_transactions"), F.sum("amount").alias("volume"))
    out = fresh_path(spark, "daily-snapshot")
    ev.run(daily.writeStream.format("parquet").option("path", out).outputMode("append"), fresh_path(spark, "daily-snapshot-ckpt"))
    return ev.flat_window(spark.read.parquet(out)).withColumn("volume", F.col("volume").cast("double"))


LATE_EVERY = 50


def stream_late_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST8: late rows. Every 50th event lands after all others have been processed; a late row whose day the watermark
    (latest on-time event less ten minutes) has passed is dropped by the stream and counted by the
    nightly batch. Per day: stream count, batch count, rows left to the batch."""
    events, path = load(spark, sf_dir, "events"), fresh_path(spark, "landing-events")
    root, checkpoint, session = fresh_path(spark, "late-counters"), fresh_path(spark, "late-ckpt"), ev.counter_session(spark)
    for part in (~ev.held_back(LATE_EVERY), ev.held_back(LATE_EVERY)):
        ev.land_events(events.filter(part), path)
        daily = ev.windowed_count(ev.as_transactions(ev.read_stream(session, path)), "1 day")
        ev.run(daily.writeStream.outputMode("update").foreachBatch(ev.counter_table_sink(root, ev.WINDOW_DAY)), checkpoint)
    stream_daily = ev.flat_window(ev.read_counters(spark, root, daily.schema, ["w"])).select(
        F.to_date("window_start").alias("jour"), F.col("nb_transactions").alias("nb_stream"))
    batch_daily = ev.daily_counts(ev.as_transactions(events), "nb_batch")
    j = batch_daily.join(stream_daily, "jour", "left")
    return j.select("jour", F.coalesce("nb_stream", F.lit(0)).alias("nb_stream"), "nb_batch",
                    (F.col("nb_batch") - F.coalesce("nb_stream", F.lit(0))).alias("nb_tardives"))
