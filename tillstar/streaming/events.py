"""Live transaction stream: file landing, shared transforms, counters, sinks.

The same transform functions run on batch and streaming DataFrames (one
definition of "live", "near-real-time" and "batch"), so the stream can be
checked against the batch result on the same rows.

Sources are Parquet files landed in a folder (the CDC tool's drops; Kafka in a
deployment); queries run over what is available (tests, catch-up) or every interval
(``run(..., interval="5 minutes")``, a service). Checkpoints and sinks live under the shared
work folder (``spark.checkpoint.dir``), so a restarted driver resumes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, LongType, StructField, StructType

from tillstar.operators.dedup import latest_per_key
from tillstar.session import BASE_CONF, fresh_path

EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
WATERMARK = "10 minutes"
ROWS_PER_FILE = 200_000
# State partitions of counter streams. A stateful query fixes its partition count at
# its first start (from spark.sql.shuffle.partitions); counters hold a few keys
# (windows), so a cluster-sized default would schedule thousands of near-empty state
# tasks every micro-batch. Streams with a join keep the session's count.
COUNTER_STATE_PARTITIONS = 8


def as_transactions(events: DataFrame) -> DataFrame:
    """events -> transactions (batch or stream). ``ts`` becomes TIMESTAMP (watermarks
    refuse TIMESTAMP_NTZ)."""
    eid = F.col("event_id")
    return events.select(
        eid.alias("transaction_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("user_id"),
        F.col("event_type"),
        F.col("value").cast("decimal(18,2)").alias("amount"),
        F.when(F.col("event_type") == "error", "FAILED").otherwise("SUCCESS").alias("status"),
        F.when(eid % 64 == 0, "CONFLICT").when(eid % 64 == 1, "LAGGING").when(eid % 64 == 2, "PENDING")
         .otherwise("SYNCED").alias("sync_status"),
    )


def committed(tx: DataFrame) -> DataFrame:
    """Near-real-time view: committed rows only (PENDING left out)."""
    return tx.filter(F.col("sync_status") != "PENDING")


# ------------------------------------------------------------------ landing
def held_back(late_every: int) -> Column:
    """Events that arrive late in the late-data job."""
    return F.col("event_id") % late_every == 0


def land_events(events: DataFrame, path: str) -> str:
    """Add events to a landing folder in one pass: range-partitioned on (time, id), so a busy moment is split
    over tasks, with at most ``ROWS_PER_FILE`` rows a file. Results do not depend on how files are cut."""
    (events.repartitionByRange("ts", "event_id").write.mode("append").option("maxRecordsPerFile", ROWS_PER_FILE).parquet(path))
    return path


def read_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The landing folder as a stream; ``max_files`` bounds a micro-batch of a service that catches up."""
    reader = spark.readStream.schema(EVENT_SCHEMA)
    return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).parquet(path)


# ------------------------------------------------------------------ running
def counter_session(spark: SparkSession) -> SparkSession:
    """A session of the same application with a counter-sized state; the caller's settings stay as they are."""
    own = spark.newSession()
    for k, v in BASE_CONF.items():
        own.conf.set(k, v)
    own.conf.set("spark.sql.shuffle.partitions", str(COUNTER_STATE_PARTITIONS))
    return own


def run(writer, checkpoint: str, interval: str | None = None, timeout: int | None = None) -> StreamingQuery:
    """Start a query: over everything available, then stop (default), or every ``interval`` (a service, e.g.
    "5 minutes" for change capture, "5 seconds" for live counters) until stopped or for ``timeout`` seconds."""
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    q = writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()
    q.awaitTermination(timeout) if timeout else q.awaitTermination()
    if interval and q.isActive:
        q.stop()
    if q.exception():
        raise q.exception()
    return q


BATCH, DAY = "batch_id", "jour"


def counter_table_sink(root: str, day: str | None = None):
    """foreachBatch sink: the updated counters of every micro-batch, appended as partitions ``jour=.../batch_id=...`` by Spark's
    Parquet writer (``day``: an SQL expression for the day a counter belongs to; counters without one stand under no day). A replayed
    batch overwrites its own partitions and no others, so a restart changes nothing. Only updated rows are written,
    by as many tasks as the stream has state partitions."""
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn(DAY, F.expr(day or "CAST(NULL AS DATE)")).withColumn(BATCH, F.lit(batch_id).cast("long"))
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY, BATCH).parquet(root))
    return write


def _counter_schema(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(DAY, DateType()), StructField(BATCH, LongType())])


def read_counters(spark: SparkSession, root: str, schema: StructType, keys: list[str], days: Column | None = None) -> DataFrame:
    """The newest row of every counter: a grouped minimum over the batches, so no sort of all versions. ``days``: a condition on
    ``jour``, which reads only the folders of these days (a dashboard looks at a few)."""
    rows = spark.read.schema(_counter_schema(schema)).parquet(root)
    rows = rows if days is None else rows.filter(days)
    return latest_per_key(rows.drop(DAY), keys, [(BATCH, True)]).drop(BATCH)


def compact_counters(spark: SparkSession, root: str, schema: StructType, keys: list[str], new_root: str, up_to: int) -> str:
    """A new table with one row a counter for all batches up to ``up_to`` and the later batches as they are; readers and the next
    run of the stream switch to it. Run between runs of the stream."""
    rows = spark.read.schema(_counter_schema(schema)).parquet(root)
    old = latest_per_key(rows.filter(F.col(BATCH) <= up_to), [*keys, DAY], [(BATCH, True)])
    kept = old.unionByName(rows.filter(F.col(BATCH) > up_to))
    kept.repartition(DAY).write.mode("errorifexists").partitionBy(DAY, BATCH).parquet(new_root)
    return new_root


def run_counter(spark: SparkSession, stream: DataFrame, keys: list[str], name: str, day: str | None = None) -> DataFrame:
    """Run an aggregating stream in update mode into a counter table; return the table."""
    root = fresh_path(spark, f"{name}-counters")
    run(stream.writeStream.outputMode("update").foreachBatch(counter_table_sink(root, day)), fresh_path(spark, f"{name}-ckpt"))
    return read_counters(spark, root, stream.schema, keys)


# ------------------------------------------------------------------ counters (batch or stream)
def windowed_count(tx: DataFrame, duration: str, slide: str | None = None, with_volume: bool = False) -> DataFrame:
    w = F.window("ts", duration, slide) if slide else F.window("ts", duration)
    aggs = [F.count(F.lit(1)).alias("nb_transactions")]
    if with_volume:
        aggs.append(F.sum("amount").alias("volume"))
    return tx.withWatermark("ts", WATERMARK).groupBy(w.alias("w")).agg(*aggs) if tx.isStreaming \
        else tx.groupBy(w.alias("w")).agg(*aggs)


WINDOW_DAY = "to_date(w.start)"


def rolling_from_panes(panes: DataFrame, panes_per_window: int, pane: str = "1 minute", counts: tuple[str, ...] = ("nb_transactions",)) -> DataFrame:
    """Sliding windows as sums of the tumbling panes they cover: every pane (not every event) goes into
    ``panes_per_window`` windows. Windows without any event do not appear."""
    step, length = F.expr(f"INTERVAL {pane}"), F.expr(f"INTERVAL {pane}") * panes_per_window
    start = F.explode(F.sequence(F.col("w.start") - length + step, F.col("w.start"), step)).alias("start")
    sums = panes.select(start, *counts).groupBy("start").agg(*[F.sum(c).alias(c) for c in counts])
    return sums.select(F.struct("start", (F.col("start") + length).alias("end")).alias("w"), *counts)


def flat_window(df: DataFrame) -> DataFrame:
    return df.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                     *[c for c in df.columns if c != "w"])


def region_latest(tx: DataFrame, users: DataFrame) -> DataFrame:
    """Per region, the amount of its latest transaction (a score that is set, not added)."""
    j = tx.join(users.select("user_id", "wilaya_id"), "user_id")
    return j.groupBy("wilaya_id").agg(F.max_by("amount", F.struct("ts", "transaction_id")).alias("dernier_montant"),
                                      F.max("ts").alias("dernier_ts"))


def region_volume(tx: DataFrame, users: DataFrame) -> DataFrame:
    j = tx.join(users.select("user_id", "wilaya_id"), "user_id")
    return j.groupBy("wilaya_id").agg(F.count(F.lit(1)).alias("nb_transactions"), F.sum("amount").alias("volume"))


def daily_counts(tx: DataFrame, name: str = "nb") -> DataFrame:
    return tx.groupBy(F.to_date("ts").alias("jour")).agg(F.count(F.lit(1)).alias(name))
