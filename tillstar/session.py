"""Session construction and the shared work folder.

On a cluster the session already exists and is configured by the platform;
``get_session`` then only returns it. The defaults below are for local runs
and tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings every job relies on: UTC for date arithmetic, AQE for runtime
# re-planning (partition coalescing, skew splitting, runtime broadcast of
# small join sides), dynamic partition overwrite for incremental refreshes.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tillstar") -> SparkSession:
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    builder = builder.master(master or os.environ.get("TILLSTAR_MASTER", "local[8]"))
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    builder = (builder
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", "8g")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8)))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_job_conf(spark: SparkSession) -> None:
    """Pin the settings results depend on (time zone) on an existing session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of every executor (once per application)."""
    sc = spark.sparkContext
    if getattr(sc, "_tillstar_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="tillstar-"), "tillstar.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, files in os.walk(package):
            for f in files:
                if f.endswith(".py"):
                    path = os.path.join(folder, f)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    sc.addPyFile(archive)
    sc._tillstar_shipped = True


def work_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, stream checkpoints and sinks.

    Uses ``spark.checkpoint.dir`` as configured for the cluster; only when it is
    unset and the master is local (tests) a private temporary folder is created.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tillstar-"))
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, never-used path under the work root (write-once; never overwritten while read)."""
    return f"{work_root(spark)}/tillstar/{name}-{uuid.uuid4().hex[:12]}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of Spark's file system, if it exists."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
