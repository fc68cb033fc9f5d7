"""Intermediate tables in the shared folder: computed once, lineage cut, readable by every executor."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from tillstar.session import fresh_path, remove_path

_made: ContextVar[list[str] | None] = ContextVar("made", default=None)
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """Tables written by ``materialise`` inside are removed at the end, also after an error; a result that reads them is written
    inside. A table taken out of the list yielded stays."""
    made: list[str] = []
    outer = _made.set(made)
    try:
        yield made
    finally:
        _made.reset(outer)
        for path in made:
            remove_path(spark, path)


def materialise(df: DataFrame, name: str, narrow: bool = False, tidy: bool = False) -> DataFrame:
    """Write ``df`` as Parquet under the session's checkpoint folder and read it back.

    ``narrow`` (light rows that come out of a shuffle): at most three tasks a core of the
    cluster write it, each a few shuffle partitions, so that small tables make few files.
    ``tidy``: Spark deletes the shuffle files of the write when it is done, not when the driver collects garbage.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    if (made := _made.get()) is not None:
        made.append(path)
    out = df.coalesce(3 * spark.sparkContext.defaultParallelism) if narrow else df
    before = spark.conf.get(TIDY) if tidy else None
    try:
        if tidy:
            spark.conf.set(TIDY, "true")
        out.write.parquet(path)
    finally:
        if tidy:
            spark.conf.set(TIDY, before)
    return spark.read.schema(df.schema).parquet(path)
