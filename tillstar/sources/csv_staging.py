"""CSV staging: bulk text files with a header, empty field = NULL, fixed schema.

``read_staging`` is the ``COPY ... (FORMAT csv, HEADER, NULL '')`` step: a
declared all-text schema, no inference, fail on malformed rows (or keep them
apart with ``mode="PERMISSIVE"`` and a corrupt-record column).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def write_staging_csv(df: DataFrame, path: str, compression: str = "snappy") -> str:
    """Write a frame as text CSV with a header (every column cast to string), compressed: a file is what one task wrote and one
    task reads."""
    (df.selectExpr(*[f"CAST(`{c}` AS STRING) AS `{c}`" for c in df.columns])
       .write.mode("errorifexists").option("header", True).option("nullValue", "")
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).option("compression", compression)
       .csv(path))
    return path


def read_staging(spark: SparkSession, path: str, schema: T.StructType, mode: str = "FAILFAST") -> DataFrame:
    return (spark.read.schema(schema)
            .option("header", True)
            .option("nullValue", "")
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .option("mode", mode)
            .csv(path))


def text_schema(df: DataFrame, long_cols: tuple[str, ...] = ("id",)) -> T.StructType:
    """All-text schema for a frame's columns (ids stay BIGINT, as in staging)."""
    return T.StructType([T.StructField(c, T.LongType() if c in long_cols else T.StringType(), True)
                         for c in df.columns])
