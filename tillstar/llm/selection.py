"""Removing listed documents without shuffling the texts of the others."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.bloom import BloomFilter
from tillstar.llm.storage import materialise


def without(docs: DataFrame, id_col: str, removed: DataFrame, repeated: DataFrame | None = None, same: Sequence[str] = ()) -> DataFrame:
    """``docs`` less the rows whose id is in ``removed`` (one column, the id), and only the smallest row of those that share an id in
    ``repeated`` and agree in the columns ``same``. Rows without id stay. ``docs`` has no columns ``gone``, ``same0``, ``same1`` ...

    A Bloom filter of bounded size parts the documents in a scan: what it does not hold stays as it
    is, and only the rest (the listed ones and few others) is shuffled for the exact anti-join. Beyond some four million listed
    ids the filter fills up: the result stays the same, and more rows are shuffled.
    """
    removed = materialise(removed.toDF("gone").filter("gone is not null").distinct(), "removed", narrow=True)
    listed = removed if repeated is None else removed.union(repeated.toDF("gone")).distinct()
    listed = BloomFilter(listed.select(F.xxhash64("gone").alias("k")), "k")
    may = F.col(id_col).isNotNull() & listed.column(F.xxhash64(F.col(id_col)))
    rest = docs.filter(may).join(removed, F.col(id_col) == F.col("gone"), "left_anti")
    if repeated is not None:
        columns = docs.columns
        rest = (rest.groupBy(*[F.col(c).alias(f"same{i}") for i, c in enumerate((id_col, *same))])
                .agg(F.min(F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)])).alias("row"))
                .select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(columns)]))
    return docs.filter(~may).unionByName(rest)
