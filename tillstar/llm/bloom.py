"""Blocked Bloom filter over uniform 64-bit hashes: built by a Spark aggregation, probed inside tasks.

A key selects one 512-bit block (eight 64-bit words, one cache line) by its top bits, and one
bit in each word by six further bits. The filter never has more than 2 ** ``MAX_LOG_BLOCKS``
blocks (8 MiB), so what is broadcast is bounded whatever the number of keys: a fuller
filter lets more rows pass to the exact join that follows, and never loses one.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 8
BITS_PER_KEY = 16
MAX_LOG_BLOCKS = 17


class BloomFilter:
    """The filter of the non-null longs in ``keys[key]``, which must be hashes (uniform bits)."""

    def __init__(self, keys: DataFrame, key: str):
        keys = keys.select(F.col(key).alias("k")).filter(F.col("k").isNotNull())
        wanted = keys.count() * BITS_PER_KEY // (64 * WORDS)
        log_blocks = min(MAX_LOG_BLOCKS, max(6, int(wanted).bit_length()))
        self.shift = 64 - log_blocks
        masks = [F.call_function("shiftleft", F.lit(1).cast("long"),
                                 F.shiftrightunsigned("k", 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(WORDS)]
        rows = (keys.groupBy(F.shiftrightunsigned("k", self.shift).alias("block"))
                .agg(*[F.bit_or(m).alias(f"w{i}") for i, m in enumerate(masks)]).toPandas())
        table = np.zeros((1 << log_blocks, WORDS), np.uint64)
        table[rows["block"].to_numpy(np.int64)] = rows.iloc[:, 1:].to_numpy(np.int64).view(np.uint64)
        self.shared = keys.sparkSession.sparkContext.broadcast(table)

    def probe(self, keys: np.ndarray) -> np.ndarray:
        """Indices of the unsigned 64-bit ``keys`` that may be in the filter (inside a task)."""
        table = self.shared.value
        left = np.arange(len(keys))
        for i in range(WORDS):  # most keys fall out at the first word
            k = keys[left]
            words = table[(k >> np.uint64(self.shift)).astype(np.int64), i]
            left = left[((words >> ((k >> np.uint64(6 * i)) & np.uint64(63))) & np.uint64(1)).astype(bool)]
        return left

    def column(self, key: Column) -> Column:
        """True for every key of the filter and few others; null keys are false."""
        probe = self.probe

        @F.pandas_udf("boolean")
        def may(k: pd.Series) -> pd.Series:
            out = np.zeros(len(k), bool)
            out[probe(k.to_numpy(np.int64).view(np.uint64))] = True
            return pd.Series(out)

        return key.isNotNull() & may(F.coalesce(key, F.lit(0).cast("long")))

    def __getstate__(self):
        return {"shift": self.shift, "shared": self.shared}
