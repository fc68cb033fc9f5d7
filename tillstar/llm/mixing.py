"""Mixing sources to target weights by subset-sum budget fitting.

Every source has a target number of words. Whole copies of the source that fit are taken of
each document; what then remains of the budget is fitted with whole documents:

1.  Documents are counted by (source, exact length): all further planning is on these counts.
2.  Of each length the same share is taken (rounded down), so the mix keeps the source's
    lengths; single documents are added from the long lengths down while they fit.
3.  The last ``DP_WORDS`` words or fewer are fitted exactly by bounded-knapsack dynamic
    programming over the counts that are left.
4.  The planned number of each length is chosen by a seeded hash of the document.

Every document is thus taken 0, 1 or 2 times, never more than ``max_repeat``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstar.llm.storage import materialise

DP_WORDS = 20_000
HASH_BUCKETS = 1024
WEIGHTS = (3, 1, 2)
WORD = r"[^\x20\x09-\x0D]+"


def ranked_sources(totals: DataFrame) -> DataFrame:
    """``totals`` (source, total) with the rank of each source in code-point order, null last, from 0.

    The sources are sorted in ranges; a range's offset is the number of sources in the ranges before it (one row a range)."""
    ranged = totals.repartitionByRange(F.col("source").isNull(), "source").withColumn("range", F.spark_partition_id())
    ranged = materialise(ranged, "mix-sources")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("range").agg(F.count("*").alias("n")).select(
        F.col("range").alias("at"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("range").orderBy(F.col("source").isNull(), "source")
    placed = ranged.withColumn("place", F.row_number().over(within) - 1)
    return placed.join(offsets, F.col("range") == F.col("at")).select("source", "total", (F.col("place") + F.col("offset")).alias("rank"))


def targets(totals: DataFrame, weights: tuple, share: float, max_repeat: int) -> DataFrame:
    """(source, total, target): targets by weight that add up to ``share`` of all sizes, none above ``max_repeat`` times its size.

    ``unit`` is the words a unit of weight gets. A source whose part passes its cap is full; what it leaves is shared by weight among
    the others, which raises the unit, until no further source is full. Every round is one aggregation of the sources to two sums.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    sources = materialise(ranked_sources(totals).select(
        "source", "total", weight.alias("weight"), (F.col("total") * max_repeat).cast("double").alias("cap")), "mix-weights")
    budget = share * (sources.agg(F.sum("total")).first()[0] or 0)
    unit, full = 0.0, -1
    while True:
        is_full = F.col("weight") * unit > F.col("cap")
        seen = sources.agg(F.count_if(is_full), F.sum(F.when(is_full, F.col("cap"))), F.sum(F.when(~is_full, F.col("weight")))).first()
        if seen[0] == full or not seen[2]:
            break
        full, unit = seen[0], (budget - (seen[1] or 0.0)) / seen[2]
    return sources.select("source", "total", F.least(F.col("weight") * unit, "cap").alias("target"))


def fit_remaining(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take so that the sum is as near below ``budget`` as dynamic programming reaches.

    ``first[v]`` is the length that first reached the sum v; the choice is read back from it.
    """
    taken = np.zeros(len(lengths), np.int64)
    usable = np.flatnonzero((lengths > 0) & (lengths <= budget) & (counts > 0))
    if budget <= 0 or not len(usable):
        return taken
    first = np.full(budget + 1, -1, np.int64)
    reached = np.zeros(budget + 1, bool)
    reached[0] = True
    for i in usable[np.argsort(-lengths[usable])]:
        length = int(lengths[i])
        frontier = reached
        for _ in range(min(int(counts[i]), budget // length)):
            step = np.zeros_like(reached)
            step[length:] = frontier[:-length]
            frontier = step & ~reached
            if not frontier.any():
                break
            first[frontier] = i
            reached = reached | frontier
        if reached[budget]:
            break
    at = int(np.flatnonzero(reached)[-1])
    while at:
        i = first[at]
        taken[i] += 1
        at -= int(lengths[i])
    return taken


def plan(lengths: np.ndarray, counts: np.ndarray, budget: int, dp_words: int = DP_WORDS) -> np.ndarray:
    """How many documents of each length to take for a budget of at most the whole source; the sum never exceeds it."""
    total = int((lengths * counts).sum())
    if budget >= total:
        return counts.copy()
    # Python integers: counts times budgets may pass 64 bits.
    taken = np.array([int(c) * budget // total for c in counts], np.int64) if total else np.zeros_like(counts)
    left = budget - int((taken * lengths).sum())
    for i in np.argsort(-lengths, kind="stable"):
        if left <= dp_words:
            break
        if lengths[i]:
            more = min(int(counts[i] - taken[i]), (left - dp_words) // int(lengths[i]) + 1, left // int(lengths[i]))
            taken[i] += more
            left -= more * int(lengths[i])
    return taken + fit_remaining(lengths, counts - taken, left if left <= dp_words else 0)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple = WEIGHTS, share: float = 1.5, max_repeat: int = 2, seed: int = 8) -> DataFrame:
    """One row per row of ``docs``: id, size, source_size, target, copies, taken (= copies * size).

    Sources in code-point order, null last, weigh ``weights`` in turn and share ``share`` times
    all words. The size is the number of words between ASCII white space (null: 0); documents of
    no words are never taken. Repeated rows are chosen one by one, rows without id by their place. An empty table gives an empty result. Extra columns are ignored.

    What reaches the driver are sums over all sources, so sources may be as many as domains; counts by length of one source meet in one
    task (lengths, not documents). Within a length the documents are dealt into hash buckets that
    are taken whole, and only one bucket is ordered, so a length that holds a third of all rows is spread.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
                       F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"))
    # Written once: "place" tells apart rows without id and breaks ties.
    rows = rows.withColumn("place", F.monotonically_increasing_id())
    rows = rows.withColumn("h", F.xxhash64(F.coalesce("id", "place"), F.lit(seed)))
    rows = materialise(rows.withColumn("bucket", F.pmod(F.shiftright("h", 20), F.lit(HASH_BUCKETS))), "mix-rows")
    counts = materialise(rows.groupBy("source", "size").agg(F.count("*").alias("n")), "mix-counts", narrow=True)

    plans = targets(counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("total")), weights, share, max_repeat)
    plans = plans.select(F.col("source").alias("of"), F.col("total").alias("source_size"), "target")

    def fitted(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("size")
        total, target = int(group["source_size"].iloc[0]), float(group["target"].iloc[0])
        whole = min(int(target // total), max_repeat) if total else 0
        lengths, n = group["size"].to_numpy(np.int64), group["n"].to_numpy(np.int64)
        extra = plan(lengths, n, round(target) - whole * total) if total and whole < max_repeat else np.zeros_like(n)
        return group.assign(whole=whole, extra=extra)[["source", "size", "source_size", "target", "n", "whole", "extra"]]

    same_source = F.col("source").eqNullSafe(F.col("of"))
    planned = materialise(
        counts.join(plans, same_source).drop("of").groupBy("source")
        .applyInPandas(fitted, "source string, size long, source_size long, target double, n long, whole long, extra long"), "mix-plan", narrow=True)

    # The bucket in which the planned number of a length runs out, and how many of it are taken there.
    partly = planned.filter("extra > 0 and extra < n").select(F.col("source").alias("of"), F.col("size").alias("len"), "extra")
    same = F.col("source").eqNullSafe(F.col("of")) & (F.col("size") == F.col("len"))
    dealt = rows.join(partly, same).groupBy("source", "size", "extra", "bucket").agg(F.count("*").alias("m"))
    before = F.coalesce(F.sum("m").over(Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cut = (dealt.withColumn("before", before).filter("before < extra and before + m >= extra")
           .select(F.col("source").alias("of"), F.col("size").alias("len"), F.col("bucket").alias("last"),
                   (F.col("extra") - F.col("before")).alias("need")))
    planned = materialise(planned.join(cut, same, "left").select(
        F.col("source").alias("of"), F.col("size").alias("len"), "source_size", "target", "n", "whole", "extra", "last", "need"), "mix-cut", narrow=True)

    placed = rows.join(planned, same)
    edge = F.coalesce(F.col("bucket") == F.col("last"), F.lit(False))
    order = Window.partitionBy("source", "size").orderBy("h", "place")
    ranked = placed.filter(edge).withColumn("more", F.row_number().over(order) <= F.col("need"))
    plain = placed.filter(~edge).withColumn("more", (F.col("extra") == F.col("n")) | F.coalesce(F.col("bucket") < F.col("last"), F.lit(False)))
    more = F.when((F.col("extra") > 0) & F.col("more"), 1).otherwise(0)
    copies = F.when(F.col("size") == 0, 0).otherwise(F.col("whole") + more)
    return (plain.unionByName(ranked).withColumn("copies", copies)
            .select(F.col("id").alias(id_col), "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")))
