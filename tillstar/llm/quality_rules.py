"""Quality rules with host verdicts.

Each document is measured once (one pass in Python over Arrow batches). Rule failures are
then summed by host, each host's failure rate is shrunk towards the corpus by an
empirical beta prior fitted to all hosts (method of moments), and a host whose shrunk
rate of any rule exceeds ``max_rate`` is rejected with all its documents.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar.llm.shingles import slices
from tillstar.llm.storage import materialise

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"
WINDOW = 3
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

#: name -> failure as SQL over the measures. The first two reject a document by themselves; all count against its host.
BASE_RULES = {"few_words": "n_words < 50", "repetition": "100 * n_repeat_words > 50 * n_words"}
HOST_RULES = {**BASE_RULES, "symbols": "10 * n_symbols > n_words AND n_symbols > 0", "dup_lines": "n_dup_lines > 20"}

MAX_STRENGTH = 1e6  # of the prior, in documents: hosts whose rates differ by chance alone


def repeated_window_words(words: Sequence, width: int = WINDOW) -> int:
    """Words that lie in a window of ``width`` words found at least twice in the sequence, the first included."""
    windows = list(zip(*(words[i:] for i in range(width))))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    covered = end = 0
    for at, window in enumerate(windows):
        if counts[window] > 1:
            covered += at + width - max(at, end)
            end = at + width
    return covered


def measure(text: str | None) -> tuple[int, int, int, int, int]:
    """The measures of one whole text; null and empty texts give zeros. Words stand between ASCII white space."""
    if not text:
        return 0, 0, 0, 0, 0
    words = text.encode().split()
    seen, dup_lines = set(), 0
    for line in text.split("\n"):
        if line in seen:
            dup_lines += 1
        elif line.strip(SPACES):
            seen.add(line)
    return (len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), dup_lines,
            repeated_window_words(words))


def measured(docs: DataFrame, text_col: str, keep_text: bool) -> DataFrame:
    """``docs`` with the measures and one boolean per rule (``fails_<rule>``) added; its columns are kept, the text if asked."""
    at = docs.columns.index(text_col)
    kept = [i for i in range(len(docs.columns)) if keep_text or i != at]

    def run(batches):
        for batch in slices(batches, at):
            columns = zip(*map(measure, batch.column(at).to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in kept), *(pa.array(c, pa.int64()) for c in columns)],
                names=[*(batch.schema.names[i] for i in kept), *MEASURES])

    fields = [docs.schema.fields[i] for i in kept] + [T.StructField(m, T.LongType()) for m in MEASURES]
    out = docs.mapInArrow(run, T.StructType(fields))
    return out.select("*", *[F.expr(rule).alias(f"fails_{name}") for name, rule in HOST_RULES.items()])


def host_verdicts(rows: DataFrame, max_rate: float) -> DataFrame:
    """(host, host_docs, host_rejected) from measured rows with a ``host`` column. The null host is a host of its own.

    For each rule, hosts' rates k / n are taken as draws from a beta distribution with mean
    m and strength s, fitted to the spread of all hosts; the shrunk rate is (k + m s) / (n + s).
    """
    hosts = materialise(rows.groupBy("host").agg(
        F.count("*").alias("n"), *[F.sum(F.col(f"fails_{r}").cast("long")).alias(r) for r in HOST_RULES]), "hosts", narrow=True)
    sums = hosts.agg(F.count("*").alias("hosts"), F.sum("n").alias("docs"),
                     *[F.sum(r).alias(r) for r in HOST_RULES],
                     *[F.sum(F.col(r) * F.col(r) / F.col("n")).alias(f"{r}_sq") for r in HOST_RULES]).first()
    rejected: Column = F.lit(False)
    for r in HOST_RULES:
        mean, strength = beta_prior(sums["hosts"], sums["docs"], sums[r], sums[f"{r}_sq"])
        rejected = rejected | ((F.col(r) + mean * strength) / (F.col("n") + strength) > max_rate)
    return hosts.select("host", F.col("n").alias("host_docs"), rejected.alias("host_rejected"))


def beta_prior(hosts: int, docs: int | None, fails: int | None, squares: float | None) -> tuple[float, float]:
    """Mean and strength from the number of hosts and documents, sum of k and sum of k * k / n over hosts."""
    if not docs or not fails or fails == docs:
        return (1.0 if docs and fails else 0.0), 1.0
    mean = fails / docs
    spread = (squares / docs - mean * mean) / (mean * (1 - mean))  # 1: hosts are all or nothing; hosts / docs: chance alone
    chance = hosts / docs
    if spread <= chance:
        return mean, MAX_STRENGTH
    return mean, min(MAX_STRENGTH, max(0.0, (1 - spread) / (spread - chance)))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                  max_rate: float = 0.5, carry: Sequence[str] = ()) -> DataFrame:
    """One row per row of ``docs``: id, measures, ``fails_*``, base_failed, host_docs, host_rejected, kept.

    ``carry`` names further columns to keep, under their own names; all others are dropped, so
    names cannot clash. Null and empty texts have zero words and fail; repeated rows are
    judged alike; ids may be null. An empty table gives an empty result.

    The measured rows are written once to the shared folder and read by both the host sums and
    the join. Host sums are pre-aggregated in each task; the join with the host table is left to
    Spark, which broadcasts that table only when its files are small and otherwise splits a hot host.
    """
    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.col(host_col).alias("host"),
                       F.col(id_col).alias("id"), *[F.col(c).alias(f"carry_{c}") for c in carry if c not in (id_col, text_col)])
    rows = materialise(measured(rows, "text", text_col in carry), "measured")
    hosts = host_verdicts(rows, max_rate)
    base_failed = F.lit(False)
    for r in BASE_RULES:
        base_failed = base_failed | F.col(f"fails_{r}")
    out = rows.join(hosts.withColumnRenamed("host", "of"), F.col("host").eqNullSafe(F.col("of")))
    kept = {c: F.col("id" if c == id_col else "text" if c == text_col else f"carry_{c}").alias(c) for c in (id_col, *carry)}
    return out.select(*kept.values(),
                      *MEASURES, *[f"fails_{r}" for r in HOST_RULES], base_failed.alias("base_failed"),
                      "host_docs", "host_rejected", (~base_failed & ~F.col("host_rejected")).alias("kept"))
