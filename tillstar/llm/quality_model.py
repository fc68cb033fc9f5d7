"""Quality scores learnt from preference pairs (Bradley-Terry), with a threshold at a score quantile.

A document is preferred to another when its label is better. The chance that i is preferred
to j is the logistic function of w (f_i - f_j); w is fitted by minimising the logistic loss on
the differences of the pairs (Newton steps, ridge penalty). The decision threshold is the
quantile of the labelled rows' scores at their share of worse documents.

Every labelled row that is not held out is learnt from. Up to ``max_local`` of them are fitted on the driver, with
seeded pairs; more stay distributed: rows are dealt to buckets by a hash of their id, all pairs of a bucket count, and each
Newton step is one pass in which every task sends one row of sums. Every document is scored, in one pass without a shuffle.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.shingles import slices
from tillstar.llm.storage import materialise

FEATURES = ("length", "word_length", "short_words", "distinct_words", "capitals", "symbols", "exclamations", "bars",
            "digits", "repeated_lines", "commonest_word", "commas", "stops", "echoes", "lines", "long_words", "empty")
MAX_LOCAL, PAIRS_PER_WORSE = 20_000, 20
RIDGE, STEPS = 1e-3, 25
BINS, MAX_COLLECTED = 1024, 10_000  # of a search for the value of a rank
CUT = 0.3  # the score that stands for the threshold


def features(text: str | None) -> list[float]:
    """Shares and rates of one whole text, each within a bounded range; a text without words has its own mark."""
    words = text.split() if text else []
    if not words:
        return [0.0] * (len(FEATURES) - 1) + [1.0]
    n, chars = len(words), len(text)
    counts = Counter(words)
    lengths = list(map(len, words))
    lines = text.split("\n")
    rate = lambda k: min(1.0, k / n)
    return [np.log1p(n) / 10, min(2.0, sum(lengths) / n / 10), sum(x <= 3 for x in lengths) / n, len(counts) / n,
            sum(map(str.isupper, words)) / n, rate(sum(map(text.count, "#*$%&"))), rate(text.count("!")), rate(text.count("|")),
            min(1.0, sum(map(text.count, "0123456789")) / chars), 1 - len(set(lines)) / len(lines),
            max(counts.values()) / n, rate(text.count(",")), rate(text.count(".")),
            sum(a == b for a, b in zip(words, words[1:])) / n, rate(len(lines) - 1), sum(x >= 12 for x in lengths) / n, 0.0]


def _featured(docs: DataFrame) -> DataFrame:
    def run(batches):
        for batch in slices(batches, 1):
            rows = [features(t) for t in batch.column(1).to_pylist()]
            flat = pa.array(np.array(rows, float).ravel())
            offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, flat)], names=["id", "f"])

    return docs.mapInArrow(run, "id long, f array<double>")


def _newton(evaluate: Callable[[np.ndarray], tuple[float, np.ndarray, np.ndarray]], size: int, ridge: float, steps: int) -> np.ndarray:
    """Weights that minimise a mean loss plus a ridge penalty; ``evaluate(w)``: the mean loss, its slope and its bend."""
    w = np.zeros(size)
    at = evaluate(w)
    for _ in range(steps):
        step, length = np.linalg.solve(at[2] + ridge * np.eye(size), at[1] + ridge * w), 1.0
        while True:
            new = w - length * step
            there = evaluate(new)
            if length <= 1e-4 or there[0] + ridge / 2 * new @ new <= at[0] + ridge / 2 * w @ w:
                break
            length /= 2
        w, at = new, there
        if np.abs(step).max() < 1e-6:
            break
    return w


def _pair_sums(d: np.ndarray, weight: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Weight, loss, slope and bend of differences (better - worse), summed, in one row."""
    margin = np.clip(d @ w, -500, 500)
    p = 1 / (1 + np.exp(margin))  # chance of the wrong order
    bend = (d * (weight * p * (1 - p))[:, None]).T @ d
    return np.concatenate([[weight.sum(), weight @ np.logaddexp(0, -margin)], -(d.T @ (weight * p)), bend.ravel()])


def _means(sums: np.ndarray, size: int) -> tuple[float, np.ndarray, np.ndarray]:
    sums = sums / sums[0]
    return sums[1], sums[2:2 + size], sums[2 + size:].reshape(size, size)


def fit_preferences(better: np.ndarray, worse: np.ndarray, pairs_per_worse: int = PAIRS_PER_WORSE, ridge: float = RIDGE,
                    steps: int = STEPS, seed: int = 4) -> np.ndarray:
    """Weights w that minimise the mean of log(1 + exp(-w (better - worse))) over seeded pairs, plus a ridge penalty."""
    rng = np.random.default_rng(seed)
    d = better[rng.integers(len(better), size=len(worse) * pairs_per_worse)] - np.repeat(worse, pairs_per_worse, axis=0)
    one = np.ones(len(d))
    return _newton(lambda w: _means(_pair_sums(d, one, w), d.shape[1]), d.shape[1], ridge, steps)


@dataclass
class PreferenceModel:
    """Standardised linear scores, moved so that ``threshold`` becomes the score ``CUT``."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    @classmethod
    def fit(cls, x: np.ndarray, label: np.ndarray) -> PreferenceModel:
        """Fit on the rows given; without both labels there is no pair, and every score is that of the label seen."""
        size = x.shape[1] if x.ndim == 2 else len(FEATURES)
        if not (label == 1).any() or not (label == 0).any():
            seen = 1.0 if (label == 1).any() or not len(label) else -1.0
            return cls(np.zeros(size), np.ones(size), np.zeros(size), -seen)
        mean, scale = x.mean(axis=0), x.std(axis=0)
        scale[scale < 1e-9] = 1.0
        z = (x - mean) / scale
        w = fit_preferences(z[label == 1], z[label == 0])
        return cls(mean, scale, w, float(np.quantile(z @ w, (label == 0).mean())))

    def score(self, x: np.ndarray) -> np.ndarray:
        s = ((x - self.mean) / self.scale) @ self.weights - self.threshold
        return 1 / (1 + np.exp(-np.clip(s, -30, 30)) * (1 - CUT) / CUT)


def held_out(id_col: str):
    """Whether crc32 of the id's text is divisible by 5: such rows are never learnt from. Rows without id are not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _total(rows: DataFrame, of: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """The sum of ``of`` over all batches; each task sends one row."""
    def run(batches):
        total = None
        for batch in batches:
            total = of(batch) if total is None else total + of(batch)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["s"])

    return np.sum([r["s"] for r in rows.mapInArrow(run, "s array<double>").collect()], axis=0)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))


def _buckets(learnt: DataFrame, n_better: int, n_worse: int) -> DataFrame:
    """The labelled rows dealt to buckets by their ids, about ``PAIRS_PER_WORSE`` of either label in each: the features of better and of worse
    rows one after the other, and how often each row occurs. Rows of the rarer label are dealt several times, so that all rows meet others."""
    more, fewer = max(n_better, n_worse), min(n_better, n_worse)
    rarer = 1 if n_better < n_worse else 0
    times = F.when(F.col("label") == rarer, -(-more // fewer)).otherwise(1)
    dealt = learnt.groupBy("id", "label", "f").agg(F.count(F.lit(1)).cast("double").alias("n")).withColumn("turn", F.explode(F.sequence(F.lit(1), times)))
    bucket = F.pmod(F.xxhash64("id", "turn"), F.lit(max(1, more // PAIRS_PER_WORSE)))
    of = lambda label, c: F.collect_list(F.when(F.col("label") == label, F.col(c)))
    return dealt.groupBy(bucket.alias("bucket")).agg(
        F.flatten(of(1, "f")).alias("better"), of(1, "n").alias("n_better"), F.flatten(of(0, "f")).alias("worse"), of(0, "n").alias("n_worse")).drop("bucket")


def value_of_rank(values: DataFrame, name: str, rank: int) -> float:
    """The value at a rank (from 0) among all values in ascending order: the range is narrowed by counts until few are left."""
    lo, hi = values.agg(F.min(name), F.max(name)).first()
    below = 0
    while lo < hi:
        inside = values.filter(F.col(name).between(lo, hi))
        cell = F.least(F.floor((F.col(name) - lo) / F.lit(hi - lo) * BINS), F.lit(BINS - 1))
        cells = sorted(inside.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"), F.min(name).alias("lo"), F.max(name).alias("hi")).collect())
        for r in cells:
            if rank < below + r["n"]:
                break
            below += r["n"]
        lo, hi = r["lo"], r["hi"]
        if lo < hi and r["n"] <= MAX_COLLECTED:
            return sorted(x[0] for x in values.filter(F.col(name).between(lo, hi)).select(name).collect())[rank - below]
    return lo


def fit_distributed(learnt: DataFrame, n_better: int, n_worse: int) -> PreferenceModel:
    """The model of any number of rows (id, label, f), both labels among them."""
    size, n = len(FEATURES), n_better + n_worse
    mean = _total(learnt, lambda batch: _matrix(batch.column("f")).sum(axis=0)) / n
    scale = np.sqrt(_total(learnt, lambda batch: ((_matrix(batch.column("f")) - mean) ** 2).sum(axis=0)) / n)
    scale[scale < 1e-9] = 1.0
    buckets = materialise(_buckets(learnt, n_better, n_worse), "preference-buckets", narrow=True)

    def evaluate(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        def of(batch: pa.RecordBatch) -> np.ndarray:
            total = np.zeros(2 + size + size * size)
            for row in zip(*(batch.column(c) for c in ("better", "n_better", "worse", "n_worse"))):
                better, n_b, worse, n_w = (x.values.to_numpy(zero_copy_only=False) for x in row)
                if len(n_b) and len(n_w):
                    d = (better.reshape(-1, 1, size) - worse.reshape(1, -1, size)).reshape(-1, size) / scale
                    total += _pair_sums(d, np.outer(n_b, n_w).ravel(), w)
            return total

        return _means(_total(buckets, of), size)

    w = _newton(evaluate, size, RIDGE, STEPS)

    def scores(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(((_matrix(batch.column("f")) - mean) / scale) @ w)], names=["s"])

    scored = materialise(learnt.mapInArrow(scores, "s double"), "preference-scores")
    at = (n - 1) * (n_worse / n)
    low = value_of_rank(scored, "s", int(at))
    high = value_of_rank(scored, "s", min(int(at) + 1, n - 1))
    return PreferenceModel(mean, scale, w, float(low + (high - low) * (at - int(at))))


def train(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, max_local: int = MAX_LOCAL) -> PreferenceModel:
    """A model from all labelled rows that are not held out; more than ``max_local`` of them stay distributed. Texts become numbers before the join."""
    labels = (labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label"))
              .filter(~held_out("id") & F.col("id").isNotNull() & F.col("label").isin(0, 1)))
    known = labels.groupBy("id").agg(F.min("label").alias("label"))
    texts = docs.select("id", "text").filter(F.col("id").isNotNull() & ~held_out("id"))
    learnt = materialise(_featured(texts).join(known, "id").select("id", "label", "f"), "labelled", narrow=True)
    n = {r["label"]: r["count"] for r in learnt.groupBy("label").count().collect()}
    if len(n) == 2 and sum(n.values()) > max_local:
        return fit_distributed(learnt, n[1], n[0])
    # With one label only there is nothing to fit: a row of it tells which.
    rows = (learnt if len(n) == 2 else learnt.limit(1)).toPandas().sort_values("id", kind="stable")
    x = np.array(rows["f"].tolist(), float).reshape(len(rows), len(FEATURES))
    return PreferenceModel.fit(x, rows["label"].to_numpy())


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "quality", max_local: int = MAX_LOCAL) -> DataFrame:
    """One row per row of ``docs``: id, held_out, score (0 to 1, higher: better), predicted (1 if score >= 0.3).

    Only the text is scored. Null and empty texts have the mark of no words, so their score is
    learnt as well. Texts of any length are scored whole, a few megabytes of text at a time. Repeated rows get equal scores, each its
    own row (equal ids with a label are all learnt from). Labels that are null or not 0 or 1 are ignored, of repeated labels the worst
    counts; without labels all documents count as good. Extra columns are ignored, whatever their names; empty documents give an empty result.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    model = train(docs, labels.withColumnRenamed(id_col, "id"), "id", "text", label_col, max_local)

    def run(batches):
        for batch in slices(batches, 1):
            scores = model.score(np.array([features(t) for t in batch.column(1).to_pylist()], float))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=["id", "score"])

    out = docs.mapInArrow(run, "id long, score double").select(F.col("id").alias(id_col), held_out("id").alias("held_out"), "score")
    return out.withColumn("predicted", (F.col("score") >= CUT).cast("int"))
