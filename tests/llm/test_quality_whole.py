"""The quality model learns from every labelled row, on the driver or distributed."""

import numpy as np
from pyspark.sql import functions as F

from tillstar.llm import quality_model as qm


def _corpus(spark, n=1500):
    rng = np.random.default_rng(5)
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.8
        words = rng.choice(["Plain", "text", "of", "several", "different", "words", "written", "well", "enough", "here"] if good else ["buy", "!!!", "$$$", "now"], size=30)
        rows.append((i, " ".join(words) + ("." if rng.random() < 0.9 else "")))
        labels.append((i, int(good if rng.random() < 0.95 else not good)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_distributed_fit_uses_all_rows_and_agrees(spark):
    docs, labels = _corpus(spark)
    d = docs.select(F.col("doc_id").alias("id"), "text")
    learnt = d.join(labels.withColumnRenamed("doc_id", "id"), "id").filter(~qm.held_out("id")).collect()
    x, y = np.array([qm.features(r.text) for r in learnt]), np.array([r.quality for r in learnt])
    model = qm.train(d, labels.withColumnRenamed("doc_id", "id"), "id", "text", "quality", max_local=0)
    scale = np.where(x.std(axis=0) < 1e-9, 1, x.std(axis=0))
    assert np.allclose(model.mean, x.mean(axis=0)) and np.allclose(model.scale, scale)
    assert np.isclose(model.threshold, np.quantile((x - model.mean) / model.scale @ model.weights, (y == 0).mean()))
    local = qm.PreferenceModel.fit(x, y)
    assert np.mean((model.score(x) >= qm.CUT) == (local.score(x) >= qm.CUT)) > 0.97
    assert np.corrcoef(model.score(x), local.score(x))[0, 1] > 0.98


def test_labels_beyond_any_number_still_count(spark):
    docs, labels = _corpus(spark, 400)
    flipped = labels.withColumn("quality", F.when(F.col("doc_id") >= 200, 1 - F.col("quality")).otherwise(F.col("quality")))
    one, other = (qm.quality_scores(docs, x, max_local=10).agg(F.sum("score")).first()[0] for x in (labels, flipped))
    assert abs(one - other) > 1


def test_value_of_rank(spark, monkeypatch):
    monkeypatch.setattr(qm, "MAX_COLLECTED", 3)
    monkeypatch.setattr(qm, "BINS", 4)
    values = [1.0, 1.0, 1.0, 1.0, 1.0, 2.0, 2.5, 2.5001, 7.0, 1e9, -3.0]
    df = spark.createDataFrame([(v,) for v in values], "s double")
    assert [qm.value_of_rank(df, "s", k) for k in range(len(values))] == sorted(values)
