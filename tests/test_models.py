import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from ticketgrain.operators import features, models


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(240, 3))
    y = (x @ rng.normal(size=(3, 3)) + rng.normal(size=(240, 3))).argmax(axis=1)
    y[:150][y[:150] == 2] = 0  # unbalanced
    data = [(float(label), Vectors.dense(row)) for row, label in zip(x, y)]
    return x, y, spark.createDataFrame(data, ["label", "features"]).repartition(3)


@pytest.mark.parametrize("balanced", [False, True])
def test_optimum_of_the_penalised_loss(points, balanced):
    """The gradient of |W|^2/2 + C * sum(weight * loss) is zero at the fit."""
    x, y, data = points
    model = models.fit_logistic_regression(data, c=0.7, balanced=balanced)
    w, b = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    counts = np.bincount(y)
    weight = (len(y) / (len(counts) * counts))[y] if balanced else np.ones(len(y))
    logits = x @ w.T + b
    p = np.exp(logits - logits.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    error = (p - np.eye(3)[y]) * weight[:, None]
    gradient = w + 0.7 * error.T @ x
    assert np.abs(gradient).max() < 0.05
    assert np.abs(error.sum(axis=0)).max() < 0.05  # intercepts are not penalised
    predicted = models.predict(model, data).select("features", "predicted").collect()
    for row in predicted[:50]:
        assert row["predicted"] == float(np.argmax(w @ row["features"].toArray() + b))


def test_fit_or_load_fits_once(spark, tmp_path):
    docs = spark.createDataFrame(
        [(i, "down error" if i % 2 else "thanks info", float(i % 2)) for i in range(20)],
        "id long, text string, label double",
    )
    calls = []

    def fit():
        calls.append(1)
        steps = features.fit_tfidf(docs, min_df=1).to_pipeline()
        return PipelineModel([*steps.stages, models.fit_logistic_regression(steps.transform(docs))])

    path = str(tmp_path / "model")
    first = models.predict(models.fit_or_load(spark, path, fit), docs)
    second = models.predict(models.fit_or_load(spark, path, fit), docs)
    assert calls == [1]
    assert all(r["predicted"] == r["label"] for r in first.collect())
    assert first.select("id", "predicted").exceptAll(second.select("id", "predicted")).count() == 0


def test_score_prompts(spark):
    samples = spark.createDataFrame(
        [(i, "do", f"text {i}", f"ref {i}") for i in range(9)], "k long, instruction string, input string, output string"
    )

    def make_predictor():
        return lambda prompts: " " + prompts.str.extract(r"user\n([^<]*)<", expand=False).str.upper() + " "

    got = models.score_prompts(samples.repartition(3), make_predictor, keep=("k",)).orderBy("k").collect()
    assert [tuple(r) for r in got[:2]] == [(0, "do", "text 0", "TEXT 0", "ref 0"), (1, "do", "text 1", "TEXT 1", "ref 1")]
    assert len(got) == 9


def test_training_key_and_log(spark, tmp_path):
    """Rows in any order have one key; other rows, columns or parameters have another, and no stale model is loaded."""
    data = spark.createDataFrame([(float(i % 2), Vectors.dense([float(i % 2), 1.0])) for i in range(40)], ["label", "features"])
    plain = spark.createDataFrame([(i % 7, f"t{i}") for i in range(50)], "label long, text string")
    key = models.training_key(plain, c=1.0)
    assert key == models.training_key(plain.repartition(3).orderBy("text"), c=1.0)
    others = [plain.filter("text <> 't3'"), plain.unionByName(plain.limit(1)), plain.withColumn("label", F.col("label") + 1), plain.limit(0)]
    keys = {models.training_key(other, c=1.0) for other in others} | {models.training_key(plain, c=2.0), key}
    assert len(keys) == 6
    log = models.training_log(spark, models.fit_logistic_regression(data)).orderBy("iteration").collect()
    assert [r.iteration for r in log] == list(range(len(log))) and log[-1].objective < log[0].objective

    def fit(c):
        return lambda: PipelineModel([models.fit_logistic_regression(data, c=c)])

    def refuse():
        raise AssertionError("fitted again")

    base = str(tmp_path / "models")
    first = models.fit_or_load(spark, base, fit(1.0), "one")
    again = models.fit_or_load(spark, base, refuse, "one")
    other = models.fit_or_load(spark, base, fit(0.01), "two")
    matrix = lambda m: m.stages[0].coefficientMatrix.toArray().tolist()
    assert matrix(first) == matrix(again) != matrix(other)
