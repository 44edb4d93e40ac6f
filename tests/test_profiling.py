import math
import random

import numpy as np

from tests.conftest import rows
from ticketgrain.operators import profiling


def sample(spark, n=997):
    rng = random.Random(3)
    values = [int(rng.lognormvariate(5, 1)) for _ in range(n)]
    return values, spark.createDataFrame([(v,) for v in values], "n_chars long")


def test_length_stats_equal_numpy(spark):
    values, data = sample(spark)
    row = profiling.length_stats(data, ["n_chars"]).first()
    expected = [
        np.min(values), np.max(values), np.mean(values), np.median(values), np.std(values),
        np.percentile(values, 25), np.percentile(values, 75),
    ]
    assert np.allclose(list(row)[1:], expected, rtol=1e-12)


def test_describe_equals_numpy(spark):
    values, data = sample(spark)
    row = profiling.describe(data, ["n_chars"]).first()
    assert row["count"] == len(values)
    assert math.isclose(row["std"], np.std(values, ddof=1), rel_tol=1e-12)
    assert math.isclose(row["p50"], np.median(values))
    assert profiling.describe(data.limit(1), ["n_chars"]).first()["std"] is None


def test_histogram_equals_numpy(spark):
    values, data = sample(spark)
    got = profiling.histogram(data, "n_chars", 50).orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=50)
    assert [r["n"] for r in got] == counts.tolist()
    assert np.allclose([r["bin_start"] for r in got], edges[:-1])
    single = profiling.histogram(spark.createDataFrame([(5,), (5,)], "n_chars long"), "n_chars", 50).collect()
    counts, _ = np.histogram([5, 5], bins=50)
    assert [r["n"] for r in sorted(single)] == counts.tolist()


def test_quality_profile(spark):
    data = spark.createDataFrame([("a",), ("a",), (" 　",), (None,), ("",), ("bcd",)], "text string")
    row = profiling.quality_profile(data).first()
    # '' and null are the same text
    assert (row["n_rows"], row["n_blank"], row["n_duplicates"]) == (6, 3, 2)
    assert (row["min_chars"], row["max_chars"]) == (0, 3)


def test_value_counts_drop_nulls_and_missing_columns(spark):
    data = spark.createDataFrame([("x", "p"), ("x", None), ("y", "p")], "queue string, type string")
    assert rows(profiling.value_counts(data, ["queue", "type", "priority"])) == [
        ("queue", "x", 2), ("queue", "y", 1), ("type", "p", 2),
    ]


def test_weights(spark):
    data = spark.createDataFrame([("a",)] * 6 + [("b",)] * 3 + [("c",)], "label string")
    assert {r["label"]: r["weight"] for r in profiling.class_weights(data, "label").collect()} == {
        "a": 10 / 18, "b": 10 / 9, "c": 10 / 3,
    }
    assert {r["label"]: r["weight"] for r in profiling.oversample_weights(data, "label").collect()} == {
        "a": 1.0, "b": 2.0, "c": 6.0,
    }
    grown = profiling.oversample(data, "label").groupBy("label").count()
    assert rows(grown) == [("a", 6), ("b", 6), ("c", 6)]


def test_distribution_and_profile(spark):
    data = spark.createDataFrame([("h", 10, 2), ("h", 20, 4), ("l", 5, 1)], "label string, n_chars long, n_words long")
    shares = {r["label"]: round(r["pct"], 3) for r in profiling.label_distribution(data, "label").collect()}
    assert shares == {"h": 66.667, "l": 33.333}
    profile = {r["label"]: tuple(r)[1:] for r in profiling.class_profile(data, "label").collect()}
    assert profile["h"][0] == 2 and profile["h"][2:] == (15.0, 3.0)


def test_epoch_metrics_average_batches_not_rows(spark):
    steps = spark.createDataFrame(
        [("e", 1, 0.5, 8, 10), ("e", 1, 1.5, 1, 2), ("e", 2, 1.0, 0, 0)],
        "exp string, epoch int, loss double, correct int, total int",
    )
    assert rows(profiling.epoch_metrics(steps)) == [("e", 1, 1.0, 0.75), ("e", 2, 1.0, 0.0)]


def test_words(spark):
    data = spark.createDataFrame([("A b a",), ("b C",), (None,)], "text string")
    assert [tuple(r) for r in profiling.top_words(data, k=2).collect()] == [("a", 2), ("b", 2)]
    assert tuple(profiling.vocabulary_size(data).first()) == (3, 5)


def test_first_scan_is_narrow(spark):
    """Only the needed columns are read."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = profiling.label_distribution(docs, "lang")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<lang:string>" in plan


def test_labelled_lengths(spark):
    docs = spark.createDataFrame([(1, "A b!"), (2, "me@x.y go"), (3, "zz")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, "h"), (2, "l")], "doc_id long, label string")
    found = profiling.labelled_lengths(docs, labels, "doc_id", "label")
    assert rows(found, "label", "n_chars", "n_words") == [("h", 3, 2), ("l", 2, 1)]
