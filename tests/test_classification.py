import pytest

from tests.conftest import rows
from ticketgrain.operators import classification as cl


def cells(spark, counts):
    return spark.createDataFrame([(t, p, n) for (t, p), n in counts.items()], "truth string, prediction string, n long")


# Counts that give the published per-class figures of the fine-tuning report:
# support 1615 / 855 / 1769, recall .7622 / .5977 / .8027.
REPORT = {
    ("high", "high"): 1231, ("low", "low"): 511, ("medium", "medium"): 1420,
    ("high", "medium"): 323, ("high", "low"): 61, ("low", "medium"): 267,
    ("low", "high"): 77, ("medium", "high"): 260, ("medium", "low"): 89,
}


def test_published_report(spark):
    data = cells(spark, REPORT)
    per_class = {r["label"]: r for r in cl.class_metrics(data).collect()}
    assert [round(per_class["high"][c], 4) for c in ("precision", "recall", "f1")] == [0.7851, 0.7622, 0.7735]
    assert [round(per_class["low"][c], 4) for c in ("precision", "recall", "f1")] == [0.7731, 0.5977, 0.6741]
    assert [round(per_class["medium"][c], 4) for c in ("precision", "recall", "f1")] == [0.7065, 0.8027, 0.7515]
    total = cl.summary_metrics(data).first()
    assert round(total["accuracy"], 4) == 0.7459
    assert round(total["f1_macro"], 4) == 0.7330
    assert round(total["f1_weighted"], 4) == 0.7443
    assert total["f1_micro"] == total["accuracy"] == cl.accuracy(data).first()[0]


def test_union_of_labels_and_zero_division(spark):
    data = cells(spark, {("a", "a"): 2, ("a", "c"): 1, ("b", "a"): 1})
    got = {r["label"]: (round(r["precision"], 4), round(r["recall"], 4), r["f1"], r["support"]) for r in cl.class_metrics(data).collect()}
    assert got == {
        "a": (0.6667, 0.6667, pytest.approx(2 / 3), 3), "b": (0.0, 0.0, 0.0, 1), "c": (0.0, 0.0, 0.0, 0),
    }
    assert cl.summary_metrics(data).first()["f1_macro"] == pytest.approx(2 / 9)
    report = {r["label"]: r["support"] for r in cl.class_report(data).collect()}
    assert report == {"a": 3, "b": 1, "c": 0, "accuracy": 4, "macro avg": 4, "weighted avg": 4}


def test_matrix_views(spark):
    data = cells(spark, {("a", "a"): 2, ("b", "a"): 1})
    labels = ["a", "b"]
    assert rows(cl.dense_confusion(data, labels)) == [("a", "a", 2), ("a", "b", 0), ("b", "a", 1), ("b", "b", 0)]
    assert rows(cl.confusion_matrix(data, labels), "truth", "a", "b") == [("a", 2, 0), ("b", 1, 0)]


def test_published_row_percentages(spark):
    shares = {("high", "high"): 622, ("high", "medium"): 293, ("high", "low"): 85}
    got = {(r["truth"], r["prediction"]): r["pct"] for r in cl.confusion_percent(cells(spark, shares)).collect()}
    assert got == {("high", "high"): 62.2, ("high", "medium"): 29.3, ("high", "low"): 8.5}


def test_gap_to_random(spark):
    row = cl.random_gap(cells(spark, {("a", "a"): 3, ("b", "a"): 1})).first()
    assert tuple(row) == (0.75, 0.5, 0.25)
