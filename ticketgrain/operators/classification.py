"""Classifier measures, all derived from one (truth, prediction, n) table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def confusion_counts(df: DataFrame, truth: str = "truth", prediction: str = "prediction") -> DataFrame:
    """Non-zero cells of the confusion matrix.

    Every measure below starts here: rows are pre-aggregated on the map side, so
    what moves is the number of label pairs, however large one class is.
    """
    return df.groupBy(F.col(truth).alias("truth"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def accuracy(cells: DataFrame) -> DataFrame:
    hits = F.sum(F.when(F.col("truth") == F.col("prediction"), F.col("n")).otherwise(0))
    return cells.agg(F.try_divide(hits, F.sum("n")).alias("accuracy"))


def _safe(numerator, denominator):
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(0.0))


def class_metrics(cells: DataFrame) -> DataFrame:
    """label, precision, recall, f1, support over the union of true and predicted labels."""
    hit = F.col("truth") == F.col("prediction")
    entries = F.array(
        F.struct(
            F.col("truth").alias("label"),
            F.col("n").alias("support"),
            F.lit(0).cast("long").alias("predicted"),
            F.when(hit, F.col("n")).otherwise(F.lit(0)).alias("tp"),
        ),
        F.struct(
            F.col("prediction").alias("label"),
            F.lit(0).cast("long").alias("support"),
            F.col("n").alias("predicted"),
            F.lit(0).cast("long").alias("tp"),
        ),
    )
    totals = (
        cells.select(F.inline(entries))
        .groupBy("label")
        .agg(F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("tp").alias("tp"))
    )
    return totals.select(
        "label",
        _safe(F.col("tp"), F.col("predicted")).alias("precision"),
        _safe(F.col("tp"), F.col("support")).alias("recall"),
        # 2PR/(P+R) written on counts
        _safe(2 * F.col("tp"), F.col("predicted") + F.col("support")).alias("f1"),
        "support",
        "tp",
    )


def summary_metrics(cells: DataFrame) -> DataFrame:
    """One row: accuracy, macro, micro and weighted F1, macro precision and recall."""
    weighted = F.try_divide(F.sum(F.col("f1") * F.col("support")), F.sum("support"))
    share = F.try_divide(F.sum("tp"), F.sum("support"))
    return class_metrics(cells).agg(
        share.alias("accuracy"),
        F.avg("f1").alias("f1_macro"),
        share.alias("f1_micro"),
        weighted.alias("f1_weighted"),
        F.avg("precision").alias("precision_macro"),
        F.avg("recall").alias("recall_macro"),
    )


def class_report(cells: DataFrame) -> DataFrame:
    """Per-class rows plus accuracy, macro avg and weighted avg rows."""
    per_class = class_metrics(cells)
    support = F.sum("support")

    def averaged(name: str, mean) -> DataFrame:
        return per_class.agg(
            F.lit(name).alias("label"),
            mean("precision").alias("precision"),
            mean("recall").alias("recall"),
            mean("f1").alias("f1"),
            support.alias("support"),
        )

    share = F.try_divide(F.sum("tp"), support)
    overall = averaged("accuracy", lambda _: share)
    macro = averaged("macro avg", F.avg)
    weighted = averaged(
        "weighted avg", lambda c: F.try_divide(F.sum(F.col(c) * F.col("support")), F.sum("support"))
    )
    rows = per_class.select(F.col("label").cast("string"), "precision", "recall", "f1", "support")
    return rows.unionByName(overall).unionByName(macro).unionByName(weighted)


def dense_confusion(cells: DataFrame, labels: list[str]) -> DataFrame:
    """Every cell of the matrix over the given labels, zeros included.

    The matrix is label count squared by definition, so the caller states the
    label domain; ``confusion_counts`` is the form for any number of labels.
    """
    pairs = F.array(*[F.struct(F.lit(a).alias("truth"), F.lit(b).alias("prediction")) for a in labels for b in labels])
    grid = cells.sparkSession.range(1).select(F.inline(pairs))
    return grid.join(cells, ["truth", "prediction"], "left").select(
        "truth", "prediction", F.coalesce("n", F.lit(0)).alias("n")
    )


def confusion_matrix(cells: DataFrame, labels: list[str]) -> DataFrame:
    """Pivoted view: a row per true label, a column per predicted label."""
    return (
        dense_confusion(cells, labels).groupBy("truth").pivot("prediction", labels).agg(F.sum("n"))
    )


def confusion_percent(cells: DataFrame) -> DataFrame:
    """Each cell as a percentage of its true class."""
    per_truth = cells.groupBy("truth").agg(F.sum("n").alias("_total"))
    return cells.join(per_truth, "truth").select(
        "truth", "prediction", "n", (F.col("n") * 100.0 / F.col("_total")).alias("pct")
    )


def random_gap(cells: DataFrame) -> DataFrame:
    """Accuracy, the share a random guess over the true labels gets, and the gap."""
    hits = F.sum(F.when(F.col("truth") == F.col("prediction"), F.col("n")).otherwise(0))
    return cells.agg(
        F.try_divide(hits, F.sum("n")).alias("accuracy"),
        (1.0 / F.countDistinct("truth")).alias("random_accuracy"),
    ).withColumn("gap", F.col("accuracy") - F.col("random_accuracy"))


def field_accuracy(df: DataFrame, predicted: str = "predicted", expected: str = "expected") -> DataFrame:
    """Share of rows whose type, queue and priority agree; two nulls agree."""
    return df.agg(
        *[
            F.avg(F.col(f"{predicted}.{f}").eqNullSafe(F.col(f"{expected}.{f}")).cast("double")).alias(
                f"{f}_accuracy"
            )
            for f in ("type", "queue", "priority")
        ]
    )
