"""Comparing evaluated models.

Model table: model, family, position (order inside the family) and the averaged
metrics; a family is a set of runs compared with each other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketgrain.functions import fixed_values as V
from ticketgrain.functions import naming

COMPARED = ("avg_rouge1_f", "avg_rouge2_f", "avg_rougeL_f", "avg_bleu", "priority_accuracy", "type_accuracy")
ACCURACIES = ("type_accuracy", "priority_accuracy", "queue_accuracy")


def _or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0.0))


def name_facts(models: DataFrame, name: str = "model") -> DataFrame:
    col = F.col(name)
    return models.select(
        name,
        naming.rank_of(col).alias("rank"),
        naming.kind_of(col).alias("kind"),
        naming.parameter_of(col).alias("parameter"),
    )


def comparison_table(models: DataFrame) -> DataFrame:
    """Kind, parameter and metrics per model; a missing metric is 0."""
    col = F.col("model")
    return models.select(
        "model",
        naming.kind_of(col).alias("kind"),
        naming.parameter_of(col).alias("parameter"),
        *[_or_zero(m).alias(m) for m in COMPARED],
    )


def kind_groups(models: DataFrame) -> DataFrame:
    """Models per experiment kind with their mean ROUGE-L."""
    return (
        comparison_table(models)
        .groupBy("kind")
        .agg(F.count(F.lit(1)).alias("models"), F.avg("avg_rougeL_f").alias("mean_rougeL"))
        .orderBy("kind")
    )


def mean_accuracy(models: DataFrame) -> DataFrame:
    mean = sum((_or_zero(a) for a in ACCURACIES), F.lit(0.0)) / 3
    return models.select(
        "model", naming.rank_of(F.col("model")).alias("rank"), *[_or_zero(a).alias(a) for a in ACCURACIES],
        mean.alias("mean_accuracy"),
    )


def rank_gain(models: DataFrame, metric: str = "avg_rougeL_f") -> DataFrame:
    """Change of the rank variants against the next smaller rank of the family, in percent and in points.

    Other kinds of runs are left out.  Windows run inside a family, whose rows are its few compared ranks.
    """
    variants = models.filter(naming.kind_of(F.col("model")) == "lora_rank")
    ranked = variants.withColumn("rank", naming.rank_of(F.col("model")))
    before = F.lag(metric).over(Window.partitionBy("family").orderBy("rank", "position"))
    return ranked.select(
        "family",
        "rank",
        "model",
        F.col(metric).alias("value"),
        (F.try_divide(F.col(metric) - before, before) * 100).alias("gain_pct"),
        ((F.col(metric) - before) * 100).alias("gain_points"),
    )


def baseline_gain(models: DataFrame, metric: str = "avg_rougeL_f", baseline_rank: int = 16) -> DataFrame:
    """Percent over the latest baseline row seen earlier in order, null for none (or a zero one)."""
    rank = naming.rank_of(F.col("model"))
    ranked = models.withColumns({"rank": rank, "_value": _or_zero(metric)})
    upto = (
        Window.partitionBy("family")
        .orderBy("position")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    base = F.last(F.when(F.col("rank") == baseline_rank, F.col("_value")), ignorenulls=True).over(upto)
    gain = F.try_divide((F.col("_value") - base) * 100, base)
    return ranked.withColumn("_base", base).select(
        "family",
        "model",
        "rank",
        F.col("_value").alias("value"),
        F.when(F.col("rank") != baseline_rank, gain).alias("gain_pct"),
    )


def unpivot_metrics(models: DataFrame, keys: Sequence[str], metrics: Sequence[str], name: str) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias(name)) for m in metrics])
    return models.select(*keys, F.inline(rows)).filter(F.col(name).isNotNull())


def improvement(base: Column, tuned: Column) -> Column:
    """Percent change; null when the base is 0."""
    return F.try_divide((tuned - base) * 100, base)


def compare_pair(
    base: DataFrame, tuned: DataFrame, metrics: Sequence[str], keys: Sequence[str] = ()
) -> DataFrame:
    """Two evaluations side by side per metric; a metric missing on one side is 0."""
    left = unpivot_metrics(base, keys, metrics, "base")
    right = unpivot_metrics(tuned, keys, metrics, "tuned")
    both = left.join(right, [*keys, "metric"], "full_outer")
    sides = both.select(*keys, "metric", _or_zero("base").alias("base"), _or_zero("tuned").alias("tuned"))
    return sides.withColumn("improvement_pct", improvement(F.col("base"), F.col("tuned")))


def verdicts(pairs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Did tuning help: any accuracy up and any of ROUGE-1/L up."""
    up = F.col("tuned") > F.col("base")
    classes = F.coalesce(F.bool_or(up & F.col("metric").isin(*ACCURACIES)), F.lit(False))
    texts = F.coalesce(F.bool_or(up & F.col("metric").isin("avg_rouge1_f", "avg_rougeL_f")), F.lit(False))
    flags = pairs.groupBy(*keys).agg(classes.alias("_classes"), texts.alias("_texts"))
    verdict = (
        F.when(F.col("_classes") & F.col("_texts"), "effective")
        .when(F.col("_classes"), "partial")
        .otherwise("not effective")
    )
    return flags.select(
        *keys,
        F.col("_classes").alias("classification_improved"),
        F.col("_texts").alias("generation_improved"),
        verdict.alias("verdict"),
    )


def advice(pairs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A row per metric of the tuned model that stays under its threshold."""
    threshold = F.coalesce(*[F.when(F.col("metric") == m, F.lit(t)) for m, t, _ in V.ADVICE])
    hint = F.coalesce(*[F.when(F.col("metric") == m, F.lit(h)) for m, _, h in V.ADVICE])
    return pairs.filter(F.col("tuned") < threshold).select(*keys, "metric", "tuned", hint.alias("advice"))


def best_model(models: DataFrame, metric: str, k: int = 1) -> DataFrame:
    """First model with the highest metric (missing = 0) in table order."""
    return models.orderBy(F.desc(_or_zero(metric)), "position", "model").limit(k)


def targets(model: DataFrame) -> DataFrame:
    """Goal, value and whether it is met, per goal metric, for the given model rows."""
    rows = F.array(
        *[
            F.struct(F.lit(m).alias("metric"), F.lit(goal).alias("target"), _or_zero(m).alias("actual"))
            for m, goal in V.TARGETS
        ]
    )
    return model.select("model", F.inline(rows)).withColumn("achieved", F.col("actual") >= F.col("target"))


def weighted_score(models: DataFrame) -> DataFrame:
    """Quarter each of the three accuracies and ROUGE-L."""
    parts = [_or_zero(c) for c in (*ACCURACIES, "avg_rougeL_f")]
    return models.select("model", sum((0.25 * p for p in parts), F.lit(0.0)).alias("score"))


def best_per_metric(models: DataFrame, metrics: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Highest value of each metric and the (alphabetically first) model that has it."""
    rows = unpivot_metrics(models, [*keys, "model"], metrics, "value")
    # highest value first, then the name: one aggregation finds both
    winner = F.min(F.struct((-F.col("value")).alias("_minus"), F.col("model")))
    best = rows.groupBy(*keys, "metric").agg(winner.alias("_w"))
    return best.select(*keys, "metric", (-F.col("_w._minus")).alias("best"), F.col("_w.model").alias("model"))


def model_ranking(models: DataFrame, metric: str, keys: Sequence[str] = ("family",)) -> DataFrame:
    """1st, 2nd, 3rd ... inside a family by metric, ties by name."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(metric), "model")).cast("long")
    return models.select(*keys, "model", F.col(metric).alias("value"), place.alias("place"))
