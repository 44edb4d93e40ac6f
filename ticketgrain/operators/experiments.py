"""Training-run analytics over a table of epochs.

Epoch table: exp, epoch, train_loss, train_acc, val_acc, val_f1_macro (unique per
exp and epoch).  Run table: exp, name, lr, frozen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketgrain.functions import fixed_values as V
from ticketgrain.operators.scaling import global_row_number

CURVE_METRICS = ("train_loss", "train_acc", "val_acc", "val_f1_macro")


def explode_epochs(runs: DataFrame) -> DataFrame:
    """Flat epoch rows of nested run records (config struct, epochs array)."""
    return runs.select(F.col("config.name").alias("exp"), F.inline("epochs"))


def best_and_last(epochs: DataFrame) -> DataFrame:
    """Per run: best validation F1 (never below 0), epoch count, figures of the last epoch."""
    return epochs.groupBy("exp").agg(
        F.greatest(F.max("val_f1_macro"), F.lit(0.0)).alias("best_val_f1"),
        F.count(F.lit(1)).alias("epochs"),
        F.max("epoch").alias("last_epoch"),
        F.max_by("val_acc", "epoch").alias("final_val_acc"),
        F.max_by("train_acc", "epoch").alias("final_train_acc"),
        F.max_by("train_loss", "epoch").alias("final_train_loss"),
    )


def best_so_far(epochs: DataFrame) -> DataFrame:
    """Flag epochs whose validation accuracy strictly beats all earlier ones of the run."""
    earlier = Window.partitionBy("exp").orderBy("epoch").rowsBetween(Window.unboundedPreceding, -1)
    previous = F.coalesce(F.max("val_acc").over(earlier), F.lit(0.0))
    return epochs.select("exp", "epoch", "val_acc", (F.col("val_acc") > previous).alias("is_best"))


def summarize(epochs: DataFrame, runs: DataFrame) -> DataFrame:
    """Run settings with best and last figures (one row per run on both sides).

    Both sides grow alike: sent whole to every task, the runs would take most of its memory.
    """
    return best_and_last(epochs).join(runs.hint("merge"), "exp")


def select_runs(runs: DataFrame, names: Sequence[str]) -> DataFrame:
    """Runs with exactly these names; an error when there is none."""
    chosen = runs.filter(F.col("name").isin(list(names)))
    if chosen.limit(1).count() == 0:
        raise ValueError(f"no run is named {list(names)}")
    return chosen


def unfrozen(summary: DataFrame) -> DataFrame:
    return summary.filter(~F.col("frozen"))


def rank_runs(summary: DataFrame) -> DataFrame:
    """Position by descending best F1; ties keep input (exp) order."""
    return global_row_number(summary, [F.desc("best_val_f1"), F.asc("exp")], "position")


def top_runs(summary: DataFrame, k: int = 3) -> DataFrame:
    return summary.orderBy(F.desc("best_val_f1"), "exp").limit(k)


def curves(epochs: DataFrame, metrics: Sequence[str] = CURVE_METRICS) -> DataFrame:
    """Long form: exp, epoch, metric, value."""
    pairs = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]
    return epochs.select("exp", "epoch", F.inline(F.array(*pairs)))


def top_curves(epochs: DataFrame, summary: DataFrame, k: int = 3, metric: str = "val_f1_macro") -> DataFrame:
    """Curves of the k best runs; k names are broadcast, the epochs stay in place."""
    best = top_runs(summary, k).select("exp", "name")
    return epochs.join(F.broadcast(best), "exp").select("exp", "name", "epoch", metric)


def freeze_comparison(summary: DataFrame) -> DataFrame:
    """Mean best F1 of frozen and unfrozen runs, difference and relative gain."""
    frozen = F.avg(F.when(F.col("frozen"), F.col("best_val_f1")))
    free = F.avg(F.when(~F.col("frozen"), F.col("best_val_f1")))
    return summary.agg(frozen.alias("frozen_f1"), free.alias("unfrozen_f1")).select(
        "frozen_f1",
        "unfrozen_f1",
        (F.col("unfrozen_f1") - F.col("frozen_f1")).alias("difference"),
        ((F.try_divide("unfrozen_f1", "frozen_f1") - 1) * 100).alias("improvement_pct"),
    )


def f1_by_budget(summary: DataFrame) -> DataFrame:
    """Mean best F1 per number of epochs."""
    return summary.groupBy("epochs").agg(F.avg("best_val_f1").alias("mean_f1")).orderBy("epochs")


def overfit_flags(summary: DataFrame) -> DataFrame:
    gap = F.abs(F.col("final_train_acc") - F.col("final_val_acc"))
    return summary.select(
        "exp", gap.alias("gap"), F.when(gap < V.OVERFIT_GAP, "good").otherwise("overfit").alias("verdict")
    )


def findings(summary: DataFrame) -> DataFrame:
    """Best learning rate, whether many epochs won, whether a frozen run came in last.

    Only the first run and the last two matter: two bounded top-k selections.
    """
    order = [F.desc("best_val_f1"), F.asc("exp")]
    reverse = [F.asc("best_val_f1"), F.desc("exp")]
    first = summary.orderBy(*order).limit(1).select(
        F.lit("first").alias("_end"), "name", "lr", "epochs", "frozen"
    )
    last = summary.orderBy(*reverse).limit(2).select(
        F.lit("last").alias("_end"), "name", "lr", "epochs", "frozen"
    )

    def of_first(column: str):
        return F.max(F.when(F.col("_end") == "first", F.col(column)))

    return first.unionByName(last).agg(
        of_first("name").alias("best_name"),
        of_first("lr").alias("best_lr"),
        (of_first("epochs") >= V.MANY_EPOCHS).alias("more_epochs_helped"),
        F.coalesce(F.bool_or(F.when(F.col("_end") == "last", F.col("frozen"))), F.lit(False)).alias(
            "freezing_hurt"
        ),
    )


def replace_by_key(current: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Upsert: rows of ``updates`` win over rows of ``current`` with the same key."""
    return current.join(updates.select(*keys), list(keys), "left_anti").unionByName(updates)
