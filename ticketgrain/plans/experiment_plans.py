"""Queries over training runs (lineitem as step logs) and evaluated models."""

from __future__ import annotations

from pyspark.sql import functions as F

from ticketgrain.functions import fixed_values as V
from ticketgrain.functions import formatting
from ticketgrain.operators import comparison as cmp
from ticketgrain.operators import experiments as ex
from ticketgrain.plans import mappings as m
from ticketgrain.plans.registry import query, rounded, sql_rounded, table

# Ratios of whole numbers: nine digits keep them apart, summation order cannot show.
DIGITS = 9
_SUMMARY = f"({m.SUMMARY_SQL})"
_EPOCHS = f"({m.EPOCHS_SQL})"
_MODELS = f"({m.MODELS_SQL})"


def _summary(spark, sf):
    return ex.summarize(m.epochs(spark, sf), m.runs(spark, sf))


_SUMMARY_COLUMNS = (
    "exp, name, lr, epochs, frozen::BIGINT AS frozen, best_val_f1, final_val_acc, final_train_acc"
)
_SUMMARY_DOUBLES = "lr best_val_f1 final_val_acc final_train_acc"


def _flat(summary):
    return summary.select(
        "exp", "name", "lr", "epochs", F.col("frozen").cast("long").alias("frozen"),
        "best_val_f1", "final_val_acc", "final_train_acc",
    )


@query("exp_summary", sql_rounded(f"SELECT {_SUMMARY_COLUMNS} FROM {_SUMMARY}", _SUMMARY_DOUBLES, DIGITS))
def exp_summary(spark, sf):
    return rounded(_flat(_summary(spark, sf)).orderBy(F.desc("best_val_f1"), "exp"), DIGITS)


@query(
    "exp_rank",
    sql_rounded(
        f"SELECT exp, name, best_val_f1, row_number() OVER (ORDER BY best_val_f1 DESC, exp) AS position FROM {_SUMMARY}",
        "best_val_f1",
        DIGITS,
    ),
)
def exp_rank(spark, sf):
    return rounded(ex.rank_runs(_summary(spark, sf).select("exp", "name", "best_val_f1")), DIGITS)


@query(
    "exp_best_so_far",
    sql_rounded(
        f"""SELECT exp, epoch, val_acc, (val_acc > coalesce(max(val_acc) OVER (PARTITION BY exp ORDER BY epoch
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS is_best FROM {_EPOCHS}""",
        "val_acc",
        DIGITS,
    ),
)
def exp_best_so_far(spark, sf):
    flags = ex.best_so_far(m.epochs(spark, sf))
    return rounded(flags.withColumn("is_best", F.col("is_best").cast("long")), DIGITS)


@query(
    "exp_curves",
    sql_rounded(
        " UNION ALL ".join(
            f"SELECT exp, epoch, '{c}' AS metric, {c} AS value FROM {_EPOCHS}" for c in ex.CURVE_METRICS
        ),
        "value",
        DIGITS,
    ),
)
def exp_curves(spark, sf):
    return rounded(ex.curves(m.epochs(spark, sf)), DIGITS)


@query(
    "top3_curves",
    sql_rounded(
        f"""SELECT exp, name, epoch, e.val_f1_macro FROM {_EPOCHS} e JOIN (SELECT exp, name FROM {_SUMMARY}
    ORDER BY best_val_f1 DESC, exp LIMIT 3) USING (exp)""",
        "val_f1_macro",
        DIGITS,
    ),
)
def top3_curves(spark, sf):
    return rounded(ex.top_curves(m.epochs(spark, sf), _summary(spark, sf), 3), DIGITS)


@query(
    "exp_top3",
    sql_rounded(
        f"SELECT {_SUMMARY_COLUMNS} FROM (SELECT * FROM {_SUMMARY} ORDER BY best_val_f1 DESC, exp LIMIT 3)",
        _SUMMARY_DOUBLES,
        DIGITS,
    ),
)
def exp_top3(spark, sf):
    return rounded(_flat(ex.top_runs(_summary(spark, sf), 3)), DIGITS)


@query(
    "exp_by_name",
    sql_rounded(
        f"SELECT {_SUMMARY_COLUMNS} FROM {_SUMMARY} WHERE name IN ('run-1', 'run-7', 'run-42')",
        _SUMMARY_DOUBLES,
        DIGITS,
    ),
)
def exp_by_name(spark, sf):
    """Selecting runs by exact name is the operator; everything is read to find them."""
    chosen = ex.select_runs(m.runs(spark, sf), ["run-1", "run-7", "run-42"])
    return rounded(_flat(ex.summarize(m.epochs(spark, sf), chosen)), DIGITS)


@query(
    "exp_unfrozen",
    sql_rounded(f"SELECT name, lr, best_val_f1 FROM {_SUMMARY} WHERE NOT frozen", "lr best_val_f1", DIGITS),
)
def exp_unfrozen(spark, sf):
    return rounded(ex.unfrozen(_summary(spark, sf)).select("name", "lr", "best_val_f1"), DIGITS)


@query(
    "exp_groups",
    sql_rounded(
        f"""SELECT *, unfrozen_f1 - frozen_f1 AS difference, (unfrozen_f1 / frozen_f1 - 1) * 100 AS improvement_pct
    FROM (SELECT avg(best_val_f1) FILTER (frozen) AS frozen_f1, avg(best_val_f1) FILTER (NOT frozen) AS unfrozen_f1
          FROM {_SUMMARY})""",
        "frozen_f1 unfrozen_f1 difference improvement_pct",
    ),
)
def exp_groups(spark, sf):
    return rounded(ex.freeze_comparison(_summary(spark, sf)))


@query(
    "exp_epoch_budget",
    sql_rounded(f"SELECT epochs, avg(best_val_f1) AS mean_f1 FROM {_SUMMARY} GROUP BY epochs", "mean_f1"),
)
def exp_epoch_budget(spark, sf):
    return rounded(ex.f1_by_budget(_summary(spark, sf)))


@query(
    "exp_overfit",
    sql_rounded(
        f"""SELECT exp, abs(final_train_acc - final_val_acc) AS gap,
    CASE WHEN abs(final_train_acc - final_val_acc) < 0.1::DOUBLE THEN 'good' ELSE 'overfit' END AS verdict
    FROM {_SUMMARY}""",
        "gap",
        DIGITS,
    ),
)
def exp_overfit(spark, sf):
    return rounded(ex.overfit_flags(_summary(spark, sf)), DIGITS)


@query(
    "exp_findings",
    sql_rounded(
        f"""SELECT name AS best_name, lr AS best_lr, (epochs >= 5)::BIGINT AS more_epochs_helped,
    (SELECT bool_or(frozen) FROM (SELECT frozen FROM {_SUMMARY} ORDER BY best_val_f1, exp DESC LIMIT 2))::BIGINT
    AS freezing_hurt FROM {_SUMMARY} ORDER BY best_val_f1 DESC, exp LIMIT 1""",
        "best_lr",
        DIGITS,
    ),
)
def exp_findings(spark, sf):
    found = ex.findings(_summary(spark, sf))
    flags = ("more_epochs_helped", "freezing_hurt")
    return rounded(found.withColumns({c: F.col(c).cast("long") for c in flags}), DIGITS)


@query(
    "result_replace",
    sql_rounded(
        f"""SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT exp FROM {_SUMMARY})
    UNION ALL SELECT exp, best_val_f1 FROM {_SUMMARY}""",
        "o_totalprice",
    ),
)
def result_replace(spark, sf):
    """Re-run results replace the rows of the same key."""
    current = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    rerun = _summary(spark, sf).select(
        F.col("exp").alias("o_orderkey"), F.col("best_val_f1").alias("o_totalprice")
    )
    return rounded(ex.replace_by_key(current, rerun, ["o_orderkey"]))


# --- evaluated models ---------------------------------------------------------
def _sql_case(rules, default: str) -> str:
    return "CASE " + " ".join(f"WHEN {test} THEN {value}" for test, value in rules) + f" ELSE {default} END"


_ENDS = "model LIKE '%lora'"
_RANK = _sql_case([(f"contains(model, '{k}')", str(v)) for k, v in V.NAME_RANKS], "64")
_KIND = _sql_case(
    [(f"contains(model, '{k}')", f"'{v}'") for k, v in V.NAME_KINDS] + [(_ENDS, "'lora_rank'")], "'other'"
)
_PARAM = _sql_case(
    [(f"contains(model, '{k}')", f"'{v}'") for k, v in V.NAME_PARAMS] + [(_ENDS, "'Rank=64 (Baseline)'")], "'Unknown'"
)


@query(
    "model_names",
    f"SELECT model, ({_RANK})::BIGINT AS rank, {_KIND} AS kind, {_PARAM} AS parameter FROM {_MODELS}",
)
def model_names(spark, sf):
    return cmp.name_facts(m.models(spark, sf))


_COMPARED = ", ".join(f"coalesce({c}, 0) AS {c}" for c in cmp.COMPARED)
_TABLE_SQL = f"SELECT model, {_KIND} AS kind, {_PARAM} AS parameter, {_COMPARED} FROM {_MODELS}"


@query("model_table", sql_rounded(_TABLE_SQL, " ".join(cmp.COMPARED), DIGITS))
def model_table(spark, sf):
    return rounded(cmp.comparison_table(m.models(spark, sf)), DIGITS)


@query(
    "model_kinds",
    sql_rounded(
        f"SELECT kind, count(*) AS models, avg(avg_rougeL_f) AS \"mean_rougeL\" FROM ({_TABLE_SQL}) GROUP BY kind",
        "mean_rougeL",
    ),
)
def model_kinds(spark, sf):
    return rounded(cmp.kind_groups(m.models(spark, sf)))


_ACC = ("type_accuracy", "priority_accuracy", "queue_accuracy")


@query(
    "mean_accuracy",
    sql_rounded(
        f"""SELECT model, ({_RANK})::BIGINT AS rank, {", ".join(_ACC)},
    ({" + ".join(_ACC)}) / 3 AS mean_accuracy FROM {_MODELS}""",
        " ".join((*_ACC, "mean_accuracy")),
        DIGITS,
    ),
)
def mean_accuracy(spark, sf):
    return rounded(cmp.mean_accuracy(m.models(spark, sf)), DIGITS)


@query(
    "formatted_metrics",
    f"""SELECT model, printf('%.4f', coalesce(avg_rougeL_f, 0)) AS rouge_l,
    printf('%.2f', priority_accuracy * 100) || '%' AS priority,
    printf('%+.2f', (type_accuracy - queue_accuracy) * 100) || '%' AS gap FROM {_MODELS}""",
)
def formatted_metrics(spark, sf):
    return m.models(spark, sf).select(
        "model",
        formatting.fixed4(F.coalesce("avg_rougeL_f", F.lit(0.0))).alias("rouge_l"),
        formatting.percent2(F.col("priority_accuracy")).alias("priority"),
        formatting.signed_percent2((F.col("type_accuracy") - F.col("queue_accuracy")) * 100).alias("gap"),
    )


# Only rank variants are compared along ranks.
@query(
    "rank_gain",
    sql_rounded(
        f"""SELECT family, ({_RANK})::BIGINT AS rank, model, avg_rouge1_f AS value,
    CASE WHEN lag(avg_rouge1_f) OVER w <> 0 THEN (avg_rouge1_f - lag(avg_rouge1_f) OVER w) /
      lag(avg_rouge1_f) OVER w * 100 END AS gain_pct, (avg_rouge1_f - lag(avg_rouge1_f) OVER w) * 100 AS gain_points
    FROM {_MODELS} WHERE {_KIND} = 'lora_rank' WINDOW w AS (PARTITION BY family ORDER BY {_RANK}, position)""",
        "value gain_pct gain_points",
        DIGITS,
    ),
)
def rank_gain(spark, sf):
    return rounded(cmp.rank_gain(m.models(spark, sf), "avg_rouge1_f"), DIGITS)


@query(
    "baseline_gain",
    f"""SELECT family, model, rank, round(v, 9) AS value,
    round(CASE WHEN rank <> 16 AND base <> 0 THEN (v - base) * 100 / base END, 9) AS gain_pct
    FROM (SELECT *, last_value(CASE WHEN rank = 16 THEN v END IGNORE NULLS) OVER (PARTITION BY family ORDER BY position
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS base
      FROM (SELECT *, ({_RANK})::BIGINT AS rank, coalesce(avg_rougeL_f, 0) AS v FROM {_MODELS}))""",
)
def baseline_gain(spark, sf):
    return rounded(cmp.baseline_gain(m.models(spark, sf)), DIGITS)


_METRICS = (*_ACC, "avg_rouge1_f", "avg_rouge2_f", "avg_rougeL_f")


def _sql_side(position: int, name: str) -> str:
    return " UNION ALL ".join(
        f"SELECT family, '{c}' AS metric, {c} AS {name} FROM {_MODELS} WHERE position = {position} AND {c} IS NOT NULL"
        for c in _METRICS
    )


_PAIR_SQL = f"""SELECT family, metric, coalesce(base, 0) AS base, coalesce(tuned, 0) AS tuned,
CASE WHEN coalesce(base, 0) <> 0 THEN (coalesce(tuned, 0) - base) * 100 / base END AS improvement_pct
FROM ({_sql_side(1, "base")}) FULL JOIN ({_sql_side(4, "tuned")}) USING (family, metric)"""


def _pairs(spark, sf):
    """Rank 16 against rank 128 of every family."""
    models = m.models(spark, sf)
    base, tuned = models.filter(F.col("position") == 1), models.filter(F.col("position") == 4)
    return cmp.compare_pair(base, tuned, _METRICS, ["family"])


@query("base_vs_tuned", sql_rounded(_PAIR_SQL, "base tuned improvement_pct", DIGITS))
def base_vs_tuned(spark, sf):
    return rounded(_pairs(spark, sf), DIGITS)


_FLAGS_SQL = f"""SELECT family, bool_or(tuned > base AND metric LIKE '%accuracy') AS c,
bool_or(tuned > base AND metric IN ('avg_rouge1_f', 'avg_rougeL_f')) AS t FROM ({_PAIR_SQL}) GROUP BY family"""


@query(
    "tuning_verdict",
    f"""SELECT family, c::BIGINT AS classification_improved, t::BIGINT AS generation_improved,
    CASE WHEN c AND t THEN 'effective' WHEN c THEN 'partial' ELSE 'not effective' END AS verdict FROM ({_FLAGS_SQL})""",
)
def tuning_verdict(spark, sf):
    flags = ("classification_improved", "generation_improved")
    verdicts = cmp.verdicts(_pairs(spark, sf), ["family"])
    return verdicts.withColumns({c: F.col(c).cast("long") for c in flags})


@query(
    "tuning_advice",
    " UNION ALL ".join(
        f"SELECT family, metric, round(tuned, 9) AS tuned, '{hint}' AS advice FROM ({_PAIR_SQL}) "
        f"WHERE metric = '{metric}' AND tuned < {bound}::DOUBLE"
        for metric, bound, hint in V.ADVICE
    ),
)
def tuning_advice(spark, sf):
    return rounded(cmp.advice(_pairs(spark, sf), ["family"]), DIGITS)


_BEST_SQL = f"SELECT * FROM {_MODELS} ORDER BY coalesce(avg_rougeL_f, 0) DESC, position, model LIMIT 1"


@query(
    "targets",
    " UNION ALL ".join(
        f"SELECT model, '{metric}' AS metric, {goal}::DOUBLE AS target, round(coalesce({metric}, 0), 9) AS actual, "
        f"(coalesce({metric}, 0) >= {goal}::DOUBLE)::BIGINT AS achieved FROM ({_BEST_SQL})"
        for metric, goal in V.TARGETS
    ),
)
def targets(spark, sf):
    best = cmp.best_model(m.models(spark, sf), "avg_rougeL_f")
    return rounded(cmp.targets(best).withColumn("achieved", F.col("achieved").cast("long")), DIGITS)


@query(
    "best_model",
    sql_rounded(
        f"SELECT model, avg_rougeL_f, priority_accuracy FROM ({_BEST_SQL})", "avg_rougeL_f priority_accuracy", DIGITS
    ),
)
def best_model(spark, sf):
    best = cmp.best_model(m.models(spark, sf), "avg_rougeL_f")
    return rounded(best.select("model", "avg_rougeL_f", "priority_accuracy"), DIGITS)


@query(
    "weighted_score",
    f"""SELECT model, round(0.25::DOUBLE * type_accuracy + 0.25::DOUBLE * priority_accuracy +
    0.25::DOUBLE * queue_accuracy + 0.25::DOUBLE * coalesce(avg_rougeL_f, 0), 9) AS score FROM {_MODELS}""",
)
def weighted_score(spark, sf):
    return rounded(cmp.weighted_score(m.models(spark, sf)), DIGITS)


_UNPIVOT = " UNION ALL ".join(
    f"SELECT family, model, '{c}' AS metric, {c} AS value FROM {_MODELS} WHERE {c} IS NOT NULL" for c in _METRICS
)


@query(
    "best_per_metric",
    sql_rounded(
        f"""SELECT family, metric, value AS best, model FROM ({_UNPIVOT})
    QUALIFY row_number() OVER (PARTITION BY family, metric ORDER BY value DESC, model) = 1""",
        "best",
        DIGITS,
    ),
)
def best_per_metric(spark, sf):
    return rounded(cmp.best_per_metric(m.models(spark, sf), _METRICS, ["family"]), DIGITS)


@query(
    "model_ranking",
    sql_rounded(
        f"""SELECT family, model, avg_rouge1_f AS value,
    row_number() OVER (PARTITION BY family ORDER BY avg_rouge1_f DESC, model) AS place FROM {_MODELS}""",
        "value",
        DIGITS,
    ),
)
def model_ranking(spark, sf):
    return rounded(cmp.model_ranking(m.models(spark, sf), "avg_rouge1_f"), DIGITS)
