"""Model comparison on the published result files."""

import pytest

from tests.conftest import rows
from ticketgrain.operators import comparison as cmp
from ticketgrain.operators import experiments as ex

SCHEMA = (
    "family string, position long, model string, avg_rouge1_f double, avg_rouge2_f double, avg_rougeL_f double, "
    "avg_bleu double, type_accuracy double, queue_accuracy double, priority_accuracy double"
)
# published averages: base, rank 32, rank 64, rank 128
PUBLISHED = [
    ("q", 1, "base", None, None, None, None, 0.4991, 0.2976, 0.3368),
    ("q", 2, "m-lora-rank32", 0.4826, 0.2496, 0.3567, 0.1495, 0.8127, 0.4068, 0.4601),
    ("q", 3, "m-lora", 0.5142, 0.2935, 0.3966, 0.1969, 0.8333, 0.4896, 0.5182),
    ("q", 4, "m-lora-rank128", 0.5639, 0.3573, 0.4555, 0.2610, 0.8540, 0.5406, 0.5710),
]


@pytest.fixture()
def models(spark):
    return spark.createDataFrame(PUBLISHED, SCHEMA)


def test_weighted_score(models):
    got = {r["model"]: round(r["score"] * 100, 2) for r in cmp.weighted_score(models).collect()}
    assert got["m-lora-rank128"] == 60.53
    assert got["base"] == 28.34
    assert got["m-lora-rank32"] == pytest.approx(50.91, abs=0.011)
    assert got["m-lora"] == pytest.approx(55.94, abs=0.011)


def test_rank_gains(models):
    tuned = models.filter("model <> 'base'")
    got = {r["rank"]: r["gain_pct"] for r in cmp.rank_gain(tuned).collect()}
    assert got[32] is None
    assert round(got[64], 2) == 11.19
    assert round(got[128], 2) == 14.85


def test_names(models):
    assert rows(cmp.name_facts(models)) == [
        ("base", 64, "other", "Unknown"),
        ("m-lora", 64, "lora_rank", "Rank=64 (Baseline)"),
        ("m-lora-rank128", 128, "lora_rank", "Rank=128"),
        ("m-lora-rank32", 32, "lora_rank", "Rank=32"),
    ]


def test_targets_of_best_model(models):
    best = cmp.best_model(models, "avg_rougeL_f")
    assert best.first()["model"] == "m-lora-rank128"
    got = {r["metric"]: r["achieved"] for r in cmp.targets(best).collect()}
    assert got == {"avg_rougeL_f": True, "priority_accuracy": False, "type_accuracy": True}


def test_base_against_tuned(spark, models):
    metrics = (*cmp.ACCURACIES, "avg_rouge1_f", "avg_rougeL_f")
    pairs = cmp.compare_pair(models.filter("position = 1"), models.filter("position = 4"), metrics)
    got = {r["metric"]: r["improvement_pct"] for r in pairs.collect()}
    assert round(got["type_accuracy"], 2) == 71.11
    assert got["avg_rougeL_f"] is None  # the base has no text metrics: 0, no percentage
    keyed = cmp.compare_pair(models.filter("position = 1"), models.filter("position = 4"), metrics, ["family"])
    assert cmp.verdicts(keyed, ["family"]).first()["verdict"] == "effective"
    advised = {r["metric"] for r in cmp.advice(keyed, ["family"]).collect()}
    assert advised == {"priority_accuracy", "queue_accuracy"}
    swapped = cmp.compare_pair(models.filter("position = 4"), models.filter("position = 1"), metrics, ["family"])
    assert cmp.verdicts(swapped, ["family"]).first()["verdict"] == "not effective"


def test_baseline_must_come_earlier(spark):
    data = spark.createDataFrame(
        [("f", 1, "x-lora", 0.3), ("f", 2, "x-rank16", 0.2), ("f", 3, "x-rank32", 0.25), ("f", 4, "x-rank16b", 0.0),
         ("f", 5, "x-rank128", 0.5)],
        "family string, position long, model string, avg_rougeL_f double",
    )
    got = [r["gain_pct"] for r in cmp.baseline_gain(data).orderBy("rank", "value").collect()]
    by_model = {r["model"]: r["gain_pct"] for r in cmp.baseline_gain(data).collect()}
    assert by_model == {
        "x-lora": None, "x-rank16": None, "x-rank32": pytest.approx(25.0), "x-rank16b": None, "x-rank128": None,
    }
    assert len(got) == 5


def test_best_and_ranking(models):
    best = {r["metric"]: (r["best"], r["model"]) for r in cmp.best_per_metric(models, ["avg_bleu", "type_accuracy"]).collect()}
    assert best == {"avg_bleu": (0.2610, "m-lora-rank128"), "type_accuracy": (0.8540, "m-lora-rank128")}
    places = {r["model"]: r["place"] for r in cmp.model_ranking(models, "type_accuracy").collect()}
    assert places == {"m-lora-rank128": 1, "m-lora": 2, "m-lora-rank32": 3, "base": 4}


def test_mean_accuracy_and_kinds(models):
    got = {r["model"]: round(r["mean_accuracy"], 6) for r in cmp.mean_accuracy(models).collect()}
    assert got["m-lora-rank128"] == round((0.8540 + 0.5406 + 0.5710) / 3, 6)
    assert {r["kind"]: r["models"] for r in cmp.kind_groups(models).collect()} == {"lora_rank": 3, "other": 1}


# --- training runs: the published summary of five experiments ------------------
RUNS = [
    ("EXP1", "EXP1_baseline_lr2e5", 2e-5, False, 3, 0.650018, 0.661005, 0.689162),
    ("EXP2", "EXP2_lr3e5", 3e-5, False, 3, 0.651146, 0.663836, 0.708675),
    ("EXP3", "EXP3_lr5e5", 5e-5, False, 3, 0.636385, 0.640481, 0.72015),
    ("EXP4", "EXP4_frozen", 2e-5, True, 3, 0.32172, 0.435008, 0.422505),
    ("EXP5", "EXP5_lr3e5_5epochs", 3e-5, False, 5, 0.711551, 0.724699, 0.882873),
]


@pytest.fixture()
def summary(spark):
    runs = spark.createDataFrame([r[:4] for r in RUNS], "exp string, name string, lr double, frozen boolean")
    epochs = [
        (e, i, 0.5, acc, val if i == n else val / 2, f1 if i == n else f1 / 2)
        for e, _, _, _, n, f1, val, acc in RUNS
        for i in range(1, n + 1)
    ]
    schema = "exp string, epoch int, train_loss double, train_acc double, val_acc double, val_f1_macro double"
    return ex.summarize(spark.createDataFrame(epochs, schema), runs)


def test_run_ranking(summary):
    order = [r["exp"] for r in ex.rank_runs(summary).orderBy("position").collect()]
    assert order == ["EXP5", "EXP2", "EXP1", "EXP3", "EXP4"]
    assert [r["exp"] for r in ex.top_runs(summary, 2).collect()] == ["EXP5", "EXP2"]


def test_run_findings(summary):
    row = ex.findings(summary).first()
    assert (row["best_lr"], row["more_epochs_helped"], row["freezing_hurt"]) == (3e-5, True, True)
    verdict = {r["exp"]: r["verdict"] for r in ex.overfit_flags(summary).collect()}
    assert verdict == {"EXP1": "good", "EXP2": "good", "EXP3": "good", "EXP4": "good", "EXP5": "overfit"}


def test_run_groups(summary):
    row = ex.freeze_comparison(summary).first()
    free = (0.650018 + 0.651146 + 0.636385 + 0.711551) / 4
    assert row["difference"] == pytest.approx(free - 0.32172)
    assert row["improvement_pct"] == pytest.approx((free / 0.32172 - 1) * 100)
    assert {r["epochs"]: round(r["mean_f1"], 6) for r in ex.f1_by_budget(summary).collect()}[5] == 0.711551


def test_best_so_far_is_strict(spark):
    epochs = spark.createDataFrame([("e", i, a) for i, a in enumerate([0.0, 0.4, 0.4, 0.5], 1)], "exp string, epoch int, val_acc double")
    assert [r["is_best"] for r in ex.best_so_far(epochs).orderBy("epoch").collect()] == [False, True, False, True]


def test_select_and_replace(spark, summary):
    assert ex.select_runs(summary, ["EXP2_lr3e5"]).count() == 1
    with pytest.raises(ValueError):
        ex.select_runs(summary, ["EXP2"])
    old = spark.createDataFrame([("a", 1), ("b", 2)], "name string, v int")
    assert rows(ex.replace_by_key(old, spark.createDataFrame([("b", 9), ("c", 3)], old.schema), ["name"])) == [
        ("a", 1), ("b", 9), ("c", 3),
    ]
