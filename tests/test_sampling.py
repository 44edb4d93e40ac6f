import random

import pytest
from pyspark.sql import functions as F

from ticketgrain.operators import profiling, sampling


def test_published_sizes_and_strata(spark):
    # 28,261 tickets in 8 queues, one queue with a third of them
    queue = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 7 + 1)
    data = spark.range(28_261).select("id", F.concat(F.lit("q"), queue.cast("string")).alias("queue"))
    split = sampling.stratified_split(data, "id").cache()
    sizes = dict(profiling.split_sizes(split).collect())
    assert sizes == {"train": 19_782, "val": 4_239, "test": 4_240, "total": 28_261}
    per_queue = split.groupBy("queue").pivot("split", ["train", "val", "test"]).count().collect()
    for row in per_queue:
        n = row["train"] + row["val"] + row["test"]
        assert abs(row["train"] - 19_782 * n / 28_261) < 1
        assert abs(row["val"] - 4_239 * n / 28_261) < 2
    again = sampling.stratified_split(data.repartition(3), "id")
    assert split.exceptAll(again).count() == 0


def test_rows_follow_hash_order_inside_a_stratum(spark):
    data = spark.range(500).select("id", F.lit("only").alias("queue"))
    split = sampling.stratified_split(data, "id").withColumn("h", sampling.sample_order("id", 42))
    order = [r["split"] for r in split.orderBy("h").collect()]
    assert order == ["train"] * 350 + ["val"] * 75 + ["test"] * 75


def test_null_is_a_stratum_and_single_rows_fail(spark):
    data = spark.createDataFrame([(i, None if i < 10 else "a") for i in range(40)], "id long, queue string")
    split = sampling.stratified_split(data, "id")
    assert split.count() == 40
    assert split.filter(F.col("queue").isNull() & (F.col("split") == "train")).count() == 7
    with pytest.raises(ValueError, match="two rows"):
        sampling.stratified_split(data.union(spark.createDataFrame([(99, "b")], data.schema)), "id")


def test_holdout_share(spark):
    parts = sampling.holdout(spark.range(20_000), "id")
    share = parts.filter("part = 'val'").count() / 20_000
    assert 0.04 < share < 0.06


def test_review_template_shape(spark):
    data = spark.createDataFrame(
        [(i, "in" * 400, "ref", None) for i in range(5)], "sid long, input string, reference string, prediction string"
    )
    sheet = sampling.review_template(data, "sid", n_samples=3).collect()
    assert [r["id"] for r in sheet] == [1, 2, 3]
    assert len(sheet[0]["input"]) == 500 and sheet[0]["prediction"] == "" and sheet[0]["comments"] == ""
    assert len(sampling.review_template(data, "sid", n_samples=50).collect()) == 5


def test_head_and_sample(spark):
    data = spark.range(100)
    assert [r[0] for r in sampling.head(data, 3, "id").collect()] == [0, 1, 2]
    drawn = {r[0] for r in sampling.random_sample(data, 10, "id").collect()}
    assert len(drawn) == 10 and drawn == {r[0] for r in sampling.random_sample(data.repartition(5), 10, "id").collect()}
    assert sampling.random_sample(data, 500, "id").count() == 100


def test_selection_equals_an_ordered_limit(spark):
    rng = random.Random(8)
    keys = [rng.choice([-(2**63), 2**63 - 1, rng.randrange(-5, 5), rng.randrange(2**62)]) for _ in range(3000)] + [None] * 40 + [7] * 500
    data = spark.createDataFrame([(k, f"row {i}") for i, k in enumerate(keys)], "id long, text string").repartition(5)
    ordered = sorted(keys, key=lambda k: (k is not None, k or 0))
    for n in (0, 1, 39, 41, 600, 1500, 3539, 3540, 9000):
        found = [r.id for r in sampling.head(data, n, "id").collect()]
        assert sorted(found, key=lambda k: (k is not None, k or 0)) == ordered[:n]
    names = data.select(F.col("id").cast("string").alias("id"), "text")
    spelled = sorted([None if k is None else str(k) for k in keys], key=lambda k: (k is not None, k or ""))
    for n in (0, 5, 40, 41, 900, 9000):
        found = [r.id for r in sampling.head(names, n, "id").collect()]
        assert sorted(found, key=lambda k: (k is not None, k or "")) == spelled[:n]
    assert sampling.random_sample(data, 1000, "id").count() == 1000


def test_selection_moves_no_texts(spark):
    """Rows are filtered in place: only keys are sorted, and histograms refine a crowded cut."""
    data = spark.range(50_000).select(F.col("id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    for picked in (sampling.head(data, 20_000, "id"), sampling.random_sample(data, 20_000, "id")):
        plan = picked._jdf.queryExecution().executedPlan().toString()
        assert "TakeOrdered" not in plan and "Exchange" not in plan
        assert picked.count() == 20_000
    assert sampling.head(data, 20_000, "id").agg(F.max("id")).first()[0] == 19_999
