"""Runs are placed once, in as many tasks as their rows ask for, and stay there up to the result."""

import re

from pyspark.sql import functions as F

from tests.conftest import rows
from ticketgrain.operators import experiments as ex
from ticketgrain.operators import scaling
from ticketgrain.plans import experiment_plans as plans
from ticketgrain.plans import mappings as m

LINES = "l_orderkey long, l_linenumber int, l_discount double, l_quantity double, l_tax double, l_partkey long"
ORDERS = "o_orderkey long, o_totalprice double, o_orderpriority string, o_orderstatus string"


def tables(spark, folder):
    lines = [(k, i, 0.05, 25.0, 0.04, 100 * k + i) for k in range(40) for i in (1, 2, 2)] + [(None, 1, 0.1, 1.0, 0.0, 7)]
    spark.createDataFrame(lines, LINES).write.parquet(f"{folder}/lineitem.parquet")
    orders = [(k, float(k), "2-HIGH", "F") for k in [*range(30, 60), 50, 50]] + [(None, 1.0, "5-LOW", "O")]
    spark.createDataFrame(orders, ORDERS).write.parquet(f"{folder}/orders.parquet")
    return str(folder)


def test_tasks_of_runs_grow_with_the_steps(spark, tmp_path, monkeypatch):
    sf = tables(spark, tmp_path)
    monkeypatch.setattr(scaling, "ROWS_PER_TASK", 10)
    summary = ex.best_and_last(m.epochs(spark, sf))
    sizes = summary.groupBy(F.spark_partition_id()).count().collect()
    assert summary.count() == 41 and len(sizes) > 8  # 4 is the usual number


def test_replaced_results_with_repeated_and_null_keys(spark, tmp_path, monkeypatch):
    sf = tables(spark, tmp_path)
    monkeypatch.setattr(scaling, "ROWS_PER_TASK", 10)
    kept = [(k, float(k)) for k in [*range(40, 60), 50, 50]] + [(None, 1.0)]
    best = [(k, (100 * k % 1000 + 2) / 1000) for k in range(30, 40)]
    assert rows(plans.result_replace(spark, sf)) == sorted([*kept, *best], key=repr)


def test_no_other_place_after_the_first(spark, tmp_path, monkeypatch):
    sf = tables(spark, tmp_path)
    monkeypatch.setattr(scaling, "ROWS_PER_TASK", 10)
    plan = plans._summary(spark, sf)._jdf.queryExecution().executedPlan().toString()
    tasks = re.findall(r"Exchange hashpartitioning\(.*?, (\d+)\)", plan)
    assert tasks == ["13", "13"] and "Broadcast" not in plan  # the steps, the runs
