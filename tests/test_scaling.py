"""Shared building blocks on skewed data."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from ticketgrain import session
from ticketgrain.operators import scaling


def test_global_row_number(spark):
    data = spark.range(5000).select((F.col("id") % 7).alias("k"), F.col("id").alias("i"))
    numbered = scaling.global_row_number(data, [F.desc("k"), F.asc("i")], "n")
    wanted = sorted(((i % 7, i) for i in range(5000)), key=lambda r: (-r[0], r[1]))
    assert rows(numbered, "n", "k", "i") == sorted(((n, *r) for n, r in enumerate(wanted, 1)), key=repr)


def test_global_row_number_with_one_hot_value(spark):
    hot = F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id"))
    data = spark.range(3000).select(hot.alias("k"), F.col("id").alias("i"))
    numbered = scaling.global_row_number(data, [F.asc("k"), F.asc("i")], "n", start=0)
    got = [r["n"] for r in numbered.orderBy("k", "i").collect()]
    assert got == list(range(3000))
    assert scaling.global_row_number(data.limit(0), [F.asc("i")], "n").count() == 0


@pytest.mark.parametrize("size", [1, 5, 17, 400, 5000])
def test_top_by_count(spark, size):
    data = spark.range(1000).select((F.col("id") % 40 + 1).alias("c"), F.col("id").alias("i"))
    top = scaling.top_by_count(data, "c", size, [F.desc("c"), F.asc("i")], "n", start=2)
    wanted = sorted(((i % 40 + 1, i) for i in range(1000)), key=lambda r: (-r[0], r[1]))[:size]
    assert rows(top, "n", "c", "i") == sorted(((n, *r) for n, r in enumerate(wanted, 2)), key=repr)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_joins_agree(spark, how):
    # one key holds a third of the rows
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 100)
    big = spark.range(6000).select(key.alias("k"), F.col("id").alias("i"))
    small = spark.range(60).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    plain = scaling.lookup_join(big, small, ["k"], how)
    salted = scaling.salted_join(big, small, ["k"], how)
    assert rows(plain, "k", "i", "v") == rows(salted, "k", "i", "v")
    assert "_salt" in salted._jdf.queryExecution().optimizedPlan().toString()


def test_scratch_is_removed(spark):
    staged = scaling.stage(spark.range(3))
    (path,) = {f.rsplit("/", 1)[0] for f in staged.inputFiles()}
    session.remove_scratch(spark)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    assert not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def test_require_columns(spark):
    with pytest.raises(ValueError, match="available columns"):
        scaling.require_columns(spark.range(1), ["id", "text"])
