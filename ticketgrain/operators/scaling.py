"""Shared building blocks that keep the operators safe on large, skewed data.

* ``stage``             cut lineage once, reliably, so a derived table is computed once
* ``lookup_join``       join a table with unique keys; the planner picks the join
* ``salted_join``       join against a unique-keyed side when the other side has hot keys
* ``global_row_number`` dense 1..n numbering without a single-task sort of big data
* ``by_key``            a stored table placed by key, in tasks of a bounded number of rows
* ``top_by_count``      the most frequent rows, numbered, without a single-task sort
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketgrain.session import scratch_path

SALTS = 32
# Counts are put into so many buckets for each doubling when a top is cut.
BUCKETS_PER_DOUBLING = 16
# Groups of up to so many rows fit a task's memory several times over.
ROWS_PER_TASK = 250_000


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a table below the shared folder and continue from there.

    ``session.remove_scratch`` deletes such tables when the work is done.
    """
    path = scratch_path(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def salted_join(
    big: DataFrame, unique_side: DataFrame, on: Sequence[str], how: str = "inner", salts: int = SALTS
) -> DataFrame:
    """Shuffle join whose hot keys spread over ``salts`` tasks.

    ``unique_side`` holds each key once; it is repeated per salt while the big
    side gets its salt from a hash of the whole row.  That repeats exactly when a
    lost task is run again, which a random salt does not; rows of a hot key should
    differ (carry an id), since identical rows share a salt.
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join supports inner and left")
    keys = list(on)
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in big.columns]), F.lit(salts)).cast("int")
    left = big.withColumn("_salt", salt)
    right = unique_side.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, keys + ["_salt"], how).drop("_salt")


def lookup_join(big: DataFrame, small: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join a lookup table with unique keys onto ``big``.

    No hint: the planner broadcasts by size, and splits hot keys at run time otherwise.
    """
    return big.join(small, list(on), how)


def by_key(stored: DataFrame, *keys: str) -> DataFrame:
    """The rows of a stored table placed by ``keys``, in so many partitions that each has few rows.

    The count comes from the files' footers.  Groupings by these keys and more, and joins on
    the keys, stay in the partitions, so the memory of one task does not grow with the table.
    All rows of a key are in one task: not for keys that many rows share.
    """
    usual = int(stored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stored.repartition(max(usual, -(-stored.count() // ROWS_PER_TASK)), *keys)


def global_row_number(df: DataFrame, order_by: Sequence[Column], name: str, start: int = 1) -> DataFrame:
    """Number all rows ``start, start+1, ...`` in the given total order.

    ``order_by`` must be unique (end it with a key).  All tasks range-partition and sort the
    rows, which are written once with their place; each partition then adds the row count of
    the partitions before it.
    """
    ordered = stage(df.orderBy(*order_by).withColumn("_slot", F.monotonically_increasing_id()))
    ordered = ordered.withColumn("_part", F.shiftright("_slot", 33)).withColumn(
        "_pos", F.col("_slot").bitwiseAND(F.lit((1 << 33) - 1))
    )
    # One row per partition: its size is the partition count, not the data.
    sizes = ordered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    numbered = ordered.join(F.broadcast(offsets), "_part").withColumn(
        name, F.col("_offset") + F.col("_pos") + F.lit(start)
    )
    return numbered.drop("_slot", "_part", "_pos", "_offset")


def top_by_count(
    df: DataFrame, count: str, size: int, order_by: Sequence[Column], name: str, start: int = 1
) -> DataFrame:
    """The first ``size`` rows in an order that begins with descending ``count``, numbered.

    A histogram of the counts (a bounded number of buckets) tells which rows can be among
    them; only these are sorted, by all tasks.
    """
    counted = stage(df)
    bucket = F.floor(F.log2(count) * BUCKETS_PER_DOUBLING).cast("int")
    sizes = counted.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()
    held, lowest = 0, 0
    for row in sorted(sizes, reverse=True):
        held, lowest = held + row["n"], row["b"]
        if held >= size:
            break
    numbered = global_row_number(counted.filter(bucket >= lowest), order_by, name, start)
    return numbered.filter(F.col(name) < start + size)


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fail before any job starts when a column is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; available columns: {df.columns}")
    return df
