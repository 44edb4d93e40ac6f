"""Documents in id order, in buckets that tasks handle on their own.

A narrow pass over (id, text hash) lets Spark's range partitioner find where the buckets
begin; the driver sees one key for each bucket.  The texts are then shuffled once.
"""

from __future__ import annotations

from bisect import bisect_right

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketgrain.llm.common import order_id

BUCKETS_PER_PARTITION = 4


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def in_buckets(docs: DataFrame, first_of_next: bool = False) -> DataFrame:
    """Columns bucket, guest, doc_id, tie, text; sorted so within each partition.

    Buckets ascend with (doc_id, hash of the text), null ids first.  With ``first_of_next``
    each bucket also gets the first document of the bucket after it (the last one that of
    the first) as a last row with guest = true.
    """
    rows = docs.select("doc_id", order_id().alias("key"), F.xxhash64("text").alias("tie"), "text")
    partitions = shuffle_partitions(docs)
    firsts = (
        rows.select("key", "tie")
        .repartitionByRange(partitions * BUCKETS_PER_PARTITION, "key", "tie")
        .groupBy(F.spark_partition_id().alias("p"))
        .agg(F.min(F.struct("key", "tie")).alias("first"))
        .collect()
    )
    bounds = sorted((r["first"]["key"], r["first"]["tie"]) for r in firsts)

    @F.pandas_udf("struct<bucket: int, first: boolean>")
    def place(key: pd.Series, tie: pd.Series) -> pd.DataFrame:
        keys = list(zip(key, tie, strict=True))
        bucket = [bisect_right(bounds, k) - 1 for k in keys]
        return pd.DataFrame({"bucket": bucket, "first": [bounds[b] == k for b, k in zip(bucket, keys, strict=True)]})

    placed = rows.withColumn("at", place("key", "tie"))
    home = F.struct(F.col("at.bucket").alias("bucket"), F.lit(False).alias("guest"))
    if first_of_next:
        before = F.pmod(F.col("at.bucket") - 1, F.lit(max(1, len(bounds))))
        away = F.struct(before.cast("int").alias("bucket"), F.lit(True).alias("guest"))
        placed = placed.withColumn("to", F.explode(F.when(F.col("at.first"), F.array(home, away)).otherwise(F.array(home))))
    else:
        placed = placed.withColumn("to", home)
    return (
        placed.select("to.bucket", "to.guest", "key", "doc_id", "tie", "text")
        .repartition(partitions, "bucket")
        .sortWithinPartitions("bucket", "guest", "key", "tie")
        .drop("key")
    )
