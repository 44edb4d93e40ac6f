"""What the operators share: reading documents, Python over Arrow batches, staged tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketgrain.plans.registry import table
from ticketgrain.session import scratch_path

# Smallest long: stands for a null id in joins and orders, so nulls come first.
NULL_ID = -(2**63)
# Texts are handed to the per-row helpers in slices of about this many bytes.
SLICE_BYTES = 4 * 1024 * 1024


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator needs; a null text is an empty one."""
    return docs.select(
        quoted(id_col).cast("long").alias("doc_id"),
        F.coalesce(quoted(text_col).cast("string"), F.lit("")).alias("text"),
    )


def order_id(name: str = "doc_id") -> Column:
    return F.coalesce(F.col(name), F.lit(NULL_ID))


def slices(
    batches: Iterator[pa.RecordBatch], text: str = "text", size: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that one slice holds a few MB of text, or one long row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = max(1, batch.num_rows * size // max(1, batch.column(text).nbytes))
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def map_texts(
    df: DataFrame,
    fn: Callable[[pa.RecordBatch], pa.RecordBatch],
    schema: str,
    text: str = "text",
    size: int = SLICE_BYTES,
) -> DataFrame:
    """``fn`` over slices of the Arrow batches of ``df``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text, size):
            yield fn(part)

    return df.mapInArrow(run, schema)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a derived table below the shared folder once and read it from there."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
