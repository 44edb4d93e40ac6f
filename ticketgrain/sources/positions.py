"""Places of records in files that carry no key: file order, then place in the file."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketgrain.operators.scaling import lookup_join, stage


def with_positions(files: DataFrame, name: str = "position") -> DataFrame:
    """Number the records of a file source 0, 1, ... by file path, then by place in the file.

    ``files`` is a table as read (``spark.read...``), since a record's file and split come from there.
    Each split is numbered by the task that reads it; one row for each split carries how many records
    lie before it.  Files are written once with their place, so every reader sees the same numbers,
    however the splits are dealt to tasks.  Part files of one writer are in order by name.
    """
    columns = [F.col(f"`{c}`") for c in files.columns]
    read = files.select(
        *columns,
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_slot"),
    )
    placed = stage(read)
    splits = placed.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_slot").alias("_first"))
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select("_file", "_block", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    numbered = lookup_join(placed, offsets, ["_file", "_block"], "inner")
    return numbered.select((F.col("_slot") + F.col("_shift")).alias(name), *columns)
