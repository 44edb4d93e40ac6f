"""Tables that a stream writes as one folder for each micro-batch.

A batch that is run again after a failure overwrites its folder, so every batch counts once.
What a folder holds may be folded into the folder of a later batch and then be removed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _file_system(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def numbers(spark: SparkSession, table: str) -> list[int]:
    """The batches that are complete below ``table``, ascending."""
    folder, fs = _file_system(spark, table)
    if not fs.exists(folder):
        return []
    found = []
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith("batch=") and fs.exists(_file_system(spark, f"{table}/{name}/_SUCCESS")[0]):
            found.append(int(name.removeprefix("batch=")))
    return sorted(found)


def write(df: DataFrame, table: str, number: int) -> None:
    df.write.mode("overwrite").parquet(f"{table}/batch={number}")


def read(spark: SparkSession, table: str, wanted: list[int], schema: str) -> DataFrame:
    """The rows of the given batches; empty without any.  Column ``batch`` is the folder's number."""
    if not wanted:
        return spark.createDataFrame([], f"{schema}, batch int")
    paths = [f"{table}/batch={n}" for n in wanted]
    return spark.read.schema(f"{schema}, batch int").option("basePath", table).parquet(*paths)


def remove(spark: SparkSession, table: str, gone: list[int]) -> None:
    for number in gone:
        folder, fs = _file_system(spark, f"{table}/batch={number}")
        fs.delete(folder, True)
