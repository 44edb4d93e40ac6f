"""Reading ticket tables, samples, predictions and results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketgrain import schemas
from ticketgrain.sources.positions import with_positions


def path_exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, na_values: Sequence[str] = ()
) -> DataFrame:
    """CSV with a header whose quoted fields may hold newlines and doubled quotes.

    ``na_values`` lists texts that mean null.  A file with newlines in fields is
    read by one task, so write many part files, or parquet.
    """
    df = (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )
    if not na_values:
        return df
    replaced = {
        f.name: F.when(~F.col(f.name).isin(list(na_values)), F.col(f.name))
        for f in schema.fields
        if isinstance(f.dataType, T.StringType)
    }
    return df.withColumns(replaced)


def load_split(
    spark: SparkSession, base: str, split: str, schema: T.StructType = schemas.PROCESSED_TICKETS,
    na_values: Sequence[str] = (),
) -> DataFrame:
    """One split of a processed ticket table: parquet partition or tickets_<split>.csv."""
    partition = f"{base}/split={split}"
    if path_exists(spark, partition):
        # the partition value is pruned from the folder names
        return spark.read.parquet(base).filter(F.col("split") == split)
    path = f"{base}/tickets_{split}.csv"
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    return read_csv(spark, path, schema, na_values)


def load_dataset(spark: SparkSession, path: str) -> DataFrame:
    """A dataset kept as parquet."""
    return spark.read.parquet(path)


def read_json_records(spark: SparkSession, path: str, schema: T.StructType, array: bool = False) -> DataFrame:
    """Records from JSON lines (splittable), or from files holding one JSON array each."""
    return spark.read.schema(schema).option("multiLine", array).json(path)


def read_json_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Records of files that hold one JSON array each, numbered over all files as ``sample_id``.

    For files without keys, where the order is the only link between two of them.  A file is parsed
    by one task as a stream of records; several files are parsed side by side and numbered in the
    order of their paths, each by its place in the array.
    """
    return with_positions(read_json_records(spark, path, schema, array=True), "sample_id")


def load_evaluations(spark: SparkSession, eval_dir: str) -> DataFrame:
    """Results of all models below a folder: the model name and its metrics.

    Reads ``<model>/evaluation_results.json`` (a file, or a folder of part files)
    and the ``model=<name>`` folders of ``write_results``.
    """
    files = (
        spark.read.schema(schemas.EVALUATION_RESULTS)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json")
        .option("multiLine", True)
        .json(eval_dir)
    )
    path = F.url_decode(F.regexp_replace("_metadata.file_path", "\\+", "%2B"))
    named = F.regexp_extract(path, "([^/]+)/evaluation_results\\.json(?:/[^/]*)?$", 1)
    written = F.regexp_extract(path, "/model=([^/]+)/part-[^/]*$", 1)
    model = F.coalesce(F.nullif(named, F.lit("")), F.nullif(written, F.lit("")))
    # other JSON files below the folder are no results
    return files.select(model.alias("model"), "aggregated.*").filter(F.col("model").isNotNull())


def load_results(spark: SparkSession, path: str) -> DataFrame:
    """Metrics of result files, wrapped in ``aggregated`` or not."""
    df = spark.read.schema(schemas.EVALUATION_RESULTS_ANY).option("multiLine", True).json(path)
    top = F.struct(*[F.col(n) for n in schemas.AGGREGATED.names])
    return df.select(F.coalesce("aggregated", top).alias("_m")).select("_m.*")
