"""Writing splits, samples, predictions, results and manifests."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketgrain import schemas
from ticketgrain.functions import fixed_values as V
from ticketgrain.operators.experiments import replace_by_key


def write_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    """CSV that ``read_csv`` reads back unchanged (blanks, newlines, quotes kept)."""
    (
        df.write.mode(mode)
        .option("header", True)
        .option("quoteAll", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_splits(df: DataFrame, base: str, mode: str = "error", split: str = "split") -> None:
    """Parquet, one folder per split, so reading one split reads only its files."""
    df.write.mode(mode).partitionBy(split).parquet(base)


def write_samples(samples: DataFrame, path: str, mode: str = "error") -> None:
    """Instruction samples as JSON lines in UTF-8; empty or null fields stay visible."""
    samples.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_json_arrays(samples: DataFrame, path: str, mode: str = "error") -> None:
    """One JSON array for each partition, one record a line; null fields stay visible."""

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = None  # a record waits for the next one, which tells that a comma follows
        yield pd.DataFrame({"value": ["["]})
        for batch in batches:
            records = batch["value"].tolist()
            if records:
                ready = [*([] if last is None else [last]), *records[:-1]]
                last = records[-1]
                yield pd.DataFrame({"value": [f"{r}," for r in ready]}, dtype="object")
        yield pd.DataFrame({"value": [*([] if last is None else [last]), "]"]})

    written = samples.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
    written.mapInPandas(lines, "value string").write.mode(mode).option("lineSep", "\n").format("text").save(path)


def write_predictions(scored: DataFrame, path: str, mode: str = "error") -> None:
    """instruction, input, output, reference (with any leading key columns)."""
    scored.write.mode(mode).option("ignoreNullFields", False).json(path)


def evaluation_record(aggregate: DataFrame) -> DataFrame:
    """The one-row aggregate as nested ``aggregated`` plus ``sample_count``."""
    names = [n for n in schemas.AGGREGATED.names if n in aggregate.columns]
    return aggregate.select(F.struct(*names).alias("aggregated"), "sample_count")


def write_evaluation(aggregate: DataFrame, path: str, mode: str = "error") -> None:
    evaluation_record(aggregate).write.mode(mode).json(path)


def write_results(models: DataFrame, base: str, mode: str = "error") -> None:
    """A result folder per model: <base>/model=<name>/, readable by ``load_evaluations``.

    ``models`` has model, aggregated and sample_count.
    """
    models.write.mode(mode).partitionBy("model").json(base)


def write_experiments(runs: DataFrame, summary: DataFrame, base: str, mode: str = "error") -> None:
    """Nested run records as JSON, the flat summary as CSV."""
    runs.write.mode(mode).json(f"{base}/experiments")
    write_csv(summary, f"{base}/summary", mode)


def write_review(template: DataFrame, path: str, mode: str = "error") -> None:
    """Human-review sheet (UTF-8, no byte-order mark)."""
    write_csv(template, path, mode)


def manifest_entries(spark: SparkSession, task: str) -> DataFrame:
    """The three dataset entries of a task."""
    rows = [
        (f"ticket_{task}_{s}", f"{V.MANIFEST_FORMAT}_{task}_{s}.json", V.MANIFEST_FORMAT)
        for s in V.MANIFEST_SPLITS
    ]
    return spark.createDataFrame(rows, schemas.MANIFEST)


def merge_manifest(existing: DataFrame | None, new: DataFrame) -> DataFrame:
    """New entries win over existing ones of the same name, others stay."""
    if existing is None:
        return new
    return replace_by_key(existing, new, ["name"])
