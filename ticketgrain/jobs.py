"""The table-to-table jobs a ticket team runs, built from the operators.

Each reads tables, writes tables and returns what it wrote.  ``python -m
ticketgrain --help`` offers the same from a command line (or spark-submit).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketgrain import schemas
from ticketgrain.functions import extraction
from ticketgrain.functions import fixed_values as V
from ticketgrain.functions import naming
from ticketgrain.operators import comparison, profiling, sampling
from ticketgrain.operators import generation as gen
from ticketgrain.operators import tickets as tk
from ticketgrain.operators.scaling import global_row_number, stage
from ticketgrain.sources import readers, writers


def prepare_splits(
    spark: SparkSession, raw: str, out: str, language: str = "en", stratify_by: str = "queue", row_id: str | None = None
) -> DataFrame:
    """Raw parquet tickets -> filtered, assembled, split tickets, a folder per split.

    Without a unique ``row_id`` column the split order comes from a hash of the raw
    row; identical rows then fall on the same side.  Texts are assembled and cleaned
    after the split, once.
    """
    tickets = tk.filter_language(readers.load_dataset(spark, raw), language)
    key = row_id or "_row"
    if row_id is None:
        tickets = tickets.withColumn(key, F.sha2(F.to_json(F.struct(*tickets.columns)), 256))
    split = tk.with_text(sampling.stratified_split(tickets, key, stratify_by))
    writers.write_splits(split if row_id else split.drop(key), out, "overwrite")
    return spark.read.parquet(out)


def prepare_instructions(
    spark: SparkSession, splits: str, out: str, task: str = "multi_task", max_samples: int | None = None,
    row_id: str | None = None,
) -> DataFrame:
    """Instruction samples of every split and the manifest that lists them.

    ``max_samples`` takes the first tickets by ``row_id`` (by text without one).
    """
    for split in V.MANIFEST_SPLITS:
        tickets = readers.load_split(spark, splits, split)
        if max_samples is not None:
            tickets = sampling.head(tickets, max_samples, row_id or "text")
        samples = tk.valid_samples(tk.instruction_samples(tickets, task))
        writers.write_samples(samples, f"{out}/{V.MANIFEST_FORMAT}_{task}_{split}.json", "overwrite")
    path = f"{out}/dataset_info"
    old = None
    if readers.path_exists(spark, path):
        old = readers.read_json_records(spark, path, schemas.MANIFEST)
    # written elsewhere before its folder is replaced
    merged = stage(writers.merge_manifest(old, writers.manifest_entries(spark, task)))
    merged.write.mode("overwrite").json(path)
    return merged


def evaluate(
    spark: SparkSession, predictions: DataFrame, references: DataFrame, out: str, task: str = "multi_task",
    review_rows: int = 100,
) -> DataFrame:
    """Score predictions (sample_id, output) against references (sample_id, input, output).

    Writes the evaluation record, the band table and the human-review sheet below
    ``out`` and returns the per-sample measures.
    """
    pairs = gen.pair_by_key(
        predictions.select("sample_id", F.col("output").alias("prediction")),
        references.select("sample_id", "input", F.col("output").alias("reference")),
        ["sample_id"],
    )
    if task == "multi_task":
        pairs = pairs.withColumn("expected", extraction.extract_classification(F.col("reference")))
    gen.evaluate_samples(pairs, ["sample_id"], task).write.mode("overwrite").parquet(f"{out}/samples")
    samples = spark.read.parquet(f"{out}/samples")
    writers.write_evaluation(gen.aggregate_samples(samples), f"{out}/evaluation_results.json", "overwrite")
    gen.rouge_l_bands(samples).write.mode("overwrite").json(f"{out}/bands")
    writers.write_review(sampling.review_template(pairs, "sample_id", review_rows), f"{out}/review", "overwrite")
    return samples


def compare(spark: SparkSession, eval_dir: str, out: str) -> DataFrame:
    """Comparison table, scores and targets of all evaluated models below a folder."""
    found = readers.load_evaluations(spark, eval_dir).withColumn("family", F.lit("all"))
    # one family, in order of kind and name; the result files are read once
    by_kind = [naming.kind_of(F.col("model")), F.col("model")]
    found = stage(global_row_number(found, by_kind, "position"))
    table = comparison.comparison_table(found)
    table.write.mode("overwrite").json(f"{out}/models")
    comparison.weighted_score(found).write.mode("overwrite").json(f"{out}/scores")
    comparison.mean_accuracy(found).write.mode("overwrite").json(f"{out}/accuracies")
    best = comparison.best_model(found, "avg_rougeL_f")
    comparison.targets(best).write.mode("overwrite").json(f"{out}/targets")
    return table


def profile(spark: SparkSession, splits: str, out: str, label: str = "priority") -> DataFrame:
    """Sizes, quality, lengths and class profile of a split ticket table."""
    tickets = tk.with_defaults(spark.read.parquet(splits), "text", label)
    profiling.split_sizes(tickets).write.mode("overwrite").json(f"{out}/split_sizes")
    profiling.quality_profile(tickets).write.mode("overwrite").json(f"{out}/quality")
    profiling.length_stats(tickets).write.mode("overwrite").json(f"{out}/lengths")
    profiling.value_counts(tickets, ["queue", "priority", "type"]).write.mode("overwrite").json(f"{out}/values")
    per_class = profiling.class_profile(tickets, label)
    per_class.write.mode("overwrite").json(f"{out}/classes")
    return per_class
