"""Command line of the jobs: ``python -m ticketgrain <job> ...``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from ticketgrain import jobs, schemas
from ticketgrain.session import remove_scratch
from ticketgrain.sources import readers


def main() -> None:
    parser = argparse.ArgumentParser(prog="ticketgrain")
    commands = parser.add_subparsers(dest="job", required=True)

    splits = commands.add_parser("prepare-splits", help="filter, assemble and split raw tickets")
    splits.add_argument("raw")
    splits.add_argument("out")
    splits.add_argument("--language", default="en")
    splits.add_argument("--stratify-by", default="queue")
    splits.add_argument("--row-id")

    samples = commands.add_parser("prepare-instructions", help="instruction samples of every split")
    samples.add_argument("splits")
    samples.add_argument("out")
    samples.add_argument("--task", default="multi_task")
    samples.add_argument("--max-samples", type=int)
    samples.add_argument("--row-id")

    scores = commands.add_parser("evaluate", help="score predictions against references")
    scores.add_argument("predictions")
    scores.add_argument("references")
    scores.add_argument("out")
    scores.add_argument("--task", default="multi_task")
    scores.add_argument("--review-rows", type=int, default=100)
    scores.add_argument("--arrays", action="store_true", help="both are single JSON array files, paired by position")

    models = commands.add_parser("compare", help="compare all evaluated models below a folder")
    models.add_argument("eval_dir")
    models.add_argument("out")

    profile = commands.add_parser("profile", help="profile a split ticket table")
    profile.add_argument("splits")
    profile.add_argument("out")
    profile.add_argument("--label", default="priority")

    args = parser.parse_args()
    spark = SparkSession.builder.appName(f"ticketgrain-{args.job}").getOrCreate()
    if args.job == "prepare-splits":
        done = jobs.prepare_splits(spark, args.raw, args.out, args.language, args.stratify_by, args.row_id)
    elif args.job == "prepare-instructions":
        done = jobs.prepare_instructions(spark, args.splits, args.out, args.task, args.max_samples, args.row_id)
    elif args.job == "evaluate":
        tables = []
        for path in (args.predictions, args.references):
            if args.arrays:
                tables.append(readers.read_json_array(spark, path, schemas.INSTRUCTION_SAMPLES))
            else:
                tables.append(readers.read_json_records(spark, path, schemas.PREDICTIONS))
        done = jobs.evaluate(spark, *tables, args.out, args.task, args.review_rows)
    elif args.job == "compare":
        done = jobs.compare(spark, args.eval_dir, args.out)
    else:
        done = jobs.profile(spark, args.splits, args.out, args.label)
    done.show(20, truncate=60)
    remove_scratch(spark)


if __name__ == "__main__":
    main()
