"""Preparing ticket tables: filters, defaults, text assembly, instruction samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketgrain.functions import fixed_values as V
from ticketgrain.functions import prompts, text
from ticketgrain.operators.scaling import lookup_join, require_columns, stage


def filter_language(df: DataFrame, language: str = "en", column: str = "language") -> DataFrame:
    """Keep one language when the table has a language column; null languages go."""
    if column not in df.columns:
        return df
    return df.filter(F.col(column) == language)


def with_text(df: DataFrame, subject: str = "subject", body: str = "body") -> DataFrame:
    """Add text, n_chars, n_words and cleaned_text to a raw ticket table."""
    require_columns(df, [subject, body])
    out = df.withColumn("text", text.ticket_text(F.col(subject), F.col(body)))
    return out.withColumns(
        {
            "n_chars": text.char_count(F.col("text")),
            "n_words": text.word_count(F.col("text")),
            "cleaned_text": text.basic_clean(F.col("text")),
        }
    )


def with_defaults(df: DataFrame, text_column: str = "text", label_column: str = "priority") -> DataFrame:
    """Null text becomes '', a null label the default priority; both are strings."""
    require_columns(df, [text_column, label_column])
    return df.withColumns(
        {
            text_column: F.coalesce(F.col(text_column).cast("string"), F.lit("")),
            label_column: F.coalesce(F.col(label_column).cast("string"), F.lit(V.DEFAULT_PRIORITY)),
        }
    )


def with_preview(df: DataFrame, column: str, chars: int, name: str) -> DataFrame:
    return df.withColumn(name, text.preview(F.col(column), chars))


def first_per_class(
    df: DataFrame, label: str, row_id: str, text_column: str = "text", chars: int = 200
) -> DataFrame:
    """The earliest row of each class, text cut to ``chars``.

    Only ids are aggregated over the whole table; the text is read for the winning
    ids alone, so no text is shuffled while the classes are few.
    """
    winners = stage(df.groupBy(label).agg(F.min(row_id).alias(row_id)).select(row_id))
    example = text.preview(F.col(text_column), chars).alias("example")
    return lookup_join(df, winners, [row_id], "inner").select(label, row_id, example)


def _label(df: DataFrame, column: str, null_label: str) -> Column:
    if column not in df.columns:
        return F.lit(null_label)
    return F.coalesce(F.col(column).cast("string"), F.lit(null_label))


def _tags(df: DataFrame) -> Column:
    present = [F.col(c) for c in V.TAG_COLUMNS if c in df.columns]
    return text.format_tags(present) if present else F.lit("None")


def _text_column(df: DataFrame, column: str) -> Column:
    return F.col(column) if column in df.columns else F.lit("")


def instruction_samples(
    df: DataFrame,
    task: str = "multi_task",
    keep: Sequence[str] = (),
    null_type: str = V.DEFAULT_LABEL,
    null_queue: str = V.DEFAULT_LABEL,
    null_priority: str = V.DEFAULT_PRIORITY,
) -> DataFrame:
    """Instruction, input and output of one task for every ticket, before validation.

    ``task`` is response_generation, multi_task or classification.
    """
    answer = text.clean_text(_text_column(df, "answer"))
    ticket_type = _label(df, "type", null_type)
    queue = _label(df, "queue", null_queue)
    priority = _label(df, "priority", null_priority)
    if task == "response_generation":
        instruction, output = V.RESPONSE_INSTRUCTION, answer
    elif task == "multi_task":
        instruction = V.MULTI_TASK_INSTRUCTION
        output = prompts.multi_task_output(ticket_type, queue, priority, _tags(df), answer)
    elif task == "classification":
        instruction = V.CLASSIFICATION_INSTRUCTION
        output = prompts.classification_output(ticket_type, queue, priority)
    else:
        raise ValueError(f"unknown task type: {task}")
    user_input = prompts.ticket_input(_text_column(df, "subject"), _text_column(df, "body"))
    return df.select(
        *keep, F.lit(instruction).alias("instruction"), user_input.alias("input"), output.alias("output")
    )


def valid_samples(samples: DataFrame) -> DataFrame:
    """Samples whose input and output are both non-empty."""
    return samples.filter((F.col("input") != "") & (F.col("output") != ""))


def sample_counts(samples: DataFrame) -> DataFrame:
    """How many samples are kept and how many are skipped."""
    valid = F.coalesce((F.col("input") != "") & (F.col("output") != ""), F.lit(False))
    return samples.agg(F.count_if(valid).alias("kept"), F.count_if(~valid).alias("skipped"))
