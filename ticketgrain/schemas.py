"""Declared schemas of the tables the library reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

from ticketgrain.functions.fixed_values import TAG_COLUMNS

_S = T.StringType()


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, _S) for n in names]


RAW_TICKETS = T.StructType(
    _strings("subject", "body", "answer", "type", "queue", "priority", "language", *TAG_COLUMNS)
)
PROCESSED_TICKETS = T.StructType(
    RAW_TICKETS.fields
    + _strings("text")
    + [T.StructField("n_chars", T.LongType()), T.StructField("n_words", T.LongType())]
)
INSTRUCTION_SAMPLES = T.StructType(_strings("instruction", "input", "output"))
PREDICTIONS = T.StructType(
    [T.StructField("sample_id", T.LongType())] + _strings("instruction", "input", "output", "reference")
)
MANIFEST = T.StructType(_strings("name", "file_name", "formatting"))
AGGREGATED = T.StructType(
    [
        T.StructField(n, T.DoubleType())
        for n in (
            "avg_rouge1_f", "std_rouge1_f", "avg_rouge2_f", "std_rouge2_f", "avg_rougeL_f", "std_rougeL_f",
            "avg_bleu", "type_accuracy", "queue_accuracy", "priority_accuracy",
            "avg_pred_length", "avg_ref_length",
        )
    ]
)
EVALUATION_RESULTS = T.StructType(
    [T.StructField("aggregated", AGGREGATED), T.StructField("sample_count", T.LongType())]
)
# A result file is either wrapped in "aggregated" or holds the metrics at the top.
EVALUATION_RESULTS_ANY = T.StructType(EVALUATION_RESULTS.fields + AGGREGATED.fields)
EPOCH = T.StructType(
    [T.StructField("epoch", T.IntegerType())]
    + [
        T.StructField(n, T.DoubleType())
        for n in ("train_loss", "train_acc", "train_f1_macro", "val_acc", "val_f1_macro", "val_f1_weighted")
    ]
)
EXPERIMENTS = T.StructType(
    [
        T.StructField(
            "config",
            T.StructType(
                [
                    T.StructField("name", _S),
                    T.StructField("model_name", _S),
                    T.StructField("lr", T.DoubleType()),
                    T.StructField("epochs", T.IntegerType()),
                    T.StructField("freeze_bert", T.BooleanType()),
                    T.StructField("batch_size", T.IntegerType()),
                    T.StructField("description", _S),
                ]
            ),
        ),
        T.StructField("epochs", T.ArrayType(EPOCH)),
        T.StructField("best_val_f1_macro", T.DoubleType()),
    ]
)
SUBMISSIONS = T.StructType(
    [T.StructField("key", T.LongType())]
    + _strings("subject", "body")
    + [T.StructField("created_at", T.TimestampType())]
)
ACTIONS = T.StructType(
    [
        T.StructField("ticket_id", T.LongType()),
        T.StructField("action_id", T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("action", _S),
        T.StructField("text", _S),
        T.StructField("reviewer", _S),
    ]
)
