"""Measures of generated replies against references.

Everything is computed inside the pair's row: after the pair join nothing is shuffled.
Stemming, clipped n-gram overlaps and subsequences are small Python helpers over Arrow batches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketgrain.functions import extraction
from ticketgrain.functions import fixed_values as V
from ticketgrain.functions import text as tx
from ticketgrain.functions.lcs import lcs_tokens
from ticketgrain.functions.overlaps import overlaps
from ticketgrain.functions.porter import stem_words


def pair_by_key(predictions: DataFrame, references: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Predictions and references that share a sample key (the shorter side decides)."""
    return predictions.join(references, list(keys), "inner")


def pair_by_position(predictions: DataFrame, references: DataFrame, position: str = "sample_id") -> DataFrame:
    """The n-th prediction with the n-th reference; what the longer side has more is left out.

    Both sides carry their places (``sources.positions``), which are unique.  Other columns must
    have different names.
    """
    return predictions.join(references, position, "inner")


def with_responses(pairs: DataFrame, task: str = "multi_task") -> DataFrame:
    """For multi-task output compare only what follows the response label."""
    if task != "multi_task":
        return pairs
    return pairs.withColumns(
        {
            "predicted_fields": extraction.extract_classification(F.col("prediction")),
            "prediction": extraction.extract_response(F.col("prediction")),
            "reference": extraction.extract_response(F.col("reference")),
        }
    )


def _with_tokens(pairs: DataFrame, keep: Sequence[str], use_stemmer: bool) -> DataFrame:
    """Columns ``keep``, ROUGE tokens (_rp, _rq) and BLEU tokens (_bp, _bq) of both texts."""

    def rouge(name: str) -> Column:
        plain = tx.rouge_words(F.col(name))
        return stem_words(plain) if use_stemmer else plain

    return pairs.select(
        *keep,
        rouge("prediction").alias("_rp"),
        rouge("reference").alias("_rq"),
        tx.bleu_words(F.col("prediction")).alias("_bp"),
        tx.bleu_words(F.col("reference")).alias("_bq"),
    )


def _grams(tokens: str, n: int) -> Column:
    """How many n-grams a token column has."""
    return F.greatest(F.size(tokens) - (n - 1), F.lit(0)).cast("long")


def _prf(overlap: Column, n_pred: Column, n_ref: Column, prefix: str) -> list[Column]:
    precision = F.coalesce(F.try_divide(overlap, n_pred), F.lit(0.0))
    recall = F.coalesce(F.try_divide(overlap, n_ref), F.lit(0.0))
    # 2PR/(P+R) on counts
    f = F.coalesce(F.try_divide(2 * overlap, n_pred + n_ref), F.lit(0.0))
    return [precision.alias(f"{prefix}_p"), recall.alias(f"{prefix}_r"), f.alias(f"{prefix}_f")]


def _bleu() -> Column:
    """Sentence BLEU-4 with zero counts smoothed to 0.1 / length; 0 without a common word."""
    total = F.lit(0.0)
    for n in (1, 2, 3, 4):
        hits = F.col(f"_b.n{n}")
        smoothed = F.when(hits == 0, F.lit(V.BLEU_EPSILON)).otherwise(hits)
        total = total + F.log(smoothed / F.greatest(_grams("_bp", n), F.lit(1))) * 0.25
    length, wanted = F.size("_bp"), F.size("_bq")
    # the guard keeps the quotient defined; an empty prediction scores 0 anyway
    brevity = F.when(length > wanted, F.lit(1.0)).otherwise(
        F.exp(1.0 - wanted / F.greatest(length, F.lit(1)))
    )
    return F.when(F.col("_b.n1") == 0, F.lit(0.0)).otherwise(brevity * F.exp(total))


def _overlap_figures() -> list[Column]:
    rouge = [c for n in (1, 2) for c in _prf(F.col(f"_r.n{n}"), _grams("_rp", n), _grams("_rq", n), f"rouge{n}")]
    return [*rouge, _bleu().alias("bleu"), _grams("_bp", 1).alias("pred_length"), _grams("_bq", 1).alias("ref_length")]


def _counted(tokens: DataFrame) -> DataFrame:
    return tokens.withColumns(
        {"_r": overlaps(F.col("_rp"), F.col("_rq"), 2), "_b": overlaps(F.col("_bp"), F.col("_bq"), 4)}
    )


def overlap_scores(pairs: DataFrame, keys: Sequence[str], use_stemmer: bool = True) -> DataFrame:
    """ROUGE-1/2 precision, recall, F, sentence BLEU and word counts of every pair."""
    return _counted(_with_tokens(pairs, list(keys), use_stemmer)).select(*keys, *_overlap_figures())


def pair_lengths(pairs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Word counts of both texts."""
    lengths = {"pred_length": "prediction", "ref_length": "reference"}
    return pairs.select(
        *keys, *[F.size(tx.bleu_words(F.col(text))).cast("long").alias(name) for name, text in lengths.items()]
    )


def rouge_l(pairs: DataFrame, use_stemmer: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """ROUGE-L precision, recall and F of every pair, whole texts, row by row."""
    common = _with_tokens(pairs, list(keep), use_stemmer).withColumn("_lcs", lcs_tokens("_rp", "_rq"))
    return common.select(*keep, *_prf(F.col("_lcs"), F.size("_rp"), F.size("_rq"), "rougeL"))


def evaluate_samples(
    pairs: DataFrame, keys: Sequence[str], task: str = "multi_task", use_stemmer: bool = True
) -> DataFrame:
    """All measures per sample.

    ``pairs`` has the keys, prediction, reference and, optionally for multi-task
    output, ``expected`` (struct of type, queue, priority).
    """
    ready = with_responses(pairs, task)
    fields = ["predicted_fields", "expected"] if task == "multi_task" and "expected" in pairs.columns else []
    tokens = _with_tokens(ready, [*keys, *fields], use_stemmer)
    measured = _counted(tokens).withColumn("_lcs", lcs_tokens("_rp", "_rq"))
    figures = [*_overlap_figures(), *_prf(F.col("_lcs"), F.size("_rp"), F.size("_rq"), "rougeL")]
    if fields:
        correct = F.struct(
            *[
                F.col(f"predicted_fields.{f}").eqNullSafe(F.col(f"expected.{f}")).alias(f)
                for f in ("type", "queue", "priority")
            ]
        )
        figures += [F.col("predicted_fields"), correct.alias("classification_correct")]
    return measured.select(*keys, *figures)


def aggregate_samples(samples: DataFrame) -> DataFrame:
    """One row: means and population deviations of the ROUGE F values, mean BLEU,
    field accuracies when present, mean lengths, sample count."""
    figures = []
    for name in ("rouge1_f", "rouge2_f", "rougeL_f"):
        if name in samples.columns:
            figures += [F.avg(name).alias(f"avg_{name}"), F.stddev_pop(name).alias(f"std_{name}")]
    figures.append(F.avg("bleu").alias("avg_bleu"))
    if "classification_correct" in samples.columns:
        figures += [
            F.avg(F.col(f"classification_correct.{f}").cast("double")).alias(f"{f}_accuracy")
            for f in ("type", "queue", "priority")
        ]
    figures += [
        F.avg("pred_length").alias("avg_pred_length"),
        F.avg("ref_length").alias("avg_ref_length"),
        F.count(F.lit(1)).alias("sample_count"),
    ]
    return samples.agg(*figures)


def rouge_l_bands(samples: DataFrame, score: str = "rougeL_f") -> DataFrame:
    """Samples and share per quality band; a missing score counts as 0."""
    value = F.coalesce(F.col(score), F.lit(0.0))
    band = (
        F.when(value > V.ROUGE_L_EXCELLENT, F.lit("excellent"))
        .when(value >= V.ROUGE_L_GOOD, F.lit("good"))
        .otherwise(F.lit("fair"))
    )
    counts = samples.agg(
        *[F.count_if(band == name).alias(name) for name in ("excellent", "good", "fair")],
        F.count(F.lit(1)).alias("_n"),
    )
    rows = F.array(
        *[F.struct(F.lit(name).alias("band"), F.col(name).alias("n")) for name in ("excellent", "good", "fair")]
    )
    return counts.select("_n", F.inline(rows)).select(
        "band", "n", F.coalesce(F.try_divide("n", "_n"), F.lit(0.0)).alias("share")
    )


def length_ratio(samples: DataFrame) -> DataFrame:
    """Mean prediction words / mean reference words."""
    return samples.agg(
        F.avg("pred_length").alias("avg_pred_length"), F.avg("ref_length").alias("avg_ref_length")
    ).withColumn("ratio", F.try_divide("avg_pred_length", "avg_ref_length"))
