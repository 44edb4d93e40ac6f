"""Multinomial logistic regression and batch scoring."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketgrain.functions import prompts
from ticketgrain.operators.profiling import class_weights
from ticketgrain.operators.scaling import lookup_join, stage

Predictor = Callable[[pd.Series], pd.Series]
# The relative change of the objective at which a fit ends.
TOLERANCE = 1e-4


def fit_logistic_regression(
    df: DataFrame,
    features: str = "features",
    label: str = "label",
    c: float = 1.0,
    max_iter: int = 1000,
    balanced: bool = False,
    tol: float = TOLERANCE,
):
    """L2 multinomial regression with inverse strength ``c``.

    Rounds end when the objective changes by less than ``tol`` of itself, or after ``max_iter``;
    ``training_log`` shows them.

    Spark averages the loss over the row weights while ``c`` multiplies its sum,
    hence ``regParam = 1 / (c * sum of weights)``.  Pass staged vectors: they are
    read for the weights and once more by the estimator, which then caches them.
    """
    weight = "_weight"
    if balanced:
        weights = stage(class_weights(df, label).select(label, F.col("weight").alias(weight)))
        data = lookup_join(df, weights, [label], "inner")
    else:
        data = df.withColumn(weight, F.lit(1.0))
    data = data.select(features, label, weight)
    total = data.agg(F.sum(weight)).first()[0]
    estimator = LogisticRegression(
        featuresCol=features,
        labelCol=label,
        weightCol=weight,
        family="multinomial",
        regParam=1.0 / (c * total),
        elasticNetParam=0.0,
        standardization=False,
        maxIter=max_iter,
        tol=tol,
    )
    return estimator.fit(data)


def training_log(spark: SparkSession, model) -> DataFrame:
    """iteration, objective: a row for each round of a fitted (not a loaded) regression."""
    history = [(i, float(value)) for i, value in enumerate(model.summary.objectiveHistory)]
    return spark.createDataFrame(history, "iteration int, objective double")


def training_key(df: DataFrame, **parameters) -> str:
    """A digest of the training rows, in any order, and of the parameters of a fit.

    Two 64-bit hashes of each row are summed, so no row moves; column names and types count too.
    """
    whole = [F.col(f"`{c}`") for c in df.columns]
    hashed = [F.coalesce(F.sum(h.cast("decimal(38,0)")), F.lit(0)).cast("string") for h in (F.xxhash64(*whole), F.xxhash64(F.lit(1), *whole))]
    rows = tuple(df.agg(F.count(F.lit(1)).cast("string"), *hashed).first())
    told = [rows, df.dtypes, sorted((k, repr(v)) for k, v in parameters.items())]
    return hashlib.sha256(repr(told).encode()).hexdigest()


def predict(model, df: DataFrame, name: str = "predicted") -> DataFrame:
    """Arg-max class id of every row."""
    drop = [c for c in ("rawPrediction", "probability") if c not in df.columns]
    return model.transform(df).drop(*drop).withColumnRenamed("prediction", name)


def fit_or_load(spark: SparkSession, path: str, fit: Callable[[], PipelineModel], key: str | None = None) -> PipelineModel:
    """Load the pipeline saved at ``path``, or fit and save it.

    With ``key`` (see ``training_key``) a model is kept for each key below ``path``, so one of other
    rows or parameters is never taken.  A save that did not end is overwritten.
    """
    place = path if key is None else f"{path}/{key}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{place}/metadata/_SUCCESS")
    stages = spark._jvm.org.apache.hadoop.fs.Path(f"{place}/stages")
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.exists(folder) and system.exists(stages):
        return PipelineModel.load(place)
    model = fit()
    model.write().overwrite().save(place)
    return PipelineModel.load(place)


def score_prompts(
    samples: DataFrame,
    make_predictor: Callable[[], Predictor],
    template: str = "chat",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Generate an output for every sample with a caller-supplied predictor.

    ``make_predictor`` runs once per task and returns a function from a series of
    prompts to a series of texts, so a model is loaded once and fed Arrow batches.
    The sample's own output is kept as ``reference``.
    """
    spark_schema = samples.select(*keep, "instruction", "input").schema
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark_schema.fields)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        predictor = make_predictor()
        for batch in batches:
            reference = batch.pop("output")
            batch["output"] = predictor(batch.pop("_prompt")).str.strip()
            yield batch.assign(reference=reference)

    prompt = prompts.build_prompt(F.col("instruction"), F.col("input"), template).alias("_prompt")
    return samples.select(*keep, "instruction", "input", "output", prompt).mapInPandas(
        run, f"{schema}, output string, reference string"
    )
