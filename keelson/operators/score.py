"""Batch scoring and scoring metadata."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from datetime import datetime

import numpy as np
import pandas as pd
from pyspark.errors import (
    AnalysisException, ArithmeticException, IllegalArgumentException, NumberFormatException, PythonException,
    SparkRuntimeException,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.operators.features import select_supported

MODEL_ERRORS = (AnalysisException, ArithmeticException, IllegalArgumentException, NumberFormatException, PythonException,
                SparkRuntimeException)


def logistic(weights: Mapping[str, float], intercept: float = 0.0) -> Column:
    """Probability of a linear model as one generated expression."""
    z = F.lit(float(intercept))
    for name, weight in weights.items():
        z = z + F.lit(float(weight)) * F.col(name).cast("double")
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def as_label(probability: Column, cut: float = 0.5) -> Column:
    return F.when(probability > F.lit(cut), F.lit(1)).otherwise(F.lit(0))


def with_metadata(
    df: DataFrame, model_name: str, alias: str, version: str, at: datetime | Column | None = None
) -> DataFrame:
    """Scoring time and model coordinates; ``at`` pins the time."""
    return df.withColumns({
        "prediction_time": F.current_timestamp() if at is None else F.lit(at),
        "model_name": F.lit(model_name),
        "model_alias": F.lit(alias),
        "model_version": F.lit(str(version)),
    })


def batch_score(
    df: DataFrame, inputs: Sequence[str], predict: Column | Callable[..., Column],
    model_name: str, alias: str, version: str, at: datetime | Column | None = None, output: str = "prediction",
) -> DataFrame:
    """M1, M3: append the prediction and its metadata.

    ``predict`` is a column expression, or a UDF that is called with the input columns.
    """
    select_supported(df, inputs)
    prediction = predict if isinstance(predict, Column) else predict(*[F.col(c) for c in inputs])
    return with_metadata(df.withColumn(output, prediction), model_name, alias, version, at)


def ml_score(
    df: DataFrame, model, model_name: str, alias: str, version: str, at: datetime | Column | None = None
) -> DataFrame:
    """M1 for a fitted ``pyspark.ml`` model: prediction as int, positive-class probability."""
    from pyspark.ml.functions import vector_to_array

    scored = model.transform(df)
    drop = [c for c in scored.columns if c in ("rawPrediction", "features", "probability") or c.startswith("_in_")]
    if "probability" in scored.columns:
        scored = scored.withColumn("score", F.get(vector_to_array("probability"), F.lit(1)))
    scored = scored.withColumn("prediction", F.col("prediction").cast("int")).drop(*drop)
    return with_metadata(scored, model_name, alias, version, at)


def model_udf(load: Callable[[], Callable[[np.ndarray], np.ndarray]], result_type: str = "double"):
    """M2: an opaque model as a vectorised UDF.

    ``load`` runs once per Python worker task and returns ``predict(matrix) -> vector``;
    rows travel in Arrow batches.
    """

    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        predict = load()
        for columns in batches:
            matrix = np.column_stack([c.to_numpy(dtype="float64") for c in columns])
            yield pd.Series(predict(matrix))

    score.__annotations__ = {"batches": Iterator[tuple[pd.Series, ...]], "return": Iterator[pd.Series]}
    return F.pandas_udf(score, result_type)


def predicts(df: DataFrame, inputs: Sequence[str], predict) -> int:
    """M4: 1 when the model scores every row without an error and without a NULL, else 0.

    A failure of the model's own code or of its expressions is the finding; one of the cluster
    (a lost executor, a missing file) is raised.
    """
    try:
        prediction = predict if isinstance(predict, Column) else predict(*[F.col(c) for c in inputs])
        scored, rows = df.select(prediction.alias("p")).agg(F.count("p"), F.count(F.lit(1))).first()
    except MODEL_ERRORS:
        return 0
    return int(scored == rows)
