"""Linear baselines the network is compared with."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabweave.functions.scores import class_weight

# Names under which baseline and network runs are recorded.
BASELINE_NAME = {"classification": "baseline_logistic_regression", "regression": "baseline_linear_regression"}
NETWORK_NAME = "mlp"


def _vectors(df: DataFrame) -> DataFrame:
    return df.withColumn("__vector", array_to_vector(F.col("features").cast("array<double>")))


def fit_logistic(
    df: DataFrame, weights: Sequence[float] | None = None, max_iter: int = 100, tol: float = 1e-8
) -> LogisticRegressionModel:
    """Unpenalised logistic regression on ``features, label``, rows weighted by class if given."""
    rows = _vectors(df).withColumn("__weight", class_weight(F.col("label"), weights))
    return LogisticRegression(
        featuresCol="__vector", labelCol="label", weightCol="__weight", maxIter=max_iter, tol=tol
    ).fit(rows.select("__vector", "__weight", F.col("label").cast("double").alias("label")))


def fit_linear(df: DataFrame) -> LinearRegressionModel:
    """Least squares on ``features, label``."""
    return LinearRegression(featuresCol="__vector", labelCol="label", solver="auto").fit(
        _vectors(df).select("__vector", F.col("label").cast("double").alias("label"))
    )


def score_logistic(df: DataFrame, model: LogisticRegressionModel) -> DataFrame:
    """Add ``p1``, the probability of class 1."""
    scored = model.transform(_vectors(df))
    return scored.select(*df.columns, F.element_at(vector_to_array("probability"), 2).alias("p1"))


def score_linear(df: DataFrame, model: LinearRegressionModel) -> DataFrame:
    """Add ``pred``."""
    return model.transform(_vectors(df)).select(*df.columns, F.col("prediction").alias("pred"))


def coefficient_table(model: LogisticRegressionModel | LinearRegressionModel, names: Sequence[str]) -> list[tuple]:
    """(term, value) with the intercept first."""
    return [("intercept", float(model.intercept)), *zip(names, (float(v) for v in model.coefficients))]
