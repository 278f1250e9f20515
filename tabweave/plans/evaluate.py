"""Evaluation of scored rows as a metrics record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabweave.functions.scores import decide
from tabweave.operators.curve import DEFAULT_MIN_RECALL
from tabweave.operators.metrics import DEFAULT_CUTOFF, rates_of_counts, regression_metrics
from tabweave.operators.network import MLPSpec, Parameters
from tabweave.operators.scoring import score_mlp, with_predictions
from tabweave.operators.sparse_rows import Features
from tabweave.operators.threshold import best_threshold
from tabweave.storage import stage


def evaluate(
    df: DataFrame, actual: str, predicted: str, mode: str = "classification", threshold: float | None = None
) -> DataFrame:
    """One row of metrics for rows that played no part in fitting or in choosing the threshold.

    Classification takes the probability of class 1 and a cutoff (default 0.5) and adds the 2 by 2
    confusion matrix; regression takes the predicted value. One pass each: all classification
    metrics follow from the four cells. A label other than 0 and 1 is an error; rows without one are
    left out.
    """
    if mode == "regression":
        return regression_metrics(df, actual, predicted).select(F.lit(mode).alias("mode"), "*")
    if mode != "classification":
        raise ValueError(f"mode '{mode}' is neither 'classification' nor 'regression'")
    cutoff = DEFAULT_CUTOFF if threshold is None else float(threshold)
    y, p = F.col(actual).cast("int"), decide(F.col(predicted), cutoff)
    cells = df.agg(
        *[F.count_if((y == a) & (p == b)).alias(f"c{a}{b}") for a in (0, 1) for b in (0, 1)],
        F.count_if(~y.isin(0, 1)).alias("other"),
    )
    tn, fp, fn, tp = (F.col(c) for c in ("c00", "c01", "c10", "c11"))
    refused = F.raise_error(F.concat(F.col("other"), F.lit(" labels are neither 0 nor 1")))
    total = F.when(F.col("other") == 0, tn + fp + fn + tp).otherwise(refused.cast("long"))
    rates = rates_of_counts(tp, fp, fn)
    return cells.select(
        F.lit(mode).alias("mode"),
        F.lit(cutoff).alias("threshold"),
        F.try_divide((tp + tn).cast("double"), total).alias("accuracy"),
        *[rate.alias(name) for name, rate in rates.items()],
        F.array(F.array(tn, fp), F.array(fn, tp)).alias("confusion_matrix"),
    )


def metrics_record(result: DataFrame) -> dict:
    """The single row of :func:`evaluate` as a dictionary for the run history."""
    row = result.first().asDict()
    return {k: [list(r) for r in v] if k == "confusion_matrix" else v for k, v in row.items()}


def _predicted(
    df: DataFrame, params: Parameters, spec: MLPSpec, mode: str, label: str, features: Features
) -> DataFrame:
    return with_predictions(score_mlp(df, params, spec, features, keep=[label]), mode, spec.num_classes)


def evaluate_network(
    df: DataFrame,
    params: Parameters,
    spec: MLPSpec,
    mode: str = "classification",
    threshold: float | None = None,
    label: str = "label",
    features: Features = "features",
) -> DataFrame:
    """Score ``features, label`` rows and evaluate them; each row is scored once and then reduced."""
    predicted = _predicted(df, params, spec, mode, label, features)
    return evaluate(predicted, label, "p1" if mode == "classification" else "pred", mode, threshold)


def network_threshold(
    df: DataFrame,
    params: Parameters,
    spec: MLPSpec,
    strategy: str = "f1",
    min_recall: float = DEFAULT_MIN_RECALL,
    label: str = "label",
    features: Features = "features",
) -> DataFrame:
    """The best decision threshold of a network on validation rows.

    The search reads the scores several times, so labels and probabilities are stored first.
    """
    scores = stage(_predicted(df, params, spec, "classification", label, features).select(label, "p1"), "scores")
    return best_threshold(scores, label, "p1", strategy, min_recall)
