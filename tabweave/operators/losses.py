"""Batch and epoch losses of scored rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabweave.functions.scores import class_weight, negative_log_likelihood, squared_error


def weighted_cross_entropy(
    logits: str, label: str, weights: Sequence[float] | None = None, num_classes: int = 2
) -> Column:
    """sum(w * nll) / sum(w), as an aggregate column."""
    w = class_weight(F.col(label), weights)
    nll = negative_log_likelihood(F.col(logits), F.col(label), num_classes)
    return F.try_divide(F.sum(w * nll), F.sum(w))


def batch_cross_entropy(
    df: DataFrame,
    batch: str,
    logits: str,
    label: str,
    weights: Sequence[float] | None = None,
    num_classes: int = 2,
) -> DataFrame:
    """``batch, n, loss`` with the class-weighted cross-entropy of a batch."""
    return df.groupBy(F.col(batch).alias("batch")).agg(
        F.count(F.lit(1)).alias("n"), weighted_cross_entropy(logits, label, weights, num_classes).alias("loss")
    )


def batch_squared_error(df: DataFrame, batch: str, predicted: str, label: str) -> DataFrame:
    """``batch, n, loss`` with the mean squared error of a batch."""
    return df.groupBy(F.col(batch).alias("batch")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(squared_error(F.col(label), F.col(predicted))).alias("loss")
    )


def epoch_loss(batches: DataFrame) -> DataFrame:
    """Plain mean of batch losses: a short batch counts as much as a full one."""
    return batches.agg(F.avg("loss").alias("loss"))
