"""Column expressions on model outputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _softmax_parts(logits: Column, num_classes: int) -> tuple[Column, list[Column]]:
    """The largest logit and exp(logit - largest) per class.

    Written out per class: array lambdas would leave generated code.
    """
    values = [F.element_at(logits, i + 1) for i in range(num_classes)]
    top = F.greatest(*values)
    return top, [F.exp(v - top) for v in values]


def _total(values: Sequence[Column]) -> Column:
    total = values[0]
    for v in values[1:]:
        total = total + v
    return total


def positive_probability(logits: Column, num_classes: int = 2) -> Column:
    """Softmax of the logits, second class."""
    _, parts = _softmax_parts(logits, num_classes)
    return parts[1] / _total(parts)


def argmax_class(logits: Column) -> Column:
    """Index of the largest logit, the first on ties."""
    return (F.array_position(logits, F.array_max(logits)) - 1).cast("int")


def regression_value(logits: Column) -> Column:
    """The single output as a number."""
    return F.element_at(logits, 1)


def decide(probability: Column, cutoff: float | Column = 0.5) -> Column:
    """1 from the cutoff upwards, the cutoff included. NaN reaches no cutoff."""
    limit = cutoff if isinstance(cutoff, Column) else F.lit(cutoff)
    return ((probability >= limit) & ~F.isnan(probability) & ~F.isnan(limit)).cast("int")


def negative_log_likelihood(logits: Column, label: Column, num_classes: int = 2) -> Column:
    """log(sum(exp)) minus the logit of the true class."""
    top, parts = _softmax_parts(logits, num_classes)
    return top + F.log(_total(parts)) - F.element_at(logits, label.cast("int") + 1)


def squared_error(actual: Column, predicted: Column) -> Column:
    difference = actual.cast("double") - predicted.cast("double")
    return difference * difference


def class_weight(label: Column, weights: Sequence[float] | None) -> Column:
    if weights is None:
        return F.lit(1.0)
    return F.element_at(F.array(*[F.lit(float(w)) for w in weights]), label.cast("int") + 1)
