"""Fitted steps on streaming frames.

Fitting needs whole tables, but cleaning, encoding, scaling and scoring are narrow and free of
actions, so they run on a stream as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tabweave.operators.encode import assemble, fill_categories
from tabweave.operators.network import MLPSpec, Parameters
from tabweave.operators.scoring import score_mlp, with_predictions
from tabweave.plans.prepare import Prepared, clean


def prepare_stream(stream: DataFrame, fitted: Prepared) -> DataFrame:
    """Clean and transform arriving rows with what was fitted on the training split."""
    return fitted.apply(clean(stream, list(fitted.vocabulary)))


def score_stream(
    stream: DataFrame, fitted: Prepared, params: Parameters, spec: MLPSpec, mode: str, keep: Sequence[str]
) -> DataFrame:
    """Predictions for arriving rows that have an outcome; ``keep`` names key columns carried along."""
    features = assemble(prepare_stream(stream, fitted), mode, keep=keep)
    return with_predictions(score_mlp(features, params, spec, keep=[*keep, "label"]), mode, spec.num_classes)


def score_open(
    stream: DataFrame, fitted: Prepared, params: Parameters, spec: MLPSpec, mode: str, keep: Sequence[str]
) -> DataFrame:
    """Predictions for every arriving row; neither a status nor a label is needed, and none is looked at."""
    encoded = fitted.apply(fill_categories(stream, list(fitted.vocabulary)))
    features = assemble(encoded, None, keep=keep)
    return with_predictions(score_mlp(features, params, spec, keep=keep), mode, spec.num_classes)
