"""Precision-recall curve and the decision thresholds picked from it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabweave.operators.ordered import ROWS_PER_SLICE, Running, assign_slices, plan_slices, running

# The result when there is no threshold to choose from, and the default minimum recall.
NO_THRESHOLD = 0.5
DEFAULT_MIN_RECALL = 0.5


def precision_recall_curve(
    df: DataFrame, actual: str, score: str, rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """``threshold, precision, recall, tp, predicted_pos`` for each distinct score.

    A threshold predicts 1 for ``score >= threshold``. Rows are counted per score first (on the map
    side), then the counts are summed from the highest score down. Without positives recall is 1.
    """
    scored = df.filter(F.col(score).isNotNull()).select(
        F.col(score).cast("double").alias("threshold"), (F.col(actual).cast("int") == 1).alias("positive")
    )
    slicing = plan_slices(scored, "threshold", rows_per_slice, also={"positives": F.count_if("positive")})
    points = scored.groupBy("threshold").agg(
        F.count_if("positive").alias("score_pos"), F.count(F.lit(1)).alias("score_n")
    )
    summed = running(
        assign_slices(points, "threshold", slicing),
        {"tp": Running("sum", F.col("score_pos")), "predicted_pos": Running("sum", F.col("score_n"))},
        "threshold",
        single_slice=slicing.single,
        descending=True,
    )
    positives = slicing.also["positives"]
    return summed.select(
        "threshold",
        (F.col("tp") / F.col("predicted_pos")).alias("precision"),
        (F.col("tp") / F.lit(positives) if positives else F.lit(1.0)).alias("recall"),
        "tp",
        "predicted_pos",
    )


def pick_threshold(curve: DataFrame, strategy: str = "f1", min_recall: float = DEFAULT_MIN_RECALL) -> DataFrame:
    """The best point of a curve: one aggregate, so the curve is neither sorted nor collected."""
    precision, recall = F.col("precision"), F.col("recall")
    lowest_first = -F.col("threshold")
    if strategy == "f1":
        f1 = F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0))
        merit = F.struct(f1, lowest_first)
    elif strategy == "min_recall":
        enough = recall >= F.lit(min_recall)
        merit = F.struct(enough, F.when(enough, precision).otherwise(recall), lowest_first)
    else:
        raise ValueError(f"strategy '{strategy}' is neither 'f1' nor 'min_recall'")
    best = curve.agg(F.max_by(F.struct("threshold", "precision", "recall"), merit).alias("b"))
    return best.select(
        F.coalesce("b.threshold", F.lit(NO_THRESHOLD)).alias("threshold"),
        F.coalesce("b.precision", F.lit(0.0)).alias("precision"),
        F.coalesce("b.recall", F.lit(0.0)).alias("recall"),
    )
