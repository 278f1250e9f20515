"""Class counts and inverse-frequency weights."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def class_counts(df: DataFrame, label: str, num_classes: int = 2) -> DataFrame:
    """``class_id, n, total`` for ids 0 to num_classes - 1; absent classes have n = 0.

    One grouped count. ``total`` counts every row, also rows of other classes. The completion works
    on at most num_classes + 1 grouped rows.
    """
    known = F.when(F.col(label).between(0, num_classes - 1), F.col(label).cast("int"))
    grouped = df.groupBy(F.coalesce(known, F.lit(-1)).alias("class_id")).agg(F.count(F.lit(1)).alias("n"))
    one = grouped.agg(
        F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("total"),
        F.map_from_entries(F.collect_list(F.struct("class_id", "n"))).alias("by_class"),
    )
    ids = F.explode(F.sequence(F.lit(0), F.lit(num_classes - 1)))
    return one.select(ids.alias("class_id"), "by_class", "total").select(
        "class_id", F.coalesce(F.col("by_class")[F.col("class_id")], F.lit(0).cast("long")).alias("n"), "total"
    )


def class_weights(df: DataFrame, label: str, num_classes: int = 2) -> DataFrame:
    """``class_id, n, weight`` with weight = total / (num_classes * max(n, 1)). Fit on train only."""
    safe = F.greatest(F.col("n"), F.lit(1))
    return class_counts(df, label, num_classes).select(
        "class_id", "n", (F.col("total") / (F.lit(num_classes) * safe)).alias("weight")
    )


def weight_list(weights: DataFrame) -> list[float]:
    """Weights on the driver, by class id (num_classes rows)."""
    return [r["weight"] for r in sorted(weights.collect(), key=lambda r: r["class_id"])]
