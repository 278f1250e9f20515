"""Classification and regression metrics, each one pass over the scored rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_CUTOFF = 0.5


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """0 where the ratio is undefined."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))


def hit_counts(y: Column, p: Column) -> dict[str, Column]:
    """True positives, false positives and false negatives of class 1, as aggregate columns."""
    return {
        "tp": F.count_if((y == 1) & (p == 1)),
        "fp": F.count_if((y != 1) & (p == 1)),
        "fn": F.count_if((y == 1) & (p != 1)),
    }


def rates_of_counts(tp: Column, fp: Column, fn: Column) -> dict[str, Column]:
    return {
        "precision": ratio_or_zero(tp, tp + fp),
        "recall": ratio_or_zero(tp, tp + fn),
        "f1": ratio_or_zero(2 * tp, 2 * tp + fp + fn),
    }


def r2_of_sums(n: Column, squares: Column, spread: Column) -> Column:
    """1 - squares / spread; constant truth gives 1 if perfect, else 0; below two rows null."""
    constant = F.when(squares == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    r2 = F.when(spread == 0, constant).otherwise(1 - F.try_divide(squares, spread))
    return F.when(n >= 2, r2)


def confusion(df: DataFrame, actual: str, predicted: str, num_classes: int = 2) -> DataFrame:
    """``actual, predicted, n``: all num_classes squared cells of the grid.

    Rows with a null are left out; a class id outside 0 to num_classes - 1 is an error.
    """
    grouped = df.groupBy(F.col(actual).cast("int").alias("a"), F.col(predicted).cast("int").alias("p")).agg(
        F.count(F.lit(1)).alias("n")
    )
    inside = F.col("a").between(0, num_classes - 1) & F.col("p").between(0, num_classes - 1)
    refused = F.raise_error(F.concat(F.lit(f"not among {num_classes} classes: "), F.col("a"), F.lit(", "), F.col("p")))
    cell = F.when(inside, F.col("a") * num_classes + F.col("p")).otherwise(refused.cast("int"))
    # The grouped frame has one row per cell at most, so this map is num_classes squared wide.
    one = grouped.filter(F.col("a").isNotNull() & F.col("p").isNotNull()).agg(
        F.map_from_entries(F.collect_list(F.struct(cell.alias("cell"), "n"))).alias("cells")
    )
    return one.select(
        F.explode(F.sequence(F.lit(0), F.lit(num_classes * num_classes - 1))).alias("cell"), "cells"
    ).select(
        F.floor(F.col("cell") / num_classes).cast("int").alias("actual"),
        (F.col("cell") % num_classes).cast("int").alias("predicted"),
        F.coalesce(F.col("cells")[F.col("cell")], F.lit(0).cast("long")).alias("n"),
    )


def confusion_array(grid: DataFrame, num_classes: int = 2) -> DataFrame:
    """The grid as one ``confusion_matrix`` value, rows by actual class."""
    flat = F.transform(F.sort_array(F.collect_list(F.struct("actual", "predicted", "n"))), lambda c: c["n"])
    rows = F.transform(
        F.sequence(F.lit(0), F.lit(num_classes - 1)),
        lambda i: F.slice(flat, i * num_classes + 1, num_classes),
    )
    return grid.agg(rows.alias("confusion_matrix"))


def binary_aggregates(actual: str, predicted: str) -> dict[str, Column]:
    """Accuracy, and precision, recall and F1 of class 1, as aggregate columns."""
    y, p = F.col(actual).cast("int"), F.col(predicted).cast("int")
    return {"accuracy": F.avg((y == p).cast("double")), **rates_of_counts(*hit_counts(y, p).values())}


def binary_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    return df.agg(*[c.alias(n) for n, c in binary_aggregates(actual, predicted).items()])


def regression_aggregates(actual: str, predicted: str) -> dict[str, Column]:
    """MAE, MSE, RMSE and R2 as aggregate columns.

    The spread of the truth comes from the variance aggregate, which merges central moments, so one
    pass is enough and nothing cancels.
    """
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    pair = y.isNotNull() & p.isNotNull()
    truth = F.when(pair, y)
    error = truth - p
    squares, n = F.sum(error * error), F.count(truth)
    spread = F.var_pop(truth) * n
    mse = F.avg(error * error)
    return {"mae": F.avg(F.abs(error)), "mse": mse, "rmse": F.sqrt(mse), "r2": r2_of_sums(n, squares, spread)}


def regression_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    return df.agg(*[c.alias(n) for n, c in regression_aggregates(actual, predicted).items()])


def classification_report(grid: DataFrame, num_classes: int = 2) -> DataFrame:
    """Lines per class, accuracy, macro and weighted averages, from the confusion grid."""
    diagonal = F.col("actual") == F.col("predicted")
    sides = grid.select(
        F.explode(
            F.array(
                F.struct(F.col("actual").alias("c"), F.col("n").alias("support"), F.lit(0).cast("long").alias("guessed")),
                F.struct(F.col("predicted").alias("c"), F.lit(0).cast("long").alias("support"), F.col("n").alias("guessed")),
            )
        ).alias("s"),
        F.when(diagonal, F.col("n")).otherwise(0).alias("hit"),
    )
    classes = (
        sides.groupBy("s.c")
        .agg(
            F.sum("s.support").alias("support"),
            F.sum("s.guessed").alias("guessed"),
            (F.sum("hit") / 2).cast("long").alias("tp"),
        )
        .select(
            "c",
            "tp",
            "support",
            ratio_or_zero(F.col("tp"), F.col("guessed")).alias("precision"),
            ratio_or_zero(F.col("tp"), F.col("support")).alias("recall"),
            ratio_or_zero(2 * F.col("tp"), F.col("guessed") + F.col("support")).alias("f1"),
        )
    )
    names = ("precision", "recall", "f1")
    total = F.sum("support")
    accuracy = ratio_or_zero(F.sum("tp"), total)

    def line(label: str, values: list[Column]) -> Column:
        fields = [v.alias(n) for v, n in zip(values, names)]
        return F.struct(F.lit(label).alias("label"), *fields, total.alias("support"))

    weighted = [ratio_or_zero(F.sum(F.col(n) * F.col("support")), total) for n in names]
    # num_classes rows come together here, so the classes are computed once for both kinds of lines.
    of_class = F.struct(F.col("c").cast("string").alias("label"), *names, "support")
    summary = F.array(
        line("accuracy", [accuracy, accuracy, accuracy]),
        line("macro avg", [F.avg(n) for n in names]),
        line("weighted avg", weighted),
    )
    lines = classes.agg(F.concat(F.sort_array(F.collect_list(of_class)), summary).alias("lines"))
    return lines.select(F.explode("lines").alias("l")).select("l.*")
