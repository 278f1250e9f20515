"""Statistics of the training split, and imputation and scaling with them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabweave.operators.order_statistics import IN_MEMORY_ROWS, exact_medians


@dataclass(frozen=True)
class Scale:
    median: float | None
    mean: float | None
    std: float


def fit_scaling(df: DataFrame, columns: Sequence[str], in_memory_rows: int = IN_MEMORY_ROWS) -> dict[str, Scale]:
    """Median, mean and sample deviation per column; nulls are skipped, a deviation of 0 or null is 1.

    Mean and deviation of all columns come from the first pass of the median search.
    """
    also: dict[str, Column] = {}
    for i, c in enumerate(columns):
        v = F.col(c).cast("double")
        also |= {f"mean{i}": F.avg(v), f"std{i}": F.stddev_samp(v)}
    medians, found = exact_medians(df, columns, in_memory_rows, also)
    return {c: Scale(medians[c], found[f"mean{i}"], found[f"std{i}"] or 1.0) for i, c in enumerate(columns)}


def scaling_table(spark: SparkSession, scales: dict[str, Scale]) -> DataFrame:
    """The fitted statistics as rows, one per column."""
    rows = [(c, s.median, s.mean, s.std) for c, s in scales.items()]
    return spark.createDataFrame(rows, "feature string, median double, mean double, std double")


def _literal(value: float | None) -> Column:
    return F.lit(value).cast("double")


def impute(df: DataFrame, scales: dict[str, Scale], nan_as_null: bool = False) -> DataFrame:
    """Null becomes the training median. NaN is a value and stays, unless ``nan_as_null``."""

    def filled(c: str, s: Scale) -> Column:
        v = F.col(c).cast("double")
        return F.coalesce(F.nullif(v, F.lit(float("nan"))) if nan_as_null else v, _literal(s.median))

    return df.withColumns({c: filled(c, s) for c, s in scales.items()})


def standardize(df: DataFrame, scales: dict[str, Scale]) -> DataFrame:
    return df.withColumns(
        {c: (F.col(c).cast("double") - _literal(s.mean)) / _literal(s.std) for c, s in scales.items()}
    )
