"""From a raw table to scaled, encoded and split rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tabweave.operators.encode import (
    LABEL,
    fill_categories,
    fit_vocabulary,
    keep_members,
    label_rows,
    one_hot,
    project,
    split_sizes,
)
from tabweave.operators.scaling import Scale, fit_scaling, impute, scaling_table, standardize
from tabweave.operators.shuffle_split import DEFAULT_SEED, three_way_split
from tabweave.sources.csv import scan_csv
from tabweave.sources.schemas import (
    LOAN_CATEGORICAL,
    LOAN_COLUMNS,
    LOAN_KEPT_STATUS,
    LOAN_NUMERIC,
    LOAN_RATE,
    LOAN_STATUS,
    LOAN_ZERO_STATUS,
)
from tabweave.storage import stage as staged_copy


@dataclass(frozen=True)
class Prepared:
    """Prepared rows with ``split`` and ``order_key``, and what was fitted to make them."""

    frame: DataFrame
    scales: dict[str, Scale]
    vocabulary: dict[str, list[str]]

    def part(self, split: str) -> DataFrame:
        return self.frame.filter(self.frame["split"] == split)

    def sizes(self) -> DataFrame:
        # The split and its order key are not columns of the prepared table.
        return split_sizes(self.frame.select("split"), len(self.frame.columns) - 2)

    def stats(self) -> DataFrame:
        return scaling_table(self.frame.sparkSession, self.scales)

    def apply(self, labelled: DataFrame) -> DataFrame:
        """Encode, impute and scale other rows with the fitted values; no action, any frame."""
        return standardize(impute(one_hot(labelled, self.vocabulary), self.scales), self.scales)


def clean(
    df: DataFrame,
    categorical: Sequence[str],
    status: str = LOAN_STATUS,
    allowed: Sequence[str] = LOAN_KEPT_STATUS,
    zero_value: str = LOAN_ZERO_STATUS,
) -> DataFrame:
    """Kept statuses only, categories filled, binary label added. Narrow."""
    return label_rows(fill_categories(keep_members(df, status, allowed), categorical), status, zero_value)


def prepare(
    df: DataFrame,
    numeric: Sequence[str] = LOAN_NUMERIC,
    categorical: Sequence[str] = LOAN_CATEGORICAL,
    status: str = LOAN_STATUS,
    allowed: Sequence[str] = LOAN_KEPT_STATUS,
    zero_value: str = LOAN_ZERO_STATUS,
    key: Sequence[str] | None = None,
    seed: int = DEFAULT_SEED,
    vocabulary_from: str = "all",
    stage: bool = False,
) -> Prepared:
    """Clean, encode, split and scale a table; vocabulary from all rows, statistics from train only.

    Fitting runs a few aggregates that read only their own columns; the prepared frame itself stays
    lazy and is built without a shuffle. ``stage`` writes the cleaned rows to the shared folder once,
    which pays off when the source is slow to read, such as CSV.
    """
    cleaned = clean(df, categorical, status, allowed, zero_value)
    if stage:
        cleaned = staged_copy(cleaned, "cleaned")
    divided = three_way_split(cleaned, seed, key)
    train = divided.filter(divided["split"] == "train")
    vocabulary = fit_vocabulary(train if vocabulary_from == "train" else cleaned, categorical)
    scales = fit_scaling(train, numeric)
    frame = standardize(impute(one_hot(divided, vocabulary), scales), scales)
    if key:
        frame = frame.drop(*[k for k in key if k not in (*numeric, *categorical)])
    return Prepared(frame, scales, vocabulary)


def prepare_loans(
    spark: SparkSession, csv_path: str, seed: int = DEFAULT_SEED, key: Sequence[str] | None = None, stage: bool = True
) -> Prepared:
    """The loan table from its CSV file to prepared rows."""
    raw = scan_csv(spark, csv_path, [*LOAN_NUMERIC, LOAN_RATE])
    return prepare(project(raw, [*(key or ()), *LOAN_COLUMNS]), key=key, seed=seed, stage=stage)


__all__ = ["LABEL", "Prepared", "clean", "prepare", "prepare_loans"]
