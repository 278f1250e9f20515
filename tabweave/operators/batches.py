"""Mini-batches of a given size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabweave.operators.shuffle_split import DEFAULT_SEED, seeded_shuffle


def batches_by_size(
    df: DataFrame, batch_size: int, seed: int = DEFAULT_SEED, key: Sequence[str] | None = None
) -> DataFrame:
    """Add ``batch``: rows in seeded order, ``batch_size`` of them in each batch, the last one may be short.

    The size is what is given, so the number of batches grows with the rows. ``key`` must identify a row.
    """
    if batch_size < 1:
        raise ValueError("a batch has at least one row")
    ranked = seeded_shuffle(df, seed, key)
    return ranked.withColumn("batch", F.floor(F.col("rank") / batch_size)).select(*df.columns, "batch")
