"""Batch scoring of a network and the validation epoch built on it."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabweave.functions.scores import argmax_class, positive_probability, regression_value
from tabweave.operators.losses import weighted_cross_entropy
from tabweave.operators.metrics import hit_counts, r2_of_sums, rates_of_counts
from tabweave.operators.network import MLPSpec, Parameters, forward
from tabweave.operators.sparse_rows import Features, SparseRows, feature_names, read_features, stack
from tabweave.storage import stage

MODES = ("classification", "regression")
MAX_PARAMETERS = 50_000_000
_MEET = 50_000  # rows that meet the weights of their positions in one group


@dataclass(frozen=True)
class TabledParameters:
    """Parameters whose first layer is a table ``position, weights`` of any length, with the weights of all units.

    ``rest`` are all others; their number does not depend on the width of the input.
    """

    first: DataFrame
    rest: Parameters

    def needed(self, positions: DataFrame) -> DataFrame:
        """``bucket, position, weights`` for the pairs ``bucket, position`` that occur."""
        return self.first.join(positions.distinct(), "position").select("bucket", "position", "weights")


def local_rows(x: SparseRows, known: np.ndarray) -> SparseRows:
    """The rows over the positions that have weights here; others are an error."""
    found = x.renumbered(known)
    if len(x.positions) and (found.positions.max() >= len(known) or (known[found.positions] != x.positions).any()):
        raise ValueError("the table of the first layer has no weights for some positions")
    return found


def check_size(params: Parameters) -> None:
    """Weights are sent to every executor, so their number is bounded."""
    count = sum(v.size for v in params.values())
    if count > MAX_PARAMETERS:
        raise ValueError(f"{count} parameters; weights travel with the tasks, at most {MAX_PARAMETERS}")


def ship(spark: SparkSession, params: Parameters) -> Broadcast[Parameters]:
    """Send weights to the executors, once their size is checked."""
    check_size(params)
    return spark.sparkContext.broadcast(params)


def list_column(matrix: np.ndarray) -> pa.Array:
    rows, width = matrix.shape
    offsets = pa.array(np.arange(0, (rows + 1) * width, width, dtype=np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(matrix).ravel()))


def score_mlp(
    df: DataFrame,
    params: Parameters | Broadcast[Parameters] | TabledParameters,
    spec: MLPSpec,
    features: Features = "features",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Add ``logits`` (array of num_classes doubles) for every row; dropout is off.

    Narrow: Arrow batches go through one matrix product per layer, no shuffle. The weights travel
    once per executor, at most ``MAX_PARAMETERS`` of them. ``keep`` names the columns to carry along
    (default: all but the features). ``features`` is one array column, or the two columns ``(positions, values)`` of
    sparse rows, whose first layer adds up the weights of the positions that a row has. Callers that score
    often pass a broadcast of their own and release it.

    A first layer of more weights comes as :class:`TabledParameters`, for sparse rows only: groups of rows meet the
    weights of the positions that they have, and no task or driver holds the others.
    """
    names = feature_names(features)
    kept = list(keep) if keep is not None else [c for c in df.columns if c not in names]
    schema = T.StructType(
        [df.schema[c] for c in kept] + [T.StructField("logits", T.ArrayType(T.DoubleType(), False), False)]
    )
    width = spec.input_size
    if isinstance(params, TabledParameters):
        return _score_tabled(df.select(*kept, *names), params, spec, features, kept)
    shipped = params if isinstance(params, Broadcast) else ship(df.sparkSession, params)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shipped.value
        for batch in batches:
            outputs, _ = forward(weights, read_features(batch, features, width), spec)
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, list_column(outputs)], names=[*kept, "logits"])

    return df.select(*kept, *names).mapInArrow(score, schema)


def _score_tabled(
    df: DataFrame, params: TabledParameters, spec: MLPSpec, features: Features, kept: list[str]
) -> DataFrame:
    if isinstance(features, str):
        raise ValueError("a table of the first layer scores sparse rows only")
    units, rest = spec.linear_shapes[0][0], params.rest
    check_size(rest)
    # Runs of neighbouring rows, so that groups have one size whatever the rows hold; fixed by the copy.
    numbered = df.withColumn("__bucket", F.floor(F.monotonically_increasing_id() / _MEET))
    held = stage(numbered, "scored-rows")
    needed = params.needed(held.select(F.col("__bucket").alias("bucket"), F.explode(features[0]).alias("position")))

    def score(given: pa.Table, weights: pa.Table) -> pa.Table:
        columns = [given[c].combine_chunks() for c in kept]
        outputs = np.zeros((0, spec.num_classes))
        if given.num_rows:
            known, first = weight_matrix([weights], units)
            x = stack([read_features(b, features, spec.input_size) for b in given.to_batches()])
            local = replace(spec, input_size=len(known))
            outputs, _ = forward(rest | {"0.weight": first}, local_rows(x, known), local)
        return pa.Table.from_arrays([*columns, list_column(outputs)], names=[*kept, "logits"])

    schema = T.StructType([held.schema[c] for c in kept] + [T.StructField("logits", T.ArrayType(T.DoubleType()))])
    met = held.groupBy("__bucket").cogroup(needed.groupBy("bucket"))
    return met.applyInArrow(score, schema)


def weight_matrix(parts: Sequence[pa.Table | pa.RecordBatch], units: int) -> tuple[np.ndarray, np.ndarray]:
    """The positions of ``position, weights`` lines, ascending, and their weights, one line per unit."""
    found = [(p.column("position").to_numpy(), _flat(p.column("weights"))) for p in parts if p.num_rows]
    known = np.concatenate([k for k, _ in found]) if found else np.zeros(0, dtype=np.int64)
    flat = np.concatenate([w for _, w in found]) if found else np.zeros(0)
    order = np.argsort(known, kind="stable")
    return known[order], np.ascontiguousarray(flat.reshape(-1, units)[order].T)


def _flat(lists: pa.Array | pa.ChunkedArray) -> np.ndarray:
    chunks = lists.chunks if isinstance(lists, pa.ChunkedArray) else [lists]
    return np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in chunks])


def with_predictions(scored: DataFrame, mode: str = "classification", num_classes: int = 2) -> DataFrame:
    """Add ``p1`` and ``pred`` (classification) or ``pred`` (regression) to scored rows."""
    if mode == "classification":
        logits = F.col("logits")
        return scored.withColumns({"p1": positive_probability(logits, num_classes), "pred": argmax_class(logits)})
    if mode == "regression":
        return scored.withColumn("pred", regression_value(F.col("logits")))
    raise ValueError(f"mode '{mode}' is not one of {MODES}")


def label_mean(df: DataFrame, label: str = "label") -> float | None:
    return df.agg(F.avg(F.col(label).cast("double"))).first()[0]


def validate_epoch(
    df: DataFrame,
    params: Parameters | Broadcast[Parameters] | TabledParameters,
    spec: MLPSpec,
    mode: str = "classification",
    batch: str = "batch",
    label: str = "label",
    features: Features = "features",
    weights: Sequence[float] | None = None,
    center: float | None = None,
) -> DataFrame:
    """One row: epoch loss and the metrics of the task, no parameter moves.

    ``center`` is the mean label of a regression if it is known already. Rows are scored once.
    """
    if mode == "regression" and center is None:
        # The spread of the truth is taken around its mean; this pass reads the label column only.
        center = label_mean(df, label)
    scored = score_mlp(df, params, spec, features, keep=[batch, label])
    return validation_metrics(scored, mode, spec.num_classes, batch, label, weights, center)


def validation_metrics(
    scored: DataFrame,
    mode: str,
    num_classes: int,
    batch: str,
    label: str,
    weights: Sequence[float] | None,
    center: float | None,
) -> DataFrame:
    """One row of epoch loss and metrics from scored rows.

    Each batch is reduced to its loss sums and its share of the metrics in one grouped aggregate, and the batches
    are then added up.
    """
    predicted = with_predictions(scored, mode, num_classes)
    if mode == "classification":
        counts = hit_counts(F.col(label).cast("int"), F.col("pred"))
        per_batch = predicted.groupBy(batch).agg(
            weighted_cross_entropy("logits", label, weights, num_classes).alias("loss"),
            *[c.alias(n) for n, c in counts.items()],
        )
        rates = rates_of_counts(*[F.sum(n) for n in counts])
        return per_batch.agg(F.avg("loss").alias("loss"), *[c.alias(n) for n, c in rates.items()])

    y = F.col(label).cast("double")
    error = y - F.col("pred")
    per_batch = predicted.groupBy(batch).agg(
        F.avg(error * error).alias("loss"),
        F.count(error).alias("n"),
        F.sum(F.abs(error)).alias("absolute"),
        F.sum(error * error).alias("squares"),
        F.sum((y - F.lit(center)) * (y - F.lit(center))).alias("spread"),
    )
    n, squares = F.sum("n"), F.sum("squares")
    return per_batch.agg(
        F.avg("loss").alias("loss"),
        F.try_divide(F.sum("absolute"), n).alias("mae"),
        F.try_divide(squares, n).alias("mse"),
        F.sqrt(F.try_divide(squares, n)).alias("rmse"),
        r2_of_sums(n, squares, F.sum("spread")).alias("r2"),
    )
