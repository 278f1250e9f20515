"""Training over epochs with validation, early stopping, stored best weights and a way to go on later."""

from __future__ import annotations

import math
from collections.abc import Sequence
from contextlib import nullcontext
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tabweave.operators.chunked import (
    ChunkedRows,
    StoredParameters,
    train_stored_epoch,
    validate_stored_epoch,
)
from tabweave.operators.network import MLPSpec, Parameters
from tabweave.operators.scoring import label_mean, ship, validate_epoch
from tabweave.operators.stopping import DEFAULT_MIN_DELTA, DEFAULT_PATIENCE
from tabweave.operators.training import TrainingData, parameter_table, parameters_of, train_epoch
from tabweave.plans.journal import FitState, Journal
from tabweave.sources.schemas import EPOCH_SCHEMA
from tabweave.storage import scratch_path, staged


class EarlyStop:
    """The stopping rule for a running loop, one call per epoch.

    The same rule as :func:`tabweave.operators.stopping.early_stop` has for stored losses.
    """

    def __init__(self, patience: int = DEFAULT_PATIENCE, min_delta: float = DEFAULT_MIN_DELTA):
        self.patience, self.min_delta = patience, min_delta
        self.best_loss: float | None = None
        self.waited, self.stopped = 0, False

    def update(self, loss: float) -> bool:
        """True if this loss is a new best."""
        usable = loss is not None and not math.isnan(loss)
        if usable and (self.best_loss is None or not loss > self.best_loss - self.min_delta):
            self.best_loss, self.waited = loss, 0
            return True
        self.waited += 1
        self.stopped = self.waited >= self.patience
        return False


@dataclass
class FitResult:
    params: Parameters | StoredParameters
    best_epoch: int
    history: list[dict[str, float]] = field(default_factory=list)

    def epochs(self, spark: SparkSession, run_id: str) -> DataFrame:
        """The losses, and all other metrics by name, as epoch records for the epoch history."""
        named = ("epoch", "train_loss", "val_loss")
        rows = [
            (run_id, *(h[n] for n in named), {k: v for k, v in h.items() if k not in named and v is not None})
            for h in self.history
        ]
        return spark.createDataFrame(rows, EPOCH_SCHEMA)


def save_best(spark: SparkSession, params: Parameters, spec: MLPSpec, epoch: int, path: str) -> None:
    """Keep the parameters of an epoch in their own folder."""
    parameter_table(spark, params, spec).coalesce(1).write.mode("overwrite").parquet(f"{path}/epoch={epoch}")


def load_best(spark: SparkSession, path: str, epoch: int) -> Parameters:
    return parameters_of(spark.read.parquet(f"{path}/epoch={epoch}"))


@dataclass(frozen=True)
class _Steps:
    """One way to run epochs: on whole parameters that the driver holds."""

    spark: SparkSession
    spec: MLPSpec
    train: TrainingData
    validation: DataFrame
    mode: str
    lr: float
    batch_size: int
    weights: Sequence[float] | None
    seed: int
    center: float | None

    def run(self, params, epoch: int, journal: Journal | None):
        params, metrics = train_epoch(
            self.train, params, self.spec, self.mode, self.lr, self.batch_size, self.weights, epoch, self.seed
        )
        if journal:
            save_best(self.spark, params, self.spec, epoch, journal.path)
        return params, metrics

    def check(self, params) -> dict:
        shipped = ship(self.spark, params)
        checked = validate_epoch(
            self.validation, shipped, self.spec, self.mode, features=self.train.features, weights=self.weights, center=self.center
        )
        line = checked.first().asDict()
        shipped.destroy()
        return line

    def load(self, start, journal: Journal, epoch: int):
        return load_best(self.spark, journal.path, epoch) if epoch else start

    def keep(self, params, epoch: int, path: str) -> None:
        save_best(self.spark, params, self.spec, epoch, path)


class _StoredSteps(_Steps):
    """The other way: on parameters that stay in chunks."""

    def run(self, params, epoch: int, journal: Journal | None):
        path = journal.clear(epoch) if journal else scratch_path(self.spark, "parameters")
        return train_stored_epoch(self.train, params, self.mode, self.lr, self.batch_size, self.weights, epoch, self.seed, path)

    def check(self, params) -> dict:
        checked = validate_stored_epoch(self.validation, params, self.mode, weights=self.weights, center=self.center)
        return checked.first().asDict()

    def load(self, start, journal: Journal, epoch: int):
        return StoredParameters(self.spark, self.spec, journal.place(epoch), start.per_chunk) if epoch else start

    def keep(self, params, epoch: int, path: str) -> None:
        params.frame.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")


def fit(
    train: TrainingData | ChunkedRows,
    validation: DataFrame | ChunkedRows,
    params: Parameters | StoredParameters,
    spec: MLPSpec,
    mode: str = "classification",
    epochs: int = 50,
    lr: float = 0.01,
    batch_size: int = 64,
    weights: Sequence[float] | None = None,
    patience: int = DEFAULT_PATIENCE,
    min_delta: float = DEFAULT_MIN_DELTA,
    seed: int = 42,
    best_path: str | None = None,
    resume_path: str | None = None,
) -> FitResult:
    """Train until the validation loss stops improving; the parameters of the best epoch are returned.

    Whole parameters: two jobs per epoch, one to train and one to validate; the driver holds parameters and metrics.
    ``validation`` has ``batch``, the features and ``label``; it is made once and kept in the shared folder while the
    epochs run. Stored parameters: both tables come from :func:`tabweave.operators.chunked.place_chunked`, the one for
    validation with ``keep=["batch"]``; the driver holds metrics only.

    With ``resume_path`` every finished epoch is committed there, and a call with the same settings goes on behind
    the last one that was, with the same random numbers, so its weights equal those of an uninterrupted fit.
    ``epochs`` may be larger than before. Rows and start parameters must be the same as in the first call.
    """
    stored = isinstance(params, StoredParameters)
    spark = params.spark if stored else validation.sparkSession
    rule = EarlyStop(patience, min_delta)
    settings = {
        "spec": asdict(spec), "mode": mode, "lr": lr, "batch_size": batch_size, "weights": weights and list(weights),
        "patience": patience, "min_delta": min_delta, "seed": seed, "buckets": train.buckets, "stored": stored,
    }
    journal = Journal(spark, resume_path, settings) if resume_path else None
    state = journal.load() if journal else FitState()
    rule.best_loss, rule.waited, rule.stopped = state.best_loss, state.waited, state.stopped
    copied = nullcontext(validation) if stored else staged(validation.select("batch", *train.columns, "label"), "validation")
    with copied as held_out:
        labels = held_out.frame.select("label.label") if stored else held_out
        center = label_mean(labels) if mode == "regression" else None
        steps = (_StoredSteps if stored else _Steps)(
            spark, spec, train, held_out, mode, lr, batch_size, weights, seed, center
        )
        start, best = params, params
        if journal:
            params, best = (steps.load(start, journal, e) for e in (state.epoch, state.best_epoch))
        while not state.stopped and state.epoch < epochs:
            epoch, before = state.epoch + 1, params
            params, trained = steps.run(before, epoch, journal)
            checked = steps.check(params)
            line = {"epoch": epoch, "train_loss": trained.get("loss"), "val_loss": checked["loss"]}
            line |= {f"train_{k}": v for k, v in trained.items() if k != "loss"}
            line |= {f"val_{k}": v for k, v in checked.items() if k != "loss"}
            is_best, passed = rule.update(checked["loss"]), best
            best = params if is_best else best
            state = FitState(
                epoch, epoch if is_best else state.best_epoch, rule.best_loss, rule.waited, rule.stopped, [*state.history, line]
            )
            if is_best and best_path:
                steps.keep(params, epoch, best_path)
            if journal:
                journal.commit(state)
            elif stored:
                for version in {v.path: v for v in (before, passed)}.values():
                    if version.path not in (start.path, params.path, best.path):
                        version.release()
    return FitResult(best, state.best_epoch, state.history)
