"""Early stopping over stored epoch losses, for any number of runs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabweave.operators.ordered import Running, running

# Fixed values.
DEFAULT_PATIENCE = 5
DEFAULT_MIN_DELTA = 0.0

EPOCHS_PER_SLICE = 100_000
_COMPOSED = 1_024  # slices, or stretches of them, that are composed together
_RESULT = ("stop_epoch", "best_epoch", "best_loss")


def _loss_or_null(column: str) -> Column:
    """NaN counts as no loss: it never improves on anything."""
    return F.nullif(F.col(column).cast("double"), F.lit(float("nan")))


def early_stop(
    epochs: DataFrame,
    patience: int = DEFAULT_PATIENCE,
    min_delta: float = DEFAULT_MIN_DELTA,
    run: str = "run_id",
    epochs_per_slice: int = EPOCHS_PER_SLICE,
) -> DataFrame:
    """``run_id, stop_epoch, best_epoch, best_loss`` per run; stop_epoch is null if it never stops.

    A loss above best - min_delta is no improvement, ``patience`` of them in a row stop the run. With
    min_delta 0 an equal loss is an improvement. ``epoch`` counts from 1 without gaps within a run.
    """
    if min_delta != 0:
        return _stop_by_transitions(epochs, patience, min_delta, run, epochs_per_slice)
    losses = epochs.select(
        run,
        "epoch",
        _loss_or_null("val_loss").alias("loss"),
        F.floor((F.col("epoch") - 1) / epochs_per_slice).cast("int").alias("slice"),
    )
    last_slice = losses.agg(F.max("slice")).first()[0] or 0
    return _stop_by_running_minimum(losses, patience, run, single_slice=last_slice == 0)


def _stop_by_running_minimum(losses: DataFrame, patience: int, run: str, single_slice: bool) -> DataFrame:
    """Without a margin the best loss is the running minimum, so no fold over the epochs is needed."""
    lowest = running(
        losses,
        {"earlier": Running("min", F.col("loss"), include_current=False)},
        "epoch",
        [run],
        single_slice=single_slice,
    )
    improves = F.col("loss").isNotNull() & (F.col("earlier").isNull() | (F.col("loss") <= F.col("earlier")))
    marked = lowest.withColumn("improved", F.when(improves, F.col("epoch")))
    followed = running(
        marked, {"best_epoch": Running("max", F.col("improved"))}, "epoch", [run], single_slice=single_slice
    )
    waited = F.col("epoch") - F.coalesce("best_epoch", F.lit(0)) >= patience
    state = F.struct(
        F.when(waited, F.col("epoch")).alias("stop_epoch"),
        "best_epoch",
        F.least("earlier", "loss").alias("best_loss"),
    )
    # The first epoch that waited long enough, or the last one of a run that never does.
    first_or_last = F.struct(waited.alias("w"), F.when(waited, -F.col("epoch")).otherwise(F.col("epoch")).alias("e"))
    return (
        followed.groupBy(run)
        .agg(F.max_by(state, first_or_last).alias("s"))
        .select(run, *[F.col(f"s.{name}").cast("double" if name == "best_loss" else "int").alias(name) for name in _RESULT])
    )


def _first_below(codes: np.ndarray, start: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """For each start and limit the first place from the start on whose code is below the limit, else the length.

    Minima over stretches of 1, 2, 4, ... places say how far one can go without meeting such a code.
    """
    n = len(codes)
    minima, step = [codes], 1
    while step < n:
        last = minima[-1]
        beyond = np.full(step, np.iinfo(np.int64).max)
        minima.append(np.minimum(last, np.concatenate([last[step:], beyond])))
        step *= 2
    at = start.copy()
    for k in range(len(minima) - 1, -1, -1):
        inside = at < n
        far = np.zeros(len(at), dtype=bool)
        far[inside] = minima[k][at[inside]] >= limit[inside]
        at = np.where(far, np.minimum(at + (1 << k), n), at)
    return at


def _transition(losses: np.ndarray, first: int, own: int, patience: int, min_delta: float) -> list[tuple]:
    """What a slice makes of every state it may be entered in.

    The state is the epoch of the last improvement, at most ``patience`` epochs back: whoever waited longer has
    stopped. ``losses`` are those of epochs ``first, first + 1, ...``, the slice itself begins at epoch ``own``; NaN is no
    loss. Returns ``(entered, left, loss, stop)`` per state, where ``stop`` is null for a run that goes on.
    """
    epochs = np.arange(first, first + len(losses))
    if own == 1:  # a run starts as if it had improved on infinity at epoch 0
        epochs, losses = np.arange(len(losses) + 1), np.concatenate([[np.nan], losses])
    usable = ~np.isnan(losses)
    known = np.unique(losses[usable])
    codes = np.where(usable, np.searchsorted(known, losses), len(known))
    limit = np.where(usable, np.searchsorted(known, losses - min_delta, side="right"), 0)
    if own == 1:
        usable[0], limit[0] = True, len(known)
    n = len(epochs)
    place = np.arange(n)
    following = _first_below(codes, place + 1, limit)
    to = np.where((following < n) & (following - place <= patience), following, place)
    # Improvements are followed to the last one in the slice, twice as far in every round.
    while (to[to] != to).any():
        to = to[to]
    entered = np.flatnonzero(usable & (epochs < own))
    out = []
    for i, j in zip(entered.tolist(), to[entered].tolist(), strict=True):
        stop = int(epochs[j]) + patience
        out.append((int(epochs[i]), int(epochs[j]), float(losses[j]), stop if stop <= epochs[-1] else None))
    return out


_STATES = "slice bigint, entered bigint, left bigint, loss double, stop bigint"
_TYPES = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64())


def _states(run: pa.Scalar, number: int, states: list[tuple]) -> pa.Table:
    columns = list(zip(*[(number, *s) for s in states], strict=True)) or [()] * len(_TYPES)
    arrays = [pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)]
    names = [part.split()[0] for part in _STATES.split(", ")]
    return pa.Table.from_arrays([pa.array([run.as_py()] * len(states), run.type), *arrays], names=["run", *names])


def _compose(states: list[dict]) -> list[tuple]:
    """Neighbouring slices as one: what leaves a slice enters the next one; a run that has stopped goes through all."""
    slices: dict[int, dict[int, tuple]] = {}
    for s in states:
        slices.setdefault(s["slice"], {})[s["entered"]] = (s["left"], s["loss"], s["stop"])
    numbers = sorted(slices)
    whole = dict(slices[numbers[0]])
    for number in numbers[1:]:
        step = slices[number]
        whole = {e: state if state[2] is not None else step[state[0]] for e, state in whole.items()}
    return [(e, *state) for e, state in whole.items()]


def _stop_by_transitions(
    epochs: DataFrame, patience: int, min_delta: float, run: str, epochs_per_slice: int
) -> DataFrame:
    """With a margin a step needs the one before, so slices are made into functions of the state, all at once.

    A state is the epoch of the last improvement, of which only the last ``patience`` epochs before a slice
    are possible, so a function has at most that many lines and looks at that many losses before its slice. Functions
    of neighbouring slices are composed, ``_COMPOSED`` at a time, then those. The number of jobs does not
    depend on the number of slices.
    """
    size = max(epochs_per_slice, patience)
    number = F.floor((F.col("epoch") - 1) / size).cast("bigint")
    before_next = F.col("epoch") > (number + 1) * size - patience
    losses = epochs.select(
        F.col(run).alias("run"),
        F.col("epoch").cast("bigint").alias("epoch"),
        _loss_or_null("val_loss").alias("loss"),
        F.explode(F.when(before_next, F.array(number, number + 1)).otherwise(F.array(number))).alias("slice"),
    )

    def transition(key: tuple[pa.Scalar, ...], given: pa.Table) -> pa.Table:
        given = given.sort_by("epoch")
        own = int(key[1].as_py()) * size + 1
        epochs = given["epoch"].to_numpy()
        found = []
        if epochs[-1] >= own:
            values = given["loss"].to_numpy(zero_copy_only=False).astype(np.float64)
            found = _transition(values, int(epochs[0]), own, patience, min_delta)
        return _states(key[0], key[1].as_py(), found)

    def compose(key: tuple[pa.Scalar, ...], given: pa.Table) -> pa.Table:
        return _states(key[0], key[1].as_py(), _compose(given.to_pylist()))

    schema = f"run {epochs.schema[run].dataType.simpleString()}, {_STATES}"
    slices = losses.groupBy("run", "slice").applyInArrow(transition, schema)
    stretches = slices.groupBy("run", F.floor(F.col("slice") / _COMPOSED).alias("stretch")).applyInArrow(compose, schema)
    whole = stretches.groupBy("run", F.lit(0).alias("all")).applyInArrow(compose, schema)
    improved = F.col("left") > 0
    return whole.where("entered = 0").select(
        F.col("run").alias(run),
        F.col("stop").cast("int").alias("stop_epoch"),
        F.when(improved, F.col("left")).cast("int").alias("best_epoch"),
        F.when(improved, F.col("loss")).alias("best_loss"),
    )
