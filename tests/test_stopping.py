import random

import numpy as np
import pytest

from tabweave.operators import stopping
from tabweave.operators.stopping import early_stop
from tabweave.plans.fit import EarlyStop


def brute(losses, patience, min_delta):
    rule, best_epoch = EarlyStop(patience, min_delta), None
    for epoch, loss in enumerate(losses, start=1):
        if rule.update(loss):
            best_epoch = epoch
        if rule.stopped:
            return epoch, best_epoch, rule.best_loss
    return None, best_epoch, rule.best_loss


def made(seed):
    rng = random.Random(seed)
    runs = {}
    for r in range(30):
        losses = [round(rng.choice([0.9**e, 1.0]) + rng.randrange(8) / 10, 3) for e in range(rng.randrange(1, 40))]
        runs[f"r{r}"] = [float("nan") if rng.random() < 0.05 else v for v in losses]
    runs["falling"] = [1 / (e + 1) for e in range(60)]
    runs["flat"] = [1.0] * 25
    runs["nan"] = [float("nan")] * 4
    return runs


@pytest.mark.parametrize("min_delta", [0.0, 0.15, -0.1])
@pytest.mark.parametrize("epochs_per_slice", [4, 1000])
@pytest.mark.parametrize("patience", [1, 3, 7])
def test_against_the_loop(spark, patience, min_delta, epochs_per_slice):
    runs = made(patience)
    rows = [(r, e, 0.0, v) for r, losses in runs.items() for e, v in enumerate(losses, start=1)]
    df = spark.createDataFrame(rows, "run_id string, epoch int, train_loss double, val_loss double").repartition(5)
    got = {r["run_id"]: (r["stop_epoch"], r["best_epoch"], r["best_loss"]) for r in early_stop(df, patience, min_delta, epochs_per_slice=epochs_per_slice).collect()}
    assert got == {r: brute(losses, patience, min_delta) for r, losses in runs.items()}


def test_example_with_an_equal_loss(spark):
    losses = [0.5, 0.4, 0.4, 0.41, 0.42, 0.3]
    df = spark.createDataFrame([("r", e, 0.0, v) for e, v in enumerate(losses, start=1)], "run_id string, epoch int, train_loss double, val_loss double")
    assert tuple(early_stop(df, patience=2).first()) == ("r", 5, 3, 0.4)


def test_no_runs(spark):
    df = spark.createDataFrame([], "run_id string, epoch int, train_loss double, val_loss double")
    assert early_stop(df).collect() == []
    assert early_stop(df, min_delta=0.1).collect() == []


def rows_of(spark, runs):
    rows = [(r, e, 0.0, v) for r, losses in runs.items() for e, v in enumerate(losses, start=1)]
    return spark.createDataFrame(rows, "run_id string, epoch int, train_loss double, val_loss double").repartition(5)


@pytest.mark.parametrize("composed", [2, 3])
def test_composed_slices_of_long_runs(spark, monkeypatch, composed):
    """Runs over many stretches of slices, among them one without an id and one that never has a loss."""
    monkeypatch.setattr(stopping, "_COMPOSED", composed)
    rng = random.Random(composed)
    falling = [5 - e * 0.04 + rng.random() / 10 for e in range(200)]
    runs = {None: falling, "late": [*falling[:150], *[9.0] * 50], "nothing": [None] * 70, "infinite": [float("inf")] * 9 + [None, 1.0]}
    runs |= {f"r{i}": [rng.choice([None, float("nan"), 3 - e / 30 + rng.random()]) for e in range(rng.randrange(1, 120))] for i in range(20)}
    for patience, min_delta in ((4, 0.03), (9, 0.2), (3, -0.5)):
        found = early_stop(rows_of(spark, runs), patience, min_delta, epochs_per_slice=5).collect()
        assert {r["run_id"]: tuple(r)[1:] for r in found} == {r: brute(v, patience, min_delta) for r, v in runs.items()}


def test_the_number_of_jobs_does_not_depend_on_the_slices(spark):
    df = rows_of(spark, {"r": [1 / e for e in range(1, 200)]})
    tracker = spark.sparkContext.statusTracker()
    jobs = []
    for i, size in enumerate((4, 1_000)):
        spark.sparkContext.setJobGroup(f"stopping-{i}", "")
        early_stop(df, 3, 0.0001, epochs_per_slice=size).collect()
        jobs.append(len(tracker.getJobIdsForGroup(f"stopping-{i}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1]


def test_first_below():
    rng = np.random.default_rng(4)
    for n in (1, 2, 7, 64, 100):
        codes = rng.integers(0, 9, n)
        start, limit = rng.integers(0, n + 1, 50), rng.integers(0, 10, 50)
        expected = [next((j for j in range(s, n) if codes[j] < t), n) for s, t in zip(start, limit, strict=True)]
        assert stopping._first_below(codes, start, limit).tolist() == expected
