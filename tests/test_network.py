import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabweave.operators import training
from tabweave.operators.network import (
    MLPSpec,
    backward,
    flatten,
    forward,
    gradient_norm,
    init_params,
    is_running,
    loss_and_gradient,
    unflatten,
)
from tabweave.operators.scoring import score_mlp, validate_epoch, with_predictions
from tabweave.operators.training import (
    _mini_batches,
    parameter_table,
    parameters_of,
    place_rows,
    train_epoch,
)
from tabweave.plans.fit import EarlyStop, fit, load_best


def data(spark, n=240, width=3, seed=0, key=None):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, width)).astype(np.float32)
    y = (x.sum(axis=1) > 0).astype(int)
    rows = [(str(i) if key is None else key(i), v.tolist(), int(t)) for i, (v, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "order_key string, features array<float>, label bigint"), x.astype(np.float64), y


def test_wrong_names_are_refused():
    with pytest.raises(ValueError, match="activation"):
        MLPSpec(2, 2, 2, activation="swish")
    with pytest.raises(ValueError, match="norm"):
        MLPSpec(2, 2, 2, norm="group")


@pytest.mark.parametrize("init", ["kaiming_normal", "kaiming_uniform", "xavier_normal", "xavier_uniform", "other"])
def test_initial_weights(init):
    spec = MLPSpec(400, [300], 2, norm="batch")
    params = init_params(spec, init)
    w = params["0.weight"]
    spread = {"kaiming_normal": math.sqrt(2 / 400), "kaiming_uniform": math.sqrt(6 / 400) / math.sqrt(3),
              "xavier_normal": math.sqrt(2 / 700), "xavier_uniform": math.sqrt(6 / 700) / math.sqrt(3),
              "other": 1 / math.sqrt(400) / math.sqrt(3)}[init]
    assert w.std() == pytest.approx(spread, rel=0.02) and abs(w.mean()) < spread / 50
    assert not params["0.bias"].any() and (params["0.gain"] == 1).all()
    assert all((a == b).all() for a, b in zip(params.values(), init_params(spec, init).values()))


@pytest.mark.parametrize("norm", [None, "layer", "batch"])
@pytest.mark.parametrize("activation", ["relu", "leaky_relu", "tanh"])
@pytest.mark.parametrize("mode", ["classification", "regression"])
def test_gradient_against_finite_differences(norm, activation, mode):
    rng = np.random.default_rng(3)
    spec = MLPSpec(4, [5, 3], 2 if mode == "classification" else 1, activation, 0.2, norm)
    params = init_params(spec, "xavier_normal", 1)
    x = rng.normal(size=(7, 4))
    y = rng.integers(0, 2, 7) if mode == "classification" else rng.normal(size=7)
    weights = np.array([0.5, 2.0]) if mode == "classification" else None

    def loss_at(p):
        out, tape = forward({k: v.copy() for k, v in p.items()}, x, spec, np.random.default_rng(9))
        return (*loss_and_gradient(out, y, mode, weights), tape)

    _, d_out, tape = loss_at(params)
    grads = backward(params, tape, d_out, spec)
    assert set(grads) == {n for n in spec.shapes() if not is_running(n)}
    for name, g in grads.items():
        for at in np.ndindex(g.shape):
            moved = {k: v.copy() for k, v in params.items()}
            moved[name][at] += 1e-6
            up = loss_at(moved)[0]
            moved[name][at] -= 2e-6
            assert g[at] == pytest.approx((up - loss_at(moved)[0]) / 2e-6, abs=2e-5), (name, at)


def test_scoring_matches_a_plain_loop(spark):
    df, x, _ = data(spark, 50)
    spec = MLPSpec(3, [4], 2, "leaky_relu")
    params = init_params(spec)
    expected = []
    for row in x:
        h = [sum(w * v for w, v in zip(ws, row)) + b for ws, b in zip(params["0.weight"], params["0.bias"])]
        h = [v if v > 0 else 0.01 * v for v in h]
        expected.append([sum(w * v for w, v in zip(ws, h)) + b for ws, b in zip(params["1.weight"], params["1.bias"])])
    got = {r["order_key"]: r["logits"] for r in score_mlp(df.repartition(5), params, spec).collect()}
    assert np.allclose([got[str(i)] for i in range(50)], expected)


def test_scoring_refuses_broken_features(spark):
    spec = MLPSpec(3, [], 2)
    bad = spark.createDataFrame([([1.0, 2.0],)], "features array<float>")
    with pytest.raises(Exception, match="arrays of 3 numbers"):
        score_mlp(bad, init_params(spec), spec).collect()


def test_unknown_modes_are_refused(spark):
    df, _, _ = data(spark, 4)
    spec = MLPSpec(3, [], 2)
    with pytest.raises(ValueError, match="mode"):
        with_predictions(score_mlp(df, init_params(spec), spec), "ranking")
    with pytest.raises(ValueError, match="mode"):
        train_epoch(place_rows(df, 1), init_params(spec), spec, "ranking")


def test_validation_epoch(spark):
    df, x, y = data(spark, 60)
    spec = MLPSpec(3, [4], 2)
    params = init_params(spec)
    batched = df.withColumn("batch", (F.col("order_key").cast("int") / 16).cast("int"))
    row = validate_epoch(batched, params, spec).first()
    out, _ = forward(params, x, spec)
    losses = [loss_and_gradient(out[a : a + 16], y[a : a + 16], "classification", None)[0] for a in range(0, 60, 16)]
    guess = out.argmax(axis=1)
    tp, fp, fn = ((guess == 1) & (y == 1)).sum(), ((guess == 1) & (y == 0)).sum(), ((guess == 0) & (y == 1)).sum()
    assert row["loss"] == pytest.approx(np.mean(losses))
    assert (row["precision"], row["recall"]) == (pytest.approx(tp / (tp + fp)), pytest.approx(tp / (tp + fn)))


def test_mini_batches_keep_every_row():
    import pyarrow as pa

    def batches(sizes):
        at = 0
        for n in sizes:
            values = np.arange(at, at + n, dtype=np.float32)
            yield pa.RecordBatch.from_arrays([pa.array([[v] for v in values], pa.list_(pa.float32())), pa.array(values)], names=["features", "label"])
            at += n

    for sizes in ([5, 1, 9], [4, 4], [1], [8, 1], [3, 3, 3]):
        for smallest in (1, 2):
            got = list(_mini_batches(batches(sizes), 1, 4, smallest))
            assert np.concatenate([y for _, y in got]).tolist() == list(range(sum(sizes)))
            lengths = [len(y) for _, y in got]
            assert all(n == 4 for n in lengths[:-1]) and (lengths[-1] >= smallest or lengths == [1])
            assert lengths[-1] <= (4 if smallest == 1 else 5)


def plain_epoch(params, spec, x, y, keys, mode, lr, size, weights, epoch, seed):
    """The sequential loop one bucket must equal."""
    import hashlib

    order = sorted(range(len(keys)), key=lambda i: hashlib.md5(f"{seed}:{epoch}:{keys[i]}".encode()).hexdigest())
    state, losses, norms = {k: v.copy() for k, v in params.items()}, [], []
    rng = np.random.default_rng([seed, epoch, 0])
    for a in range(0, len(order), size):
        part = order[a : a + size]
        out, tape = forward(state, x[part], spec, rng)
        loss, d_out = loss_and_gradient(out, y[part], mode, weights)
        grads = backward(state, tape, d_out, spec)
        losses.append(loss)
        norms.append(gradient_norm(grads))
        for n, g in grads.items():
            state[n] -= lr * g
    return state, float(np.mean(losses)), float(np.mean(norms))


@pytest.mark.parametrize("norm, dropout", [(None, 0.0), ("layer", 0.3), ("batch", 0.3)])
def test_one_bucket_is_the_sequential_loop(spark, norm, dropout):
    df, x, y = data(spark)
    spec = MLPSpec(3, [6], 2, "relu", dropout, norm)
    params, weights = init_params(spec), [0.5, 1.5]
    got, metrics = train_epoch(place_rows(df.repartition(6), 1), params, spec, lr=0.1, batch_size=32, weights=weights, epoch=2)
    expected, loss, norm_mean = plain_epoch(params, spec, x, y, range(240), "classification", 0.1, 32, np.array(weights), 2, 42)
    assert all(np.allclose(got[n], expected[n], atol=1e-12) for n in expected)
    assert metrics["loss"] == pytest.approx(loss) and metrics["grad_norm"] == pytest.approx(norm_mean)
    assert set(metrics) == {"loss", "precision", "recall", "f1", "grad_norm"}


def test_buckets_are_averaged_by_rows_and_runs_repeat(spark):
    df, x, y = data(spark)
    spec = MLPSpec(3, [6], 2, dropout_rate=0.2)
    params = init_params(spec)
    first, a = train_epoch(place_rows(df.repartition(2), 4), params, spec, lr=0.1, batch_size=16)
    second, b = train_epoch(place_rows(df.repartition(7), 4), params, spec, lr=0.1, batch_size=16)
    assert a == b and all((first[n] == second[n]).all() for n in first)
    placed = place_rows(df, 4).frame
    assert placed.rdd.getNumPartitions() == 4
    sizes = placed.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in sizes) == 240 and len(sizes) == 4


def test_weights_of_many_slices_come_back_in_order(spark, monkeypatch):
    df, _, _ = data(spark)
    spec = MLPSpec(3, [6], 2, dropout_rate=0.0)
    placed = place_rows(df, 2)
    whole, a = train_epoch(placed, init_params(spec), spec, batch_size=16)
    monkeypatch.setattr(training, "_CHUNK", 5)
    monkeypatch.setattr(training, "_CHUNKS_PER_BATCH", 3)
    sliced, b = train_epoch(placed, init_params(spec), spec, batch_size=16)
    assert a == b and all((whole[n] == sliced[n]).all() for n in whole)


def test_training_learns_and_regression_metrics(spark):
    df, x, y = data(spark)
    spec = MLPSpec(3, [8], 1, "tanh", 0.0)
    params, trained = init_params(spec), place_rows(df, 3)
    losses = []
    for epoch in range(1, 6):
        params, metrics = train_epoch(trained, params, spec, "regression", lr=0.1, batch_size=16, epoch=epoch)
        losses.append(metrics["loss"])
    assert losses == sorted(losses, reverse=True) and losses[-1] < 0.6 * losses[0]
    assert metrics["rmse"] == pytest.approx(math.sqrt(metrics["mse"]))
    assert metrics["r2"] == pytest.approx(1 - metrics["mse"] / y.var())


def test_copies_of_one_key_are_spread(spark):
    df, _, _ = data(spark, 600, key=lambda i: "same" if i % 2 else str(i))
    placed = place_rows(df, 4).frame
    sizes = [r["count"] for r in placed.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 600 and max(sizes) <= 1.2 * 150


def test_parameter_table_round_trip(spark):
    spec = MLPSpec(3, [4, 2], 2, norm="batch")
    params = init_params(spec)
    again = parameters_of(parameter_table(spark, params, spec))
    assert all((again[n] == params[n]).all() for n in params) and set(again) == set(params)
    assert (unflatten(flatten(params, spec), spec)["1.weight"] == params["1.weight"]).all()


def test_fit_stops_and_keeps_the_best(spark, tmp_path):
    df, _, _ = data(spark)
    spec = MLPSpec(3, [4], 2, dropout_rate=0.0)
    train = place_rows(df, 2)
    validation = df.withColumn("batch", F.lit(0))
    good = fit(train, validation, init_params(spec), spec, epochs=3, lr=0.1, best_path=str(tmp_path / "best"))
    assert good.best_epoch == 3 and len(good.history) == 3
    stored = load_best(spark, str(tmp_path / "best"), 3)
    assert all((stored[n] == good.params[n]).all() for n in stored)
    assert [r["epoch"] for r in good.epochs(spark, "r").orderBy("epoch").collect()] == [1, 2, 3]
    start = init_params(spec)
    worse = fit(train, validation, start, spec, epochs=9, lr=-0.1, patience=2)
    assert worse.best_epoch == 1 and len(worse.history) == 3


def test_stopping_rule_example():
    rule, stopped = EarlyStop(patience=2), []
    for epoch, loss in enumerate([0.5, 0.4, 0.4, 0.41, 0.42, 0.3], start=1):
        rule.update(loss)
        if rule.stopped:
            stopped.append(epoch)
            break
    assert stopped == [5] and rule.best_loss == 0.4
