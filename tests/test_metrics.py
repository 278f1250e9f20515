import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabweave.functions.scores import argmax_class, decide, negative_log_likelihood, positive_probability
from tabweave.operators.curve import pick_threshold, precision_recall_curve
from tabweave.operators.losses import batch_cross_entropy, batch_squared_error, epoch_loss
from tabweave.operators.metrics import (
    binary_metrics,
    classification_report,
    confusion,
    confusion_array,
    regression_metrics,
)
from tabweave.operators.threshold import best_threshold
from tabweave.plans.evaluate import evaluate, metrics_record


def pairs(spark, values, schema="y int, p int"):
    return spark.createDataFrame(values, schema)


def test_grid_is_always_full(spark):
    grid = confusion(pairs(spark, [(1, 1), (1, 1)]), "y", "p")
    assert sorted(tuple(r) for r in grid.collect()) == [(0, 0, 0), (0, 1, 0), (1, 0, 0), (1, 1, 2)]
    assert confusion_array(grid).first()[0] == [[0, 0], [0, 2]]
    assert confusion_array(confusion(pairs(spark, [(2, 0), (1, 2)]), "y", "p", 3), 3).first()[0] == [[0, 0, 0], [0, 0, 1], [1, 0, 0]]
    assert confusion_array(confusion(pairs(spark, []), "y", "p")).first()[0] == [[0, 0], [0, 0]]


def test_rates_and_zero_division(spark):
    row = binary_metrics(pairs(spark, [(1, 1), (1, 0), (0, 1), (0, 0), (0, 0)]), "y", "p").first()
    assert tuple(row) == (0.6, 0.5, 0.5, 0.5)
    assert tuple(binary_metrics(pairs(spark, [(0, 0)]), "y", "p").first()) == (1.0, 0.0, 0.0, 0.0)
    assert tuple(binary_metrics(pairs(spark, []), "y", "p").first()) == (None, 0.0, 0.0, 0.0)


def test_report_lines(spark):
    data = [(0, 0)] * 5 + [(0, 1)] * 1 + [(1, 0)] * 2 + [(1, 1)] * 2
    lines = {r["label"]: r for r in classification_report(confusion(pairs(spark, data), "y", "p")).collect()}
    assert list(lines) == ["0", "1", "accuracy", "macro avg", "weighted avg"]
    assert (lines["0"]["precision"], lines["0"]["recall"], lines["0"]["support"]) == (5 / 7, 5 / 6, 6)
    assert (lines["1"]["precision"], lines["1"]["recall"], lines["1"]["f1"]) == (2 / 3, 0.5, 4 / 7)
    assert lines["accuracy"]["f1"] == 0.7
    assert lines["macro avg"]["recall"] == pytest.approx((5 / 6 + 0.5) / 2)
    assert lines["weighted avg"]["recall"] == pytest.approx(0.7)
    assert lines["weighted avg"]["support"] == 10


def test_regression_metrics(spark):
    y, p = np.array([1e8, 1e8 + 1, 1e8 + 2, 1e8 + 5]), np.array([1e8, 1e8 + 2, 1e8 + 2, 1e8 + 4])
    row = regression_metrics(spark.createDataFrame(list(zip(y.tolist(), p.tolist())), "y double, p double"), "y", "p").first()
    assert row["mae"] == 0.5 and row["mse"] == 0.5 and row["rmse"] == math.sqrt(0.5)
    assert row["r2"] == pytest.approx(1 - 2 / ((y - y.mean()) ** 2).sum(), rel=1e-9)


@pytest.mark.parametrize("values, r2", [([(2.0, 2.0), (2.0, 2.0)], 1.0), ([(2.0, 2.0), (2.0, 3.0)], 0.0), ([(2.0, 2.0)], None), ([], None)])
def test_r2_of_degenerate_truth(spark, values, r2):
    assert regression_metrics(spark.createDataFrame(values, "y double, p double"), "y", "p").first()["r2"] == r2


def brute_curve(scores):
    positives = sum(y for y, _ in scores)
    out = []
    for t in sorted({p for _, p in scores}):
        above = [y for y, p in scores if p >= t]
        out.append((t, sum(above) / len(above), sum(above) / positives if positives else 1.0))
    return out


def brute_best(curve, strategy, least):
    if strategy == "f1":
        merit = [2 * p * r / (p + r) if p + r else 0.0 for _, p, r in curve]
    else:
        enough = [p for _, p, r in curve if r >= least]
        merit = [(r >= least, p) if enough else (False, r) for _, p, r in curve]
    return curve[max(range(len(curve)), key=lambda i: (merit[i], -i))]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("rows_per_slice", [10, 10_000])
def test_curve_and_thresholds_against_brute_force(spark, seed, rows_per_slice):
    rng = random.Random(seed)
    # A third of the rows share one score.
    scores = [(int(rng.random() < 0.3), 0.25 if i % 3 == 0 else round(rng.random(), 2)) for i in range(300)]
    df = spark.createDataFrame(scores, "y int, p double")
    expected = brute_curve(scores)
    got = sorted((r["threshold"], r["precision"], r["recall"]) for r in precision_recall_curve(df, "y", "p", rows_per_slice).collect())
    assert got == expected
    for strategy, least in (("f1", 0), ("min_recall", 0.5), ("min_recall", 0.95), ("min_recall", 2.0)):
        chosen = brute_best(expected, strategy, least)
        assert tuple(best_threshold(df, "y", "p", strategy, least, intervals=rows_per_slice).first()) == chosen
        assert tuple(pick_threshold(precision_recall_curve(df, "y", "p", rows_per_slice), strategy, least).first()) == chosen


STRANGE = [0.0, -0.0, float("nan"), float("inf"), float("-inf"), -1e-300, 5e-324, 0.5, 0.25, -3.0, 1e300]


@pytest.mark.parametrize("made", ["any number", "all positive", "no positive", "flat", "perfect", "few values", "close together"])
def test_thresholds_by_branch_and_bound(spark, made):
    """Against every threshold, with few intervals so that there are many passes."""
    rng = random.Random(made)
    label = {"all positive": lambda i: 1, "no positive": lambda i: 0}.get(made, lambda i: int(rng.random() < 0.4))
    score = {
        "any number": lambda i, y: rng.choice(STRANGE) if rng.random() < 0.4 else rng.gauss(0, 10.0 ** rng.randrange(-9, 9)),
        "perfect": lambda i, y: y + rng.random() / 2,
        "few values": lambda i, y: rng.randrange(3) / 7,
        "close together": lambda i, y: 1 + rng.randrange(40) * 2.0**-52,
    }.get(made, lambda i, y: rng.random())
    rows = [(y, score(i, y)) for i in range(250) for y in [label(i)]] + [(None, 0.3), (1, None)]
    known = [(y or 0, p + 0.0) for y, p in rows if p is not None]
    def above(a, t):
        return a != a or (t == t and a >= t)
    points = []
    for t in sorted({repr(p): p for _, p in known}.values(), key=lambda p: (p != p, p)):
        hit = [y for y, p in known if above(p, t)]
        positives = sum(y for y, _ in known)
        points.append((t, sum(hit) / len(hit), sum(hit) / positives if positives else 1.0))
    df = spark.createDataFrame(rows, "y int, p double").repartition(3)
    for strategy, least in (("f1", 0), ("min_recall", 0.6), ("min_recall", 2.0)):
        for intervals in (2, 7, 4_096):
            found = tuple(best_threshold(df, "y", "p", strategy, least, intervals=intervals).first())
            assert repr(found) == repr(brute_best(points, strategy, least)), (strategy, intervals)


def test_a_pass_returns_bounded_rows_and_moves_no_scores(spark, monkeypatch):
    from tabweave.operators import threshold

    df = spark.range(20_000).select((F.hash("id") % 5 == 0).cast("int").alias("y"), F.rand(1).alias("p"))
    passes, plain = [], threshold._count

    def counted(scored, starts, ends):
        found = plain(scored, starts, ends)
        passes.append((len(starts), len(found)))
        return found

    monkeypatch.setattr(threshold, "_count", counted)
    best = best_threshold(df, "y", "p", intervals=64).first()
    expected = pick_threshold(precision_recall_curve(df, "y", "p")).first()
    assert tuple(best) == tuple(expected)
    assert max(n for n, _ in passes) <= 64 and len(passes) < 40


def test_threshold_corner_cases(spark):
    def frame(v):
        return spark.createDataFrame(v, "y int, p double")

    assert tuple(best_threshold(frame([]), "y", "p").first()) == (0.5, 0.0, 0.0)
    assert tuple(best_threshold(frame([(0, 0.1), (0, 0.9)]), "y", "p").first()) == (0.1, 0.0, 1.0)
    assert tuple(best_threshold(frame([(1, 0.4), (0, 0.4)]), "y", "p").first()) == (0.4, 0.5, 1.0)
    # Two thresholds with equal F1: the lower one.
    assert best_threshold(frame([(1, 0.9), (0, 0.5), (0, 0.4), (1, 0.3)]), "y", "p").first()["threshold"] == 0.3
    with pytest.raises(ValueError, match="strategy"):
        best_threshold(frame([(1, 0.4)]), "y", "p", "accuracy")


def test_cutoff_is_inclusive_and_argmax_takes_the_first(spark):
    row = spark.range(1).select(
        decide(F.lit(0.5)).alias("d"),
        argmax_class(F.array(F.lit(1.0), F.lit(1.0))).alias("a"),
        positive_probability(F.array(F.lit(1000.0), F.lit(1000.0))).alias("p"),
        negative_log_likelihood(F.array(F.lit(-1000.0), F.lit(1000.0)), F.lit(0)).alias("nll"),
    ).first()
    assert tuple(row) == (1, 0, 0.5, 2000.0)


def test_short_batches_count_as_much_as_full_ones(spark):
    df = spark.createDataFrame([(0, 1.0, 0.0), (0, 3.0, 0.0), (1, 0.0, 4.0)], "b int, y double, p double")
    assert epoch_loss(batch_squared_error(df, "b", "p", "y")).first()[0] == (5.0 + 16.0) / 2


def test_weighted_cross_entropy(spark):
    df = spark.createDataFrame([(0, [0.0, 0.0], 0), (0, [0.0, 2.0], 1)], "b int, logits array<double>, y int")
    a, b = math.log(2), math.log(1 + math.exp(-2))
    loss = batch_cross_entropy(df, "b", "logits", "y", [1.0, 3.0]).first()["loss"]
    assert loss == pytest.approx((a + 3 * b) / 4)


def test_three_classes(spark):
    logits = [1.0, -2.0, 0.5]
    row = spark.range(1).select(F.array(*map(F.lit, logits)).alias("l")).select(
        positive_probability(F.col("l"), 3), negative_log_likelihood(F.col("l"), F.lit(2), 3)
    ).first()
    total = sum(map(math.exp, logits))
    assert row[0] == pytest.approx(math.exp(-2.0) / total) and row[1] == pytest.approx(math.log(total) - 0.5)


def test_curve_counts_scores_once(spark):
    """Both sides of the join on slices read the same exchange of counted scores."""
    df = spark.range(2000).select((F.col("id") % 2).cast("int").alias("y"), (F.col("id") / 2000).alias("p"))
    curve = precision_recall_curve(df, "y", "p", rows_per_slice=100)
    curve.collect()
    assert "ReusedExchange" in curve._jdf.queryExecution().executedPlan().toString()


def test_evaluate_records(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.2), (1, 0.3)], "y int, p double")
    record = metrics_record(evaluate(df, "y", "p"))
    assert record["confusion_matrix"] == [[1, 0], [1, 1]] and record["threshold"] == 0.5 and record["recall"] == 0.5
    assert evaluate(df, "y", "p", threshold=0.3).first()["recall"] == 1.0
    assert evaluate(df, "y", "p", "regression").first()["mode"] == "regression"
    with pytest.raises(ValueError, match="mode"):
        evaluate(df, "y", "p", "ranking")
