import json

import pytest
from pyspark.sql import functions as F

from tabweave.catalog.views import runs as run_view
from tabweave.operators.runs import comparison, evolution, latest_run_per_model, loss_series, runs_for_model, verdict
from tabweave.plans.report import comparison_text, evolution_text, report, report_tables
from tabweave.sources.history import (
    append_epochs,
    import_epochs,
    import_history,
    load_epochs,
    load_history,
    log_run,
    write_json,
)
from tabweave.sources.schemas import RUN_SCHEMA


def records(spark, *lines):
    """(task, model, metrics, notes) in order of appending."""
    names = ("mode", "threshold", "accuracy", "precision", "recall", "f1", "mae", "mse", "rmse", "r2", "confusion_matrix")
    rows = [
        (f"2024-05-01T10:00:0{i % 10}+00:00", task, model, notes, tuple(metrics.get(n) for n in names), i, "w")
        for i, (task, model, metrics, notes) in enumerate(lines)
    ]
    return spark.createDataFrame(rows, RUN_SCHEMA)


def test_log_and_load(spark, tmp_path):
    path = str(tmp_path / "deep" / "history")
    assert load_history(spark, path).collect() == []
    entry = log_run(spark, "classification", "mlp", {"recall": 0.5, "confusion_matrix": [[1, 2], [3, 4]]}, "first", path=path)
    log_run(spark, "classification", "mlp", {"recall": 1}, path=path)
    assert entry["metrics"]["recall"] == 0.5 and len(entry["timestamp"]) == 25 and entry["timestamp"].endswith("+00:00")
    rows = runs_for_model(load_history(spark, path), "classification", "mlp").collect()
    assert [r["notes"] for r in rows] == ["first", None]
    assert rows[0]["metrics"]["confusion_matrix"] == [[1, 2], [3, 4]] and rows[1]["metrics"]["recall"] == 1.0
    log_run(spark, "classification", "mlp", {"auc": 0.5, "recall": 0.25}, path=path)
    last = runs_for_model(load_history(spark, path), "classification", "mlp").collect()[-1]
    assert last["extra"] == {"auc": 0.5} and last["metrics"]["recall"] == 0.25
    with pytest.raises(ValueError, match="remark"):
        log_run(spark, "classification", "mlp", {"remark": "good"}, path=path)


def test_array_history_is_imported(spark, tmp_path):
    (tmp_path / "old.json").write_text(
        json.dumps(
            [
                {"timestamp": "t1", "task": "regression", "model_name": "m", "metrics": {"rmse": 2.0, "auc": 1, "note": "x"}, "notes": None},
                {"timestamp": "t2", "task": "regression", "model_name": "m", "metrics": {"mode": "regression", "rmse": None}, "notes": "n"},
                {"timestamp": "t3", "task": "classification", "model_name": None, "metrics": {"confusion_matrix": [[1, 2], [3, 4]]}},
            ],
            indent=2,
        )
    )
    found = import_history(spark, str(tmp_path / "old.json")).orderBy("seq").collect()
    assert [(r.timestamp, r.notes, r.seq) for r in found] == [("t1", None, 0), ("t2", "n", 1), ("t3", None, 2)]
    assert found[0].metrics.rmse == 2.0 and found[0].extra == {"auc": 1.0} and found[1].extra is None
    assert found[2].metrics.confusion_matrix == [[1, 2], [3, 4]]
    (tmp_path / "epochs.json").write_text(json.dumps([{"train_loss": 3, "val_loss": 2.5}, {"train_loss": 1, "val_loss": None}]))
    epochs = import_epochs(spark, str(tmp_path / "epochs.json"), "r").collect()
    assert [(r.run_id, r.epoch, r.train_loss, r.val_loss) for r in epochs] == [("r", 1, 3.0, 2.5), ("r", 2, 1.0, None)]


def test_values_that_are_no_number(spark):
    nan = float("nan")
    lines = [("regression", m, {"rmse": v}, "") for m, v in (("b", 1.0), ("n", 2.0), ("n", nan), ("n", 1.0))]
    history = records(spark, *lines)
    steps = [(r["value"], r["direction"]) for r in evolution(history, "regression", "n").collect()]
    assert [d for _, d in steps] == [None, "flat", "flat"]
    shown = [r["delta"] for r in evolution_text(evolution(history, "regression", "n"), "regression").collect()]
    assert shown == ["-", "→ +nan", "→ +nan"]
    diverged = records(spark, *lines[:3])
    assert verdict(diverged, "regression", "b", "n").first()["verdict"] == "equal"


def test_unnamed_runs_can_be_compared(spark):
    history = records(spark, ("regression", None, {"rmse": 1.5}, ""))
    assert comparison(history, "regression", [("Unnamed", "desconhecido")]).first()["rmse"] == 1.5


def test_broken_records_are_left_out(spark, tmp_path):
    path = tmp_path / "history"
    path.mkdir()
    (path / "a.json").write_text('{"task": "regression", "model_name": "m", "seq": 1}\n{"task": "regr\nnot json\n\n7\n')
    history = load_history(spark, str(path))
    assert [r["seq"] for r in history.collect()] == [1]
    assert history.count() == 1 and not history.isEmpty()


def test_json_result_is_replaced(spark, tmp_path):
    path = str(tmp_path / "out")
    write_json(spark.range(3), path)
    write_json(spark.range(5), path)
    assert spark.read.json(path).count() == 5


def test_latest_means_appended_last(spark):
    history = records(
        spark,
        ("classification", "a", {"recall": 0.1}, None),
        ("classification", None, {"recall": 0.2}, None),
        ("regression", "a", {"rmse": 9.0}, None),
        ("classification", "a", {"recall": 0.3}, None),
    ).repartition(4)
    latest = {r["model_name"]: r["metrics"]["recall"] for r in latest_run_per_model(history, "classification").collect()}
    assert latest == {"a": 0.3, "desconhecido": 0.2}


def test_comparison_with_missing_model(spark):
    history = records(spark, ("classification", "mlp", {"accuracy": 0.9, "recall": 0.12345}, None))
    table = comparison(history, "classification")
    assert [r["available"] for r in table.collect()] == [False, True]
    text = [tuple(r) for r in comparison_text(table, "classification").collect()]
    assert text[0] == ("Regressão Logística (Baseline)", "N/D", "N/D", "N/D", "N/D", "sem execução registrada")
    assert text[1] == ("MLP", "0.9000", "N/D", text[1][3], "N/D", "2024-05-01 10:00:00") and text[1][3] in ("0.1235", "0.1234")


@pytest.mark.parametrize("rows_per_slice", [1, 2, 1000])
def test_evolution_skips_missing_values(spark, rows_per_slice):
    values = [None, 0.5, None, 0.7, 0.7, 0.6]
    history = records(
        spark,
        *[("classification", "mlp", {"recall": v}, None if v else "gap") for v in values],
        ("classification", "once", {"recall": 0.1}, None),
    )
    table = evolution(history, "classification", "mlp", rows_per_slice=rows_per_slice)
    rows = sorted(table.collect(), key=lambda r: r["n"])
    assert [r["n"] for r in rows] == [1, 2, 3, 4, 5, 6]
    assert [r["direction"] for r in rows] == [None, None, None, "up", "flat", "down"]
    assert [None if r["delta"] is None else round(r["delta"], 9) for r in rows] == [None, None, None, 0.2, 0.0, -0.1]
    text = sorted(map(tuple, evolution_text(table, "classification").select("n", "recall", "delta", "notes").collect()))
    assert text[0] == ("1", "N/D", "-", "gap") and text[3] == ("4", "0.7000", "▲ +0.2000", "-")
    assert text[4][2] == "→ +0.0000" and text[5][2] == "▼ -0.1000"
    assert evolution(history, "classification", "once", rows_per_slice=rows_per_slice).count() == 0
    assert {r["model_name"] for r in evolution(history, "classification", rows_per_slice=rows_per_slice).collect()} == {"mlp"}


@pytest.mark.parametrize(
    "base, mlp, code",
    [(0.5, 0.6, "better"), (0.5, 0.4, "worse"), (0.5, 0.5 + 1e-12, "equal"), (None, 0.5, "missing_metric")],
)
def test_classification_verdicts(spark, base, mlp, code):
    history = records(
        spark,
        ("classification", "baseline_logistic_regression", {"recall": base, "f1": 0.3}, None),
        ("classification", "mlp", {"recall": mlp, "f1": 0.4}, None),
    )
    row = verdict(history, "classification").first()
    assert row["verdict"] == code and (row["baseline_f1"], row["model_f1"]) == (0.3, 0.4)


@pytest.mark.parametrize("base, mlp, code", [(2.0, 1.0, "better"), (1.0, 1.0 + 1e-12, "worse"), (1.0, 1.0, "equal")])
def test_regression_verdicts(spark, base, mlp, code):
    history = records(
        spark,
        ("regression", "baseline_linear_regression", {"rmse": base}, None),
        ("regression", "mlp", {"rmse": mlp}, None),
    )
    assert verdict(history, "regression").first()["verdict"] == code


def test_verdict_names_missing_runs(spark):
    row = verdict(records(spark, ("regression", "mlp", {"rmse": 1.0}, None)), "regression").first()
    assert (row["verdict"], row["missing"]) == ("missing_runs", "baseline_linear_regression")
    row = verdict(records(spark), "regression").first()
    assert row["missing"] == "baseline_linear_regression,mlp"


def test_epoch_history_and_series(spark, tmp_path):
    path = str(tmp_path / "epochs")
    assert load_epochs(spark, path).collect() == []
    append_epochs(spark.createDataFrame([("r", 1, 0.5, 0.6)], "run_id string, epoch int, train_loss double, val_loss double"), path)
    assert sorted(map(tuple, loss_series(load_epochs(spark, path)).collect())) == [("r", 1, "train", 0.5), ("r", 1, "val", 0.6)]


def notices(tables):
    return sorted((r["task"] or "", r["notice"]) for r in tables["notices"].collect())


def test_report_of_nothing_and_of_one_task(spark, tmp_path):
    assert notices(report_tables(records(spark), {})) == [("", "no_history")]
    history = records(spark, ("regression", "mlp", {"rmse": 1.0}, None))
    tables = report_tables(history, {})
    assert set(tables) == {"runs", "regression_comparison", "regression_evolution", "regression_verdict", "notices"}
    assert notices(tables) == [("classification", "no_runs"), ("regression", "no_loss_curve")]
    names = report(history, {}, str(tmp_path / "report"))
    assert all((tmp_path / "report" / n).is_dir() for n in names)


def test_wide_records_are_not_sorted_to_find_the_latest(spark):
    view = run_view(spark, "/root/testdata/sf0.001")
    plan = latest_run_per_model(view, "classification")._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "partial_max(seq" in plan
    assert view.select(F.count("*")).first()[0] == 1000


def test_two_appends_in_the_same_nanosecond(spark):
    history = records(spark, ("regression", "mlp", {"rmse": 1.0}, "a"), ("regression", "mlp", {"rmse": 2.0}, "b"))
    tied = history.withColumn("seq", F.lit(5).cast("bigint")).withColumn("writer", F.col("notes"))
    assert [r["notes"] for r in latest_run_per_model(tied, "regression").collect()] == ["b"]
