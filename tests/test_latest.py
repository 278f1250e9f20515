"""The maintained table of latest runs against the whole history."""

import os

from tabweave.operators.runs import latest_runs
from tabweave.plans.report import report
from tabweave.sources import latest
from tabweave.sources.history import fold_history, load_history, log_run
from tabweave.sources.latest import maintained_latest


def log(spark, path, name, task="regression", **metrics):
    log_run(spark, task, name, metrics or {"rmse": 1.0}, path=path)


def rows(df):
    return sorted((r.asDict(recursive=True) for r in df.collect()), key=lambda r: (r["task"], r["model_name"]))


def test_equal_to_the_whole_history_and_reads_only_what_is_new(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "history")
    read, plain = [], latest.load_records

    def counted(spark, path, files, tables):
        read.append((len(files), len(tables)))
        return plain(spark, path, files, tables)

    monkeypatch.setattr(latest, "load_records", counted)
    assert rows(maintained_latest(spark, path)) == []
    steps = [("a", "b"), ("a",), (), "fold", (), ("c", "a"), "fold", ("b",), "fold", "fold", ("d",)]
    for step in steps:
        if step == "fold":
            fold_history(spark, path)
        else:
            for name in step:
                log(spark, path, name)
        assert rows(maintained_latest(spark, path)) == rows(latest_runs(load_history(spark, path))), step
    # What is folded is not read again; a call without anything new reads nothing.
    assert read == [(0, 0), (2, 0), (1, 0), (2, 0), (1, 0), (1, 0)]
    folder = tmp_path / "history" / "_latest"
    assert sum(os.path.isdir(folder / n) for n in os.listdir(folder)) == 2


def test_two_calls_at_once(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "history")
    log(spark, path, "a")
    plain = latest.put_text

    def beaten(*args):
        monkeypatch.setattr(latest, "put_text", plain)
        maintained_latest(spark, path)
        plain(*args)

    monkeypatch.setattr(latest, "put_text", beaten)
    assert [r["model_name"] for r in rows(maintained_latest(spark, path))] == ["a"]
    log(spark, path, "b")
    assert [r["model_name"] for r in rows(maintained_latest(spark, path))] == ["a", "b"]


def test_report_from_the_maintained_table(spark, tmp_path):
    path = str(tmp_path / "history")
    for value in (0.5, 0.25):
        log(spark, path, "mlp", rmse=value)
        log(spark, path, "baseline_linear_regression", rmse=0.3)
    history = load_history(spark, path)
    names = report(history, {}, str(tmp_path / "full"))
    assert report(history, {}, str(tmp_path / "kept"), latest=maintained_latest(spark, path)) == names
    for name in names:
        full, kept = (sorted(map(tuple, spark.read.json(str(tmp_path / d / name)).collect()), key=repr) for d in ("full", "kept"))
        assert full == kept, name


def test_unknown_folder_is_empty(spark, tmp_path):
    assert maintained_latest(spark, str(tmp_path / "nothing")).count() == 0
