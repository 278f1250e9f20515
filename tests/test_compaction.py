"""Folded histories with several writers."""

import os

import pytest

from tabweave.sources import compaction
from tabweave.sources.compaction import read_manifest
from tabweave.sources.history import fold_history, load_history, log_run


def names(spark, path):
    return sorted(r.model_name for r in load_history(spark, path).collect())


def log(spark, path, name):
    log_run(spark, "regression", name, {"rmse": 1.0, "other": 2.0}, path=path)


def files(path):
    return [n for n in os.listdir(path) if n.endswith(".json")]


def test_appends_before_during_and_after(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "history")
    assert not fold_history(spark, path)
    for name in "abc":
        log(spark, path, name)
    plain = compaction.put_text

    def late(*args):
        log(spark, path, "late")  # another writer, between the listing and the new manifest
        plain(*args)

    monkeypatch.setattr(compaction, "put_text", late)
    assert fold_history(spark, path)
    monkeypatch.undo()
    log(spark, path, "d")
    assert names(spark, path) == ["a", "b", "c", "d", "late"]
    assert len(files(path)) == 5  # those folded last stay for readers of the manifest before
    before = load_history(spark, path)
    assert fold_history(spark, path) and not fold_history(spark, path)
    assert names(spark, path) == ["a", "b", "c", "d", "late"] and len(files(path)) == 2
    assert before.count() == 5
    record = load_history(spark, path).where("model_name = 'd'").first()
    assert record.metrics.rmse == 1.0 and record.extra == {"other": 2.0}


def test_of_two_that_fold_one_wins(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "history")
    for name in "ab":
        log(spark, path, name)
    plain = compaction.put_text

    def beaten(*args):
        monkeypatch.setattr(compaction, "put_text", plain)
        assert fold_history(spark, path)  # the other one is faster
        plain(*args)

    monkeypatch.setattr(compaction, "put_text", beaten)
    assert not fold_history(spark, path)
    assert names(spark, path) == ["a", "b"]
    assert len(os.listdir(os.path.join(path, "_tables"))) == 1 and read_manifest(spark, path).number == 1


@pytest.mark.parametrize("merged_at", [2, 3])
def test_tables_are_merged_and_sorted(spark, tmp_path, monkeypatch, merged_at):
    monkeypatch.setattr(compaction, "MERGED_AT", merged_at)
    path = str(tmp_path / "history")
    for i in range(5):
        log(spark, path, f"m{i}")
        assert fold_history(spark, path)
        assert len(read_manifest(spark, path).tables) < max(merged_at, 2) + 1
        assert names(spark, path) == [f"m{k}" for k in range(i + 1)]
    assert len(files(path)) <= 2


def test_broken_records_are_left_out(spark, tmp_path):
    path = tmp_path / "history"
    log(spark, str(path), "a")
    (path / "part-x.json").write_text('{"task": ')
    assert fold_history(spark, str(path))
    assert names(spark, str(path)) == ["a"]
