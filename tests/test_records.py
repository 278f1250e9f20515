"""Records across the borders of blocks, against reading whole files."""

import csv
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from tabweave.sources.csv import scan_csv
from tabweave.sources.history import append_runs, import_epochs, import_history, load_history
from tabweave.sources.records import JSON_ARRAY, QUOTED_LINES, read_records

SETTINGS = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")


@pytest.fixture(params=[250, 1 << 27])
def block(spark, request):
    """Blocks of so many bytes, so that a file has many of them, or one."""
    before = {k: spark.conf.get(k) for k in SETTINGS}
    for k in SETTINGS:
        spark.conf.set(k, str(request.param) if k == SETTINGS[0] else "1")
    yield request.param
    for k, v in before.items():
        spark.conf.set(k, v)


TEXTS = ["plain", "", "a, b", 'says "x"', "two\nlines", '"', '""', "\n", "}{", "][", "back\\slash", 'end\\"', "é\r\nü", "x" * 90, ' "a\n"b" ', "{]"]


def cells(rng, n):
    return [[str(i), rng.choice(TEXTS), rng.choice(TEXTS)] for i in range(n)]


@pytest.mark.parametrize(("quoting", "ending"), [(csv.QUOTE_MINIMAL, "\n"), (csv.QUOTE_ALL, "")])
def test_quoted_line_breaks(spark, tmp_path, block, quoting, ending):
    rng = random.Random(quoting)
    expected = []
    for name in ("a", "b"):
        rows = cells(rng, 60)
        out = io.StringIO()
        csv.writer(out, quoting=quoting, lineterminator="\n").writerows([["id", "first one", "second"], *rows])
        (tmp_path / f"{name}.csv").write_text(out.getvalue().removesuffix("\n") + ending, encoding="utf-8", newline="")
        expected += rows
    found = scan_csv(spark, str(tmp_path), {"id": "int"}, multi_line=True)
    assert found.dtypes == [("id", "int"), ("first one", "string"), ("second", "string")]
    assert sorted((str(r[0]), r[1] or "", r[2] or "") for r in found.collect()) == sorted(map(tuple, expected))
    if block == 250:
        pieces = read_records(spark, str(tmp_path), QUOTED_LINES)
        assert spark.read.option("lineSep", "\n").text(str(tmp_path)).rdd.getNumPartitions() > 8 and pieces.count() == 122


def test_without_a_header(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    with pytest.raises(ValueError, match="no header"):
        scan_csv(spark, str(tmp_path), multi_line=True)


def runs(rng, n):
    return [
        {
            "timestamp": f"t{i}",
            "task": rng.choice(["classification", "regression"]),
            "model_name": rng.choice(TEXTS),
            "notes": rng.choice([None, *TEXTS]),
            "metrics": {"f1": i / 7, "confusion_matrix": [[i, 1], [2, 3]], "latency": i + 0.5, "remark": rng.choice(TEXTS)},
        }
        for i in range(n)
    ]


@pytest.mark.parametrize("indent", [None, 2])
def test_arrays(spark, tmp_path, block, indent):
    records = runs(random.Random(4), 16)
    (tmp_path / "history.json").write_text(json.dumps(records, indent=indent, ensure_ascii=False), encoding="utf-8", newline="")
    found = import_history(spark, str(tmp_path / "history.json")).orderBy("seq").collect()
    assert [r.seq for r in found] == list(range(16))
    for r, given in zip(found, records, strict=True):
        assert (r.timestamp, r.task, r.model_name, r.notes) == tuple(given[k] for k in ("timestamp", "task", "model_name", "notes"))
        assert r.metrics.f1 == given["metrics"]["f1"] and r.metrics.confusion_matrix == given["metrics"]["confusion_matrix"]
        assert r.extra == {"latency": given["metrics"]["latency"]}


def test_positions_go_on_over_files_and_imports(spark, tmp_path, block):
    for name, n in (("a.json", 25), ("b.json", 12)):
        (tmp_path / name).write_text(json.dumps([{"train_loss": 1.0, "val_loss": float(i)} for i in range(n)]))
    epochs = import_epochs(spark, str(tmp_path), "r").orderBy("epoch").collect()
    assert [r.epoch for r in epochs] == list(range(1, 38)) and [r.val_loss for r in epochs] == [*map(float, range(25)), *map(float, range(12))]
    history, source = str(tmp_path / "history"), tmp_path / "runs.json"
    for start in (0, 5):
        source.write_text(json.dumps([{"timestamp": f"t{start + i}", "task": "regression", "model_name": "m"} for i in range(5)]))
        append_runs(import_history(spark, str(source), after=load_history(spark, history)), history)
    stored = load_history(spark, history).orderBy("seq").collect()
    assert [(r.seq, r.timestamp) for r in stored] == [(i, f"t{i}") for i in range(10)]


@pytest.mark.parametrize("text", ["", "[\n]", '[1, "}"]', '[{"train_loss": 1.0, "val_loss": 2.0'])
def test_arrays_without_whole_objects(spark, tmp_path, text):
    (tmp_path / "epochs.json").write_text(text)
    assert import_epochs(spark, str(tmp_path / "epochs.json"), "r").collect() == []


def test_a_cut_array_keeps_its_whole_objects(spark, tmp_path):
    (tmp_path / "epochs.json").write_text(json.dumps([{"train_loss": 1.0, "val_loss": 2.0}] * 9)[:-20])
    assert import_epochs(spark, str(tmp_path / "epochs.json"), "r").count() == 8


def test_only_records_on_a_border_move(spark, tmp_path, block):
    (tmp_path / "a.json").write_text(json.dumps([{"a": "x" * 20, "b": [1, {"c": 2}]}] * 30))
    found = read_records(spark, str(tmp_path), JSON_ARRAY).where(F.col("text").contains("{"))
    assert sorted(json.loads(r.text.lstrip("[, "))["a"] for r in found.collect()) == ["x" * 20] * 30
    assert sorted(r.number for r in found.collect()) == list(range(30))
