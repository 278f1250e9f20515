from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.errors import PySparkException

from tabweave.operators.batches import batches_by_size
from tabweave.operators.metrics import binary_metrics, confusion
from tabweave.operators.shuffle_split import slice_digits
from tabweave.operators.stopping import early_stop
from tabweave.operators.training import _merged_reports, place_rows
from tabweave.plans.evaluate import evaluate


@pytest.mark.parametrize("parts", [1, 5])
def test_batches_have_the_size_asked_for(spark, parts):
    df = spark.range(103).select("id", (F.col("id") * 2).alias("batch_source")).repartition(parts)
    found = batches_by_size(df, 10, key=["id"]).collect()
    sizes = Counter(r["batch"] for r in found)
    assert sorted(sizes) == list(range(11)) and sizes.pop(10) == 3 and set(sizes.values()) == {10}
    again = batches_by_size(df.repartition(3), 10, key=["id"]).collect()
    assert {(r["id"], r["batch"]) for r in found} == {(r["id"], r["batch"]) for r in again}


def test_slices_follow_the_rows():
    assert [slice_digits(n) for n in (0, 1_000_000, 10**9, 10**12)] == [1, 1, 4, 6]


@pytest.mark.parametrize("hot", [0, 250])
def test_placement_does_not_depend_on_the_input(spark, hot):
    """One key may hold most rows, with copies of one content among them."""
    rows = [("hot" if i < hot else str(i), [float(i % 90)], i % 2) for i in range(400)]
    placements = []
    for parts in (3, 5):
        df = spark.createDataFrame(rows, "order_key string, features array<float>, label int").repartition(parts)
        frame = place_rows(df, 4).frame.withColumn("bucket", F.spark_partition_id())
        buckets = defaultdict(Counter)
        for r in frame.collect():
            buckets[r["bucket"]][(r["key"], tuple(r["features"]), r["label"])] += 1
        placements.append(dict(buckets))
    assert placements[0] == placements[1]
    sizes = [sum(b.values()) for b in placements[0].values()]
    assert sum(sizes) == 400 and max(sizes) < 160


def test_buckets_merge_a_few_at_a_time(spark):
    rows = [(0, b, b + 1, [float(b), 1.0]) for b in range(100)]
    reports = spark.createDataFrame(rows, "chunk int, bucket int, rows bigint, values array<double>")
    merged = _merged_reports(reports, 100)
    assert merged._jdf.queryExecution().toString().count("FlatMapGroupsInPandas") >= 2
    row = merged.first()
    assert row["rows"] == 5050 and row["values"][0] == pytest.approx(sum(b * (b + 1) for b in range(100)) / 5050)


@pytest.mark.parametrize("min_delta", [0.0, 0.01])
def test_a_run_without_id_over_slices(spark, min_delta):
    losses = [0.5, 0.4, 0.45, 0.46, 0.47, 0.2]
    rows = [(run, e + 1, 1.0, v) for run in (None, "a") for e, v in enumerate(losses)]
    df = spark.createDataFrame(rows, "run_id string, epoch int, train_loss double, val_loss double")
    one, two = (early_stop(df, 2, min_delta, epochs_per_slice=n).collect() for n in (100, 2))
    assert sorted(map(tuple, one), key=str) == sorted(map(tuple, two), key=str) == [("a", 4, 2, 0.4), (None, 4, 2, 0.4)]


def test_classes_outside_the_grid_are_refused(spark):
    df = spark.createDataFrame([(0, 2), (0, 2), (1, 0), (None, 1)], "y int, p int")
    with pytest.raises(PySparkException, match="not among 2 classes"):
        confusion(df, "y", "p").collect()
    cells = {(r["actual"], r["predicted"]): r["n"] for r in confusion(df, "y", "p", 3).collect()}
    assert sum(cells.values()) == 3 and cells[0, 2] == 2 and cells[1, 0] == 1


def test_labels_that_are_neither_0_nor_1_are_refused(spark):
    df = spark.createDataFrame([(0, 0.1), (1, 0.9), (2, 0.8)], "y int, p1 double")
    with pytest.raises(PySparkException, match="neither 0 nor 1"):
        evaluate(df, "y", "p1").collect()
    kept = df.filter("y < 2")
    record = evaluate(kept, "y", "p1").first()
    plain = binary_metrics(kept.withColumn("pred", (F.col("p1") >= 0.5).cast("int")), "y", "pred").first()
    assert all(record[n] == plain[n] for n in ("accuracy", "precision", "recall", "f1"))
