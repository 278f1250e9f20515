"""Medians per group against sorting."""

import math
import random

import pytest

from tabweave.operators import group_statistics
from tabweave.operators.group_statistics import group_medians

SCHEMA = "city string, year int, a double, b double, other int"


def plain(rows):
    groups = {}
    for city, year, *values in rows:
        groups.setdefault((city, year), []).append(values)
    out = {}
    for key, lines in groups.items():
        medians = []
        for column in (0, 1):
            v = sorted((line[column] for line in lines if line[column] is not None), key=lambda x: (x != x, x))
            medians.append((v[(len(v) - 1) // 2] + v[len(v) // 2]) / 2 if v else None)
        out[key] = medians
    return out


def same(a, b):
    return a == b or (a is not None and b is not None and (math.isclose(a, b) or (a != a and b != b)))


def check(spark, rows, limit):
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA).repartition(5)
    found = group_medians(df, ["city", "year"], ["a", "b"], in_memory_rows=limit)
    assert found.columns == ["city", "year", "a", "b"]
    got = {(r.city, r.year): [r.a, r.b] for r in found.collect()}
    expected = plain(rows)
    assert got.keys() == expected.keys()
    for key, values in expected.items():
        assert all(map(same, got[key], values)), key


@pytest.mark.parametrize("limit", [3, 10_000])
def test_groups_of_all_sizes(spark, limit):
    """Among them a group with most rows, one without an id, one of one value, one of nulls and NaN."""
    rng = random.Random(limit)
    rows = [("hot", None, rng.gauss(0, 5), float(rng.randrange(4))) for _ in range(1_500)]
    rows += [(None, None, round(rng.random(), 1), 10.0 ** rng.randrange(-300, 300)) for _ in range(151)]
    rows += [("one", 1, 2.5, None) for _ in range(60)] + [("none", 1, None, None)]
    rows += [("odd", 2, rng.choice([float("nan"), float("inf"), -0.0, None, 1.0]), float("nan")) for _ in range(90)]
    rows += [(f"c{rng.randrange(60)}", rng.randrange(2), rng.random(), rng.random()) for _ in range(400)]
    check(spark, rows, limit)


def test_sketches_of_many_parts(spark, monkeypatch):
    monkeypatch.setattr(group_statistics, "_CUTS", 2)
    rng = random.Random(1)
    check(spark, [("x", i % 2, rng.choice([rng.random(), 0.5]), float(i)) for i in range(600)], 20)


def test_no_rows_and_wrong_names(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert group_medians(df, ["city"], ["a"]).collect() == []
    with pytest.raises(ValueError, match="need groups"):
        group_medians(df, [], ["a"])
    with pytest.raises(ValueError, match="used inside"):
        group_medians(df.withColumnRenamed("city", "g"), ["g"], ["a"])


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_small_groups_are_sorted_without_ranges(spark):
    rows = [("a", i % 40, float(i), None, 1) for i in range(200)]
    found = group_medians(spark.createDataFrame(rows, SCHEMA), ["year"], ["a", "b"])
    assert "Join" not in plan_of(found) and found.count() == 40


def test_values_of_large_groups_stay_where_they_are(spark, monkeypatch):
    """Ranges go to the values, so those of one group never meet in one task, whatever sizes Spark expects."""
    plans, keep = [], group_statistics.stage
    monkeypatch.setattr(group_statistics, "stage", lambda df, name: plans.append(plan_of(df)) or keep(df, name))
    rows = [("hot", None, float(i % 211), float(i)) for i in range(900)] + [("b", 1, 2.0, None)] * 3
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        check(spark, rows, 10)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(plans) > 3 and not any("SortMergeJoin" in p for p in plans)


def test_rounds_do_not_read_the_input_again(spark, monkeypatch, tmp_path):
    """Counts and the rows of large groups are taken from the input, all rounds read those rows or fewer."""
    rng = random.Random(2)
    rows = [("hot", None, rng.random(), rng.gauss(0, 1)) for _ in range(3_000)] + [("b", 1, 2.0, None)] * 3
    source = str(tmp_path / "source")
    spark.createDataFrame([(*r, 1) for r in rows], SCHEMA).repartition(5).write.parquet(source)
    read, keep = {}, group_statistics.stage

    def noted(df, name):
        read.setdefault(name, []).append(any("source" in file for file in df.inputFiles()))
        return keep(df, name)

    monkeypatch.setattr(group_statistics, "stage", noted)
    monkeypatch.setattr(group_statistics, "_CUTS", 4)
    found = group_medians(spark.read.parquet(source), ["city", "year"], ["a", "b"], in_memory_rows=4)
    got = {(r.city, r.year): [r.a, r.b] for r in found.collect()}
    assert all(same(a, b) for key, values in plain(rows).items() for a, b in zip(got[key], values, strict=True))
    assert len(read["median-ranges"]) > 1 and sum(map(sum, read.values())) == 2


def test_rows_of_small_groups_meet_before_they_are_listed(spark):
    rows = [("a", i % 40, float(i), None, 1) for i in range(200)]
    plan = plan_of(group_medians(spark.createDataFrame(rows, SCHEMA), ["year"], ["a", "b"]))
    assert plan.index("Exchange") > plan.rindex("ObjectHashAggregate")


def test_more_ranges_than_are_sent(spark, monkeypatch):
    monkeypatch.setattr(group_statistics, "_SENT", 0)
    rng = random.Random(3)
    check(spark, [(f"c{i % 5}", None, rng.gauss(0, 1), rng.choice([None, 1.0, 2.0])) for i in range(900)], 10)
