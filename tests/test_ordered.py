import random
from collections import Counter

import pandas as pd
from pyspark.sql import functions as F

from tabweave.operators.ordered import Running, assign_slices, plan_slices, running


def brute(rows, descending=False):
    """Running measures per group by a plain loop over (group, place, value)."""
    out = {}
    for g in {r[0] for r in rows}:
        total, low, high, last = 0, None, None, None
        for _, place, v in sorted((r for r in rows if r[0] == g), key=lambda r: r[1], reverse=descending):
            before = last
            if v is not None:
                total += v
                low = v if low is None else min(low, v)
                high = v if high is None else max(high, v)
                last = v
            out[(g, place)] = (total, low, high, before)
    return out


def sample(n, groups, seed=1):
    rng = random.Random(seed)
    places = rng.sample(range(10 * n), n)
    # One group owns most rows.
    return [
        ("hot" if rng.random() < 0.6 else f"g{rng.randrange(groups)}", p, rng.randrange(100) if rng.random() < 0.8 else None)
        for p in places
    ]


def measures():
    v = F.col("v")
    return {
        "total": Running("sum", v),
        "low": Running("min", v),
        "high": Running("max", v),
        "before": Running("last", v, include_current=False),
    }


def test_partitioned_running_measures_over_many_slices(spark):
    rows = sample(400, 5)
    df = spark.createDataFrame(rows, "g string, place int, v int").repartition(7)
    slicing = plan_slices(df, "place", rows_per_slice=30)
    assert len(slicing.cuts) > 8
    sliced = assign_slices(df, "place", slicing)
    assert sliced.groupBy("slice").count().agg(F.max("count")).first()[0] <= 60
    got = running(sliced, measures() | {"rows": Running("whole", F.lit(1))}, "place", ["g"]).collect()
    assert {r["g"]: r["rows"] for r in got} == Counter(r[0] for r in rows)
    assert {(r["g"], r["place"]): (r["total"], r["low"], r["high"], r["before"]) for r in got} == brute(rows)
    assert len(got) == len(rows)


def test_single_slice_gives_the_same(spark):
    rows = sample(100, 3)
    df = spark.createDataFrame(rows, "g string, place int, v int")
    slicing = plan_slices(df, "place")
    assert slicing.single
    got = running(assign_slices(df, "place", slicing), measures(), "place", ["g"], single_slice=True).collect()
    assert {(r["g"], r["place"]): (r["total"], r["low"], r["high"], r["before"]) for r in got} == brute(rows)


def test_global_descending_order(spark):
    rows = [("all", p, v) for _, p, v in sample(300, 1)]
    df = spark.createDataFrame(rows, "g string, place int, v int")
    sliced = assign_slices(df, "place", plan_slices(df, "place", rows_per_slice=25))
    kinds = {k: m for k, m in measures().items() if k != "before"}
    got = running(sliced, kinds, "place", descending=True).collect()
    expected = {k: v[:3] for k, v in brute(rows, descending=True).items()}
    assert {(r["g"], r["place"]): (r["total"], r["low"], r["high"]) for r in got} == expected


def test_no_window_without_partition_on_the_rows(spark):
    df = spark.range(1000).select(F.col("id").alias("place"), F.lit(1).alias("v"))
    sliced = assign_slices(df, "place", plan_slices(df, "place", rows_per_slice=50))
    plan = running(sliced, {"total": Running("sum", F.col("v"))}, "place")._jdf.queryExecution().toString()
    scans = [line for line in plan.splitlines() if "Window [" in line and "sum(v" in line]
    assert scans and all("slice" in line.split("], [")[1] for line in scans)


def test_nan_and_repeated_values_have_a_slice(spark):
    values = [float("nan"), 1.0, 1.0, 1.0, 1.0, 2.0, 3.0, -4.0, float("inf")]
    df = spark.createDataFrame(pd.DataFrame({"v": values}))
    sliced = assign_slices(df, "v", plan_slices(df, "v", rows_per_slice=2)).collect()
    by_value = {}
    for r in sliced:
        by_value.setdefault(str(r["v"]), set()).add(r["slice"])
    assert all(len(s) == 1 for s in by_value.values())
    order = ["-4.0", "1.0", "2.0", "3.0", "inf", "nan"]
    slices = [next(iter(by_value[k])) for k in order]
    assert slices == sorted(slices)


def test_empty_input(spark):
    df = spark.createDataFrame([], "place int, v int")
    assert plan_slices(df, "place").single


def test_null_partitions_in_one_slice_and_in_many(spark):
    rows = [(None if g == "hot" else g, p, v) for g, p, v in sample(200, 3)]
    df = spark.createDataFrame(rows, "g string, place int, v int")
    sliced = assign_slices(df, "place", plan_slices(df, "place", rows_per_slice=20))
    many = running(sliced, measures(), "place", ["g"]).collect()
    one = running(df.withColumn("slice", F.lit(0)), measures(), "place", ["g"], single_slice=True).collect()

    def values(found):
        return {(r["g"], r["place"]): (r["total"], r["low"], r["high"], r["before"]) for r in found}

    assert len(many) == len(one) == 200
    assert values(many) == values(one) == brute(rows)


def test_many_slices_are_cut_in_two_steps(spark, monkeypatch):
    monkeypatch.setattr("tabweave.operators.ordered._FIRST_LOOK", 8)
    df = spark.range(4_000).select((F.col("id") * 7 % 4_001).alias("place"))
    slicing = plan_slices(df, "place", rows_per_slice=50)
    sizes = [r["count"] for r in assign_slices(df, "place", slicing).groupBy("slice").count().collect()]
    assert len(sizes) >= 70 and max(sizes) <= 100
