import hashlib

import pytest
from pyspark.sql import functions as F

from tabweave.operators import shuffle_split
from tabweave.operators.shuffle_split import seeded_shuffle, split_ends, three_way_split

NAMES = ("train", "val", "test")


def sizes(df):
    found = {r["split"]: r["count"] for r in df.groupBy("split").count().collect()}
    return tuple(found.get(n, 0) for n in NAMES)


def expected_sizes(n):
    train, val = split_ends(n)
    return train, val - train, n - val


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 10, 20, 100])
def test_exact_sizes_for_small_tables(spark, n):
    df = spark.range(n).select(F.col("id").alias("k"))
    assert sizes(three_way_split(df, key=["k"])) == expected_sizes(n)


def test_same_rows_as_cutting_the_shuffle_by_position(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    split = {r["k"]: r["split"] for r in three_way_split(df, seed=5, key=["k"]).collect()}
    ranks = {r["k"]: r["rank"] for r in seeded_shuffle(df, seed=5, key=["k"]).collect()}
    assert sorted(ranks.values()) == list(range(1000))
    keys = sorted(range(1000), key=lambda k: hashlib.md5(f"5:{k}".encode()).hexdigest())
    assert [ranks[k] for k in keys] == list(range(1000))
    assert all(split[k] == ("train" if r < 700 else "val" if r < 850 else "test") for k, r in ranks.items())


def test_split_does_not_depend_on_partitions_but_on_the_seed(spark):
    df = spark.range(500).select(F.col("id").alias("k"))
    one = {tuple(r) for r in three_way_split(df.repartition(1), key=["k"]).collect()}
    many = {tuple(r) for r in three_way_split(df.repartition(9), key=["k"]).collect()}
    other = {tuple(r) for r in three_way_split(df, seed=43, key=["k"]).collect()}
    assert one == many
    assert one != other


def test_deep_search_for_the_cuts(spark, monkeypatch):
    df = spark.range(3000).select(F.col("id").alias("k"))
    plain = {tuple(r) for r in three_way_split(df, key=["k"]).collect()}
    monkeypatch.setattr(shuffle_split, "_CELL_ROWS", 0)
    monkeypatch.setattr(shuffle_split, "_STEP_DIGITS", 1)
    deep = {tuple(r) for r in three_way_split(df, key=["k"]).collect()}
    assert deep == plain


def test_table_is_not_shuffled(spark):
    df = spark.range(100).select(F.col("id").alias("k"))
    plan = three_way_split(df, key=["k"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan


@pytest.mark.parametrize("hot", [0, 400, 1000])
def test_copies_without_a_key(spark, hot, monkeypatch):
    """Equal rows on both sides of a cut: sizes stay exact and no row is lost."""
    monkeypatch.setattr(shuffle_split, "_COPIES_PER_TASK_ROW", 64)
    df = spark.range(1200).select(F.when(F.col("id") < hot, F.lit("same")).otherwise(F.col("id").cast("string")).alias("v"))
    for seed in range(3):
        out = three_way_split(df, seed=seed)
        assert sizes(out) == expected_sizes(1200)
        assert out.columns == ["v", "order_key", "split"]
        assert out.filter("v = 'same'").count() == hot
    ranks = [r["rank"] for r in seeded_shuffle(df).select("rank").collect()]
    assert sorted(ranks) == list(range(1200))


def test_key_that_is_not_unique(spark):
    df = spark.range(900).select(F.when(F.col("id") < 600, -1).otherwise(F.col("id")).alias("k"), "id")
    for seed in range(3):
        out = three_way_split(df, seed=seed, key=["k"])
        assert sizes(out) == expected_sizes(900)
        assert out.select("id").distinct().count() == 900


def test_null_and_odd_values_are_keys_too(spark):
    df = spark.createDataFrame([(None, 1), ("a", None), (None, None), ("", 2)], "s string, i int")
    assert sorted(str(tuple(r)[:2]) for r in three_way_split(df).collect()) == sorted(str(tuple(r)) for r in df.collect())
