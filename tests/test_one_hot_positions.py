"""Positions of one-hot columns whose vocabularies are tables."""

import pytest

from tabweave.operators import encode
from tabweave.operators.encode import one_hot_positions, vocabulary_table

COLUMNS = ["part", "flag", "empty"]


@pytest.mark.parametrize("sent", [0, 100_000])
def test_positions_of_rows_with_copies_and_nulls(spark, monkeypatch, sent):
    """Small vocabularies are sent, so rows with one flag, or none, do not meet in one task."""
    monkeypatch.setattr(encode, "_SENT_VALUES", sent)
    rows = [(i % 50, None if i % 5 == 0 else i % 17, None if i % 2 else "AB"[i // 2 % 2], None) for i in range(90)]
    rows += [(None, 3, "A", None), (None, None, None, None), (99, 1_000, "Z", None)]
    df = spark.createDataFrame(rows, "id int, part int, flag string, empty string").repartition(3)
    vocabulary = vocabulary_table(df.where("id IS NULL OR id < 99"), COLUMNS)
    place = {(r.feature, r.value): r.position for r in vocabulary.collect()}
    expected = {}
    for key, *values in rows:
        found = [place.get((c, None if v is None else str(v))) for c, v in zip(COLUMNS, values, strict=True)]
        expected.setdefault(key, []).extend(p for p in found if p is not None)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        positions = one_hot_positions(df, vocabulary, COLUMNS, "id")
        plan = positions._jdf.queryExecution().executedPlan().toString()
        got = {r.id: r.positions for r in positions.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == {k: sorted(v) for k, v in expected.items()}
    assert ("BroadcastHashJoin" in plan) == bool(sent) and "Generate" not in plan


def test_no_values_at_all(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, None)], "id int, part string")
    found = one_hot_positions(df, vocabulary_table(df, ["part"]), ["part"], "id").collect()
    assert sorted(map(tuple, found)) == [(1, []), (2, [])]
