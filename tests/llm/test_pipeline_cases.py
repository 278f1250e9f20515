"""Pipeline stages on awkward rows: nulls, empty and long texts, repeated rows, empty tables, clashing columns."""

import os
import random
from collections import Counter

import corpus_pipeline
import pytest
from helpers import SCHEMA, corpus, frame, prose

from tabweave.storage import shared_dir

STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    rows = [(1, 1, 0), (2, 0, 1), (None, 1, None), (3, None, 0), (3, 1, 0)]
    spark.createDataFrame(rows, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


@pytest.mark.parametrize("name", list(STAGES)[:-1])
def test_stage_keeps_columns(spark, sf_dir, name):
    docs = frame(spark, corpus(), clashing=True)
    out = STAGES[name](spark, docs, sf_dir)
    assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
    rows = out.collect()
    assert 0 < len(rows) <= len(corpus())
    others = [c for c in docs.columns if c not in ("text", "n_chars")]
    given = Counter(tuple(r[c] for c in others) for r in docs.collect())
    kept = Counter(tuple(r[c] for c in others) for r in rows)
    assert not kept - given


@pytest.mark.parametrize("name", list(STAGES))
def test_stage_of_an_empty_table(spark, sf_dir, name):
    assert STAGES[name](spark, spark.createDataFrame([], SCHEMA), sf_dir).collect() == []


def test_run_is_all_stages(spark, sf_dir, tmp_path):
    rng = random.Random(0)
    rows = [(i, prose(rng, 60, 3_000), "en", "s", 0) for i in range(30)] + [(100, None, None, None, None)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in found} == set(range(30))


def test_runs_side_by_side_and_their_release(spark):
    """A later run leaves the result of an earlier one readable, and nothing stays behind two released runs."""
    sf_dir, shared = "/root/testdata/sf0.001", shared_dir(spark)
    before = set(os.listdir(shared))
    first = corpus_pipeline.start(spark, sf_dir)
    rows = first.frame.count()
    second = corpus_pipeline.start(spark, sf_dir)
    assert first.frame.count() == rows == second.frame.count() > 0
    first.release()
    assert second.frame.count() == rows
    second.release()
    assert set(os.listdir(shared)) == before


def test_stage_names_that_clash_in_packing(spark, sf_dir):
    docs = frame(spark, corpus(), clashing=True).selectExpr("*", "1 AS start", "2 AS length", "3 AS block", "4 AS sequence_id", "5 AS __piece")
    found = STAGES["packing"](spark, docs, sf_dir).collect()
    assert {r.doc_id for r in found} == {r[0] for r in corpus()}


def test_a_stage_judges_rows_not_ids(spark, sf_dir):
    """Rows that share an id have texts of their own; a row that repeats both stays once."""
    rng = random.Random(1)
    a, b = prose(rng, 40, 3_000), prose(rng, 40, 3_000)
    rows = [(1, a, "x", "s", 0), (1, b, "y", "s", 0), (1, a, "x", "s", 0), (2, b, "z", "s", 0)]
    out = STAGES["exact_dedup"](spark, frame(spark, rows), sf_dir).collect()
    assert sorted((r.doc_id, r.lang) for r in out) == [(1, "x"), (1, "y")]
    out = STAGES["near_dedup"](spark, frame(spark, rows), sf_dir).collect()
    assert sorted((r.doc_id, r.lang) for r in out) == [(1, "x"), (1, "y")]
