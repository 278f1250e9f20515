"""Every registered query against its SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from tabweave import catalog

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def comparable(rows):
    return sorted(tuple("null" if v is None or v != v else repr(v) for v in row) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, tables, name):
    result = QUERIES[name](spark, SF_DIR)
    columns = sorted(result.columns)
    rows = result.select(*[f"`{c}`" for c in columns]).collect()
    if name not in SQL:
        assert rows
        return
    relation = tables.execute(SQL[name])
    names = [d[0] for d in relation.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert comparable(map(tuple, rows)) == comparable([tuple(r[i] for i in order) for r in relation.fetchall()])


def test_only_random_starts_go_without_sql():
    assert set(QUERIES) - set(SQL) == {"m9_fit_network", "m11_initial_weights"}
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry_module.entry(spark).count() == 3
