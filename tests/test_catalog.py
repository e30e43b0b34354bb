"""Every query against its SQL twin."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from meterlens.plans.catalog import QUERIES
from meterlens.plans.oracle import ORACLES

# Trained trees have no SQL twin; they are tested on their own.
WITHOUT_SQL = {"gbt_score"}


@pytest.fixture(scope="module")
def database(folder):
    connection = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_every_query_has_a_twin():
    assert set(QUERIES) - set(ORACLES) == WITHOUT_SQL
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, folder, database, name):
    result = QUERIES[name](spark, folder)
    columns = sorted(result.columns)
    found = database.execute(ORACLES[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == columns
    expected = [tuple(repr(r[names.index(c)]) for c in columns) for r in found.fetchall()]
    actual = [tuple(repr(r[c]) for c in columns) for r in result.collect()]
    assert sorted(actual) == sorted(expected)


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_sketch_query_runs(spark, folder):
    rows = QUERIES["dgim_count"](spark, folder)
    exact = QUERIES["dgim_closed_form"](spark, folder)
    assert rows.count() == exact.count()
