"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import importlib
import os

import duckdb
import pytest

from fleetpulse.plans.queries import QUERIES
from tools.compare import canonical

entry_module = importlib.import_module("__spark_entry__")


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for file in sorted(os.listdir(sf_dir)):
        connection.execute(f"CREATE VIEW {file[:-8]} AS SELECT * FROM '{sf_dir}/{file}'")
    return connection


def test_entry_gives_rows(spark):
    assert entry_module.entry(spark).count() > 0


def test_every_sql_belongs_to_a_query():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_its_sql(spark, duck, sf_dir, name):
    df = entry_module.queries()[name](spark, sf_dir)
    mine = canonical([tuple(r) for r in df.collect()], df.columns)
    sql = entry_module.oracle_sql().get(name)
    if sql is None:
        assert mine
        return
    cursor = duck.execute(sql)
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert mine == canonical(cursor.fetchall(), columns)
