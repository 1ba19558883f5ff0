"""Every registered query against its DuckDB counterpart, at the scale of the driver's check."""

import duckdb
import pytest

import __spark_entry__ as entry
from verdigris.verification import catalog
from verdigris.verification.compare import difference, register_tables

ORACLE_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    register_tables(connection, ORACLE_DIR)
    return connection


def test_every_query_has_an_oracle():
    assert set(catalog.all_queries()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.all_queries()))
def test_query_equals_oracle(spark, database, name):
    found = entry.queries()[name](spark, ORACLE_DIR).toPandas()
    assert difference(found, database.sql(entry.oracle_sql()[name]).df()) is None


def test_entry(spark):
    rows = {r.model_id: r.accuracy for r in entry.entry(spark).collect()}
    assert set(rows) == {"base", "tuned"} and rows["tuned"] > rows["base"] > 0


def test_checkpoint_counts(spark):
    rows = {r.model_id: r.num_correct for r in entry.queries()["accuracy_by_model"](spark, ORACLE_DIR).collect()}
    assert rows == {"base": 11563, "tuned": 13281}
