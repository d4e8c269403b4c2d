"""Every registered query against its SQL on DuckDB, over whole tables."""

import re

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import compare, open_tables

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return open_tables(FOLDER)


@pytest.mark.parametrize("key", sorted(oracle_sql()))
def test_query_equals_sql(spark, tables, key):
    problem, _ = compare(spark, tables, FOLDER, key, queries()[key], oracle_sql()[key])
    assert not problem


def test_every_query_has_sql():
    optional = {key for key in queries() if re.match(r"op\d+_|pipeline$", key)}
    assert set(queries()) - optional <= set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
