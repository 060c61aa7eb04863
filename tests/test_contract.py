"""Every registered query against its DuckDB equivalent at the smallest scale."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from checks.compare import TESTDATA, difference, duckdb_over

SF_DIR = f"{TESTDATA}/sf0.001"
OPTIONAL, _ = contract._optional()  # tested with their subpackage
QUERIES = {name: query for name, query in contract.queries().items() if name not in OPTIONAL}
ORACLES = {name: sql for name, sql in contract.oracle_sql().items() if name not in OPTIONAL}


@pytest.fixture(scope="module")
def duck():
    with duckdb_over(SF_DIR) as connection:
        yield connection


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_oracle(spark, duck, name):
    assert difference(QUERIES[name](spark, SF_DIR), duck, ORACLES[name]) is None


def test_entry(spark):
    found = contract.entry(spark)
    assert found.columns[:2] == ["depute_uid", "nom_complet"]
    assert found.count() > 0
