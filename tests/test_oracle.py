"""Every registered query against its SQL, and the contract's own shape."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as contract
from catalog.base import QUERIES, SQL
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    """All but those of the document operators that SQL can't express, which tests/llm holds to other proof."""
    assert QUERIES and set(QUERIES) == set(SQL)
    assert set(contract.oracle_sql()) <= set(contract.queries()) and set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    problem, rows, _, _ = compare(
        spark, con, contract.queries()[name], contract.oracle_sql()[name], FOLDER
    )
    assert problem == "" and rows > 0


def test_entry(spark):
    assert contract.entry(spark).limit(1).count() == 1


def test_ordered_results_are_ordered(spark):
    rows = contract.queries()["month_ordered"](spark, FOLDER).collect()
    keys = [(-r["结算消耗"], r["账户ID"]) for r in rows]
    assert keys == sorted(keys)
