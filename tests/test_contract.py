"""Every registered query against its independent SQL."""

import pytest

import __spark_entry__ as contract
from conftest import DATA
from oracle_check import compare, duck


@pytest.fixture(scope="module")
def connection():
    return duck(DATA)


OWN = sorted(set(contract.queries()) - set(contract.CORPUS_QUERIES))


def test_every_query_has_sql():
    assert set(OWN) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", OWN)
def test_query_matches_sql(spark, connection, name):
    ours, theirs = compare(spark, connection, DATA, name)
    assert ours == theirs


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
