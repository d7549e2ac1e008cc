"""Every registered query beside its SQL oracle, and the shape of the entry module."""

import pytest

import __spark_entry__ as contract
from compare import compare, duck
from conftest import TESTDATA
from shelfmark.plans.queries import REGISTRY

ORACLES = contract.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return duck(str(TESTDATA))


def test_every_query_has_an_oracle():
    assert set(REGISTRY) <= set(contract.queries()) and set(REGISTRY) <= set(ORACLES) <= set(contract.queries())


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query_matches_oracle(spark, connection, name):
    problem, _, _, _ = compare(spark, connection, str(TESTDATA), contract.queries()[name], ORACLES[name])
    assert problem == ""


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns[:3] == ["op", "version", "id"] and frame.count() > 0
