"""Every registered query against its SQL twin."""

import pytest

import __spark_entry__ as contract
from compare import connect, differences
from tillflow.registry import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_a_twin():
    assert set(QUERIES) <= set(contract.queries()) & set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_twin(spark, sf_dir, duck, name):
    assert differences(contract.queries()[name](spark, sf_dir), duck,
                       contract.oracle_sql()[name]) == []


def test_entry(spark):
    assert contract.entry(spark).count() > 0
