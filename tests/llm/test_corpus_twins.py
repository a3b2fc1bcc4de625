"""The corpus queries against their SQL twins, and the entry points."""

import pytest

import __spark_entry__ as contract
from compare import connect, differences
from tillflow.llm.queries import ORACLES, QUERIES


def test_all_operators_and_the_pipeline():
    names = [n for n in contract.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in contract.queries() and len(contract.oracle_sql()) > len(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_twin(spark, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) == []
