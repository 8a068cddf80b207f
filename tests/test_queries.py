"""Every registered query against its SQL at the smallest scale."""

import pytest

import __spark_entry__ as contract
from checks.compare import compare, duck
from checks.registry import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, SF, name) == ""


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).columns[:3] == ["query", "result_position", "video_id"]
