"""Every registered query against its SQL on the smallest tables."""

import pytest
from conftest import SF_DIR

from suite.check import connect, differences
from suite.oracle import ORACLE
from suite.queries import REGISTRY

import __spark_entry__ as contract


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_sql(spark, con, name):
    assert differences(REGISTRY[name](spark, SF_DIR), con, ORACLE[name]) is None


def test_contract(spark):
    assert set(REGISTRY) == set(ORACLE)
    assert set(contract.oracle_sql()) <= set(contract.queries())
    flagship = contract.entry(spark)
    assert {"timestamp", "road_segment_id", "severity_index"} <= set(flagship.columns)
    assert flagship.count() > 0
