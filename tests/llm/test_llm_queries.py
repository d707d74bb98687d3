"""Registered queries of the training-data operators against their SQL, on the smallest tables."""

import pytest
from conftest import SF_DIR

from smogway.llm.queries import ORACLE, REGISTRY
from suite.check import connect, differences


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    assert differences(REGISTRY[name](spark, SF_DIR), connect(SF_DIR), ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - set(ORACLE)))
def test_query_has_a_row_per_input_row(spark, name):
    table = "pages" if "url" in name else "documents"
    assert REGISTRY[name](spark, SF_DIR).count() == spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()
