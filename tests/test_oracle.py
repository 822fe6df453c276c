"""Every registered query against its SQL in DuckDB."""

import os

import pytest

from lakeloom.queries import REGISTRY
from tests.oracle import check

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_matches_sql(spark, name):
    problem, _ = check(spark, name, SF_DIR)
    assert problem is None, problem


def test_contract():
    import __spark_entry__ as contract

    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(REGISTRY) <= set(contract.queries())
