"""Every registered query against its SQL, at the smallest scale."""

import pytest

from workload.check import compare
from workload.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, name):
    assert compare(spark, SF_DIR, [name]) == []


def test_contract(spark):
    import __spark_entry__ as contract

    assert set(QUERIES) == set(ORACLES) <= set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).columns == ["url", "status", "cdx_title", "html_base64"]
