"""The driver contract, and the registered queries against DuckDB."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from gridscout.plans.oracles import ORACLES
from gridscout.plans.queries import QUERIES
from tests.oracle import differences, duck

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


def test_every_query_has_a_check():
    assert QUERIES.keys() == ORACLES.keys() <= queries().keys() & oracle_sql().keys()


def test_entry_gives_ranked_rows(spark):
    assert entry(spark).columns == ["rank", "doc_id", "score", "title", "url"]


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, name):
    found, n, _ = differences(spark, duck(SF_DIR), SF_DIR, name, queries()[name], oracle_sql()[name])
    assert found == [] and n > 0
