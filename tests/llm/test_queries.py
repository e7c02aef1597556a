"""Registered queries against DuckDB."""

import os

import pytest

from __spark_entry__ import oracle_sql, queries
from tests.oracle import differences, duck

from gridscout.llm.oracles import ORACLES
from gridscout.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


def test_all_are_registered():
    assert QUERIES.keys() | {"pipeline"} <= queries().keys() and ORACLES.keys() <= oracle_sql().keys()
    assert sorted(int(x[2:].split("_")[0]) for x in QUERIES) == list(range(1, len(QUERIES) + 1))


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_its_sql(spark, name):
    found, n, _ = differences(spark, duck(SF_DIR), SF_DIR, name, queries()[name], oracle_sql()[name])
    assert found == [] and n > 0


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - ORACLES.keys() - {"op13_embedding_whitening"}))
def test_one_row_per_document(spark, name):
    out = queries()[name](spark, SF_DIR)
    assert out.select("doc_id").distinct().count() == 200
    if name != "op6_best_fit_packing":
        assert out.count() == 200
