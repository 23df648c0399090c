"""Every query against its SQL counterpart in DuckDB."""

import os

import pytest

import __spark_entry__ as contract
import compare
from roentra.oracles import ORACLES
from roentra.workload import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ROWS_ONLY = {"trained_scores", "test_evaluation", "candidate_metrics", "epoch_metrics"}


@pytest.fixture(scope="module")
def duck():
    con = compare.connect(SF_DIR)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = contract.queries()[name](spark, SF_DIR)
    assert compare.differences(df, duck, contract.oracle_sql()[name]) == []


def test_every_query_has_sql_or_is_listed():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
