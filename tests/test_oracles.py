"""Every registered query against its SQL oracle."""

import pytest
from helpers import TESTDATA
from oracle import compare, connect

import __spark_entry__ as contract

SF_DIR = f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    text_operators = {*contract.llm.QUERIES, "pipeline"} if contract.llm else set()
    assert set(contract.queries()) - text_operators == set(contract._own_oracle_sql())


@pytest.mark.parametrize("name", sorted(contract._own_oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    ours, theirs = compare(spark, con, contract.queries()[name], contract.oracle_sql()[name], SF_DIR)
    assert ours[0] == theirs[0]
    assert ours[1] == theirs[1]


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == [
        "period_start_date", "period_type", "acq_source", "country", "active_user_count", "ds",
    ]
    assert result.count() == 487
