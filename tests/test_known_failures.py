"""Queries over rows that fail a check by nature, as the given tables hold them from sf0.1 on."""

import duckdb
import pytest
from oracle import compare, connect

import __spark_entry__ as contract
from growthledger.quality.gate import DataQualityError


def folder_with(tmp_path, user, value):
    """40 purchases of ten users; ``user`` and ``value``: SQL over the row number."""
    with duckdb.connect() as con:
        con.execute(
            f"COPY (SELECT i AS event_id, TIMESTAMP '2024-01-02 10:00:00' + to_hours(17 * CAST(i AS INTEGER)) AS ts, "
            f"CAST({user} AS BIGINT) AS user_id, 'purchase' AS event_type, CAST({value} AS DOUBLE) AS value FROM range(40) t(i)) "
            f"TO '{tmp_path}/events.parquet'"
        )
    return str(tmp_path)


@pytest.mark.parametrize(
    "name",
    [
        f"{kind}_{table}"
        for kind, tables in {
            "incremental": ["active", "facts", "lifecycle", "retention", "stream"],
            "pipeline": ["active", "lifecycle", "retention"],
            "pipeline_run": ["active", "lifecycle", "retention"],
        }.items()
        for table in tables
    ],
)
def test_amounts_that_round_to_zero_miles(spark, tmp_path, name):
    sf_dir = folder_with(tmp_path, "i % 10 + 90", "CASE WHEN i % 20 = 7 THEN 0.001 ELSE i + 1 END")
    ours, theirs = compare(spark, connect(sf_dir), contract.queries()[name], contract.oracle_sql()[name], sf_dir)
    assert ours == theirs and ours[1]


@pytest.mark.parametrize("name", ["ingest_csv", "incremental_facts", "pipeline_retention"])
def test_users_with_numbers_of_five_digits(spark, tmp_path, name):
    sf_dir = folder_with(tmp_path, "i % 10 + 9995", "i + 1")
    ours, theirs = compare(spark, connect(sf_dir), contract.queries()[name], contract.oracle_sql()[name], sf_dir)
    assert ours == theirs and ours[1]


def test_other_raw_checks_still_stop_the_ingest(spark, tmp_path):
    sf_dir = folder_with(tmp_path, "CASE WHEN i > 0 THEN i + 9995 END", "i + 1")
    with pytest.raises(DataQualityError) as error:
        contract.queries()["ingest_csv"](spark, sf_dir)
    assert error.value.failed["not_null_user_id"] == 1 and "matches_user_id" not in error.value.failed
