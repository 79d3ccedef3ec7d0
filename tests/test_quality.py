"""One violating row per check; it must be the only check that reports it, unless noted."""

import datetime as dt
from decimal import Decimal

import pytest
from helpers import GOOD, staging, stream, tuples
from pyspark.sql import functions as F

from growthledger.plans.active import active_users
from growthledger.plans.facts import fct_events
from growthledger.plans.lifecycle import lifecycle_weekly
from growthledger.plans.retention import retention
from growthledger.plans.users import dim_users
from growthledger.quality import models
from growthledger.quality.checks import summary
from growthledger.quality.gate import DataQualityError, failed_checks, gate
from growthledger.quality.staging import staging_checks
from growthledger.sources import schemas

STAGING_VIOLATIONS = [
    ({"event_type": "refund"}, ["accepted_values_event_type"]),
    ({"transaction_category": "books"}, ["accepted_values_transaction_category"]),
    ({"platform": "tv"}, ["accepted_values_platform"]),
    ({"utm_source": "radio"}, ["accepted_values_utm_source"]),
    ({"country": "XX"}, ["accepted_values_country"]),
    ({"event_time": None}, ["not_null_event_time"]),
    ({"user_id": None}, ["not_null_user_id"]),
    # A missing type also skips the checks that depend on it.
    ({"event_type": None, "transaction_category": None, "miles_amount": None}, ["not_null_event_type"]),
    ({"transaction_category": None}, ["not_null_transaction_category"]),
    ({"miles_amount": None}, ["not_null_miles_amount"]),
    ({"platform": None}, ["not_null_platform"]),
    ({"utm_source": None}, ["not_null_utm_source"]),
    ({"country": None}, ["not_null_country"]),
    ({"event_time": "2025-06-02 10:00:00"}, ["matches_event_time"]),
    ({"user_id": "u_00012"}, ["matches_user_id"]),
    ({"user_id": "u_0001\n"}, ["matches_user_id"]),
    ({"user_id": "xu_0001"}, ["matches_user_id"]),
]
STAGING_GOOD = [
    {},
    {"event_type": "share", "transaction_category": None, "miles_amount": None},
    {"event_type": "like", "transaction_category": "anything", "miles_amount": None},
    {"event_type": "reward_search", "miles_amount": None},
]


def test_there_are_fifteen_staging_checks(spark):
    assert len({c.name for c in staging_checks()}) == 15
    assert {name for _, names in STAGING_VIOLATIONS for name in names} == {c.name for c in staging_checks()}


@pytest.mark.parametrize("change, expected", STAGING_VIOLATIONS)
def test_staging_violation(spark, change, expected):
    rows = staging(spark, *STAGING_GOOD, change)
    assert failed_checks(rows, staging_checks()) == dict.fromkeys(expected, 1)


def test_good_staging_rows_pass(spark):
    rows = staging(spark, *STAGING_GOOD)
    assert failed_checks(rows, staging_checks()) == {}
    assert set(tuples(summary(rows, staging_checks()))) == {(c.name, 0) for c in staging_checks()}


def good_tables(spark):
    typed = stream(
        spark,
        {},
        {"user_id": "u_0002", "event_type": "share", "transaction_category": None, "miles_amount": None},
        {"event_time": "2025-06-09 08:00:00"},
    )
    events, users = fct_events(typed), dim_users(typed, "2025-06-10")
    return {
        "dim_users": (users, models.dim_users_checks()),
        "fct_events": (events, [*models.fct_events_checks(), models.miles_presence_check()]),
        "active": (active_users(events, users, "2025-01-01", "2025-06-10"), models.active_user_checks()),
        "lifecycle": (lifecycle_weekly(events, users, "2025-01-01", "2025-06-10"), models.lifecycle_checks()),
        "retention": (retention(events, "2025-01-01", "2025-06-10"), models.retention_checks()),
    }


GOOD_ROWS = {
    "dim_users": (
        schemas.DIM_USERS,
        ("u_1", "google", "SG", Decimal("5.00"), Decimal("7.00"), Decimal("-2.00"), True, True, True, "{}", "2025-06-10"),
    ),
    "fct_events": (
        schemas.FCT_EVENTS,
        (
            "id1", dt.datetime(2025, 6, 2), 2025, 6, 2, 23, "u_1", "miles_earned",
            '{"event_type":"miles_earned","transaction_category":"dining","miles_amount":1.00}', "ios", "2025-06-02",
        ),
    ),
    "active": (schemas.AGG_ACTIVE_USER, (dt.date(2025, 6, 2), "daily", "google", "SG", 3, "2025-06-10")),
    "lifecycle": (
        schemas.AGG_USER_LIFECYCLE_WEEKLY, ("WK22 2025-06-01", "google", "SG", "new", 3, "2025-06-10"),
    ),
    "retention": (
        schemas.AGG_USER_RETENTION, (dt.date(2025, 6, 1), 0, 3, 3, Decimal("100.00"), "2025-06-10"),
    ),
}


def _json(kind, category, miles):
    return f'{{"event_type":"{kind}","transaction_category":{category},"miles_amount":{miles}}}'


# table, changed columns of the second row (an empty change repeats the first), failed checks
MODEL_VIOLATIONS = [
    ("dim_users", {"user_id": None}, ["not_null_user_id"]),
    ("dim_users", {"user_id": "u_2", "acq_source": None}, ["not_null_acq_source"]),
    ("dim_users", {"user_id": "u_2", "user_country": None}, ["not_null_user_country"]),
    ("dim_users", {"ds": None}, ["not_null_ds"]),
    ("dim_users", {}, ["unique_combination_user_id_ds"]),
    ("dim_users", {"user_id": "u_2", "miles_balance": Decimal("2.00")}, ["expression_miles_balance"]),
    ("fct_events", {}, ["unique_event_id"]),
    ("fct_events", {"event_id": None}, ["not_null_event_id"]),
    ("fct_events", {"event_id": "id2", "user_id": None}, ["not_null_user_id"]),
    ("fct_events", {"event_id": "id2", "event_time": None}, ["not_null_event_time"]),
    ("fct_events", {"event_id": "id2", "ds": None}, ["not_null_ds"]),
    (
        "fct_events",
        {"event_id": "id2", "event_json": _json("miles_earned", '"dining"', "0.00")},
        ["expression_miles_positive"],
    ),
    (
        "fct_events",
        {"event_id": "id2", "event_type": "like", "event_json": '{"event_type":"like","miles_amount":null}'},
        ["expression_json_keys"],
    ),
    (
        "fct_events",
        {"event_id": "id2", "event_type": "like", "event_json": _json("like", "null", "1.00")},
        ["miles_presence"],
    ),
    (
        "fct_events",
        {"event_id": "id2", "event_type": "reward_search", "event_json": _json("reward_search", "null", "1.00")},
        ["miles_presence"],
    ),
    ("fct_events", {"event_id": "id2", "event_json": _json("miles_earned", "null", "null")}, ["miles_presence"]),
    ("active", {"period_start_date": None}, ["not_null_period_start_date"]),
    ("active", {"period_type": None}, ["not_null_period_type"]),
    ("active", {"acq_source": None}, ["not_null_acq_source"]),
    ("active", {"country": None}, ["not_null_country"]),
    ("active", {"country": "TH", "active_user_count": None}, ["not_null_active_user_count"]),
    ("active", {"country": "TH", "ds": None}, ["not_null_ds"]),
    ("active", {"period_type": "yearly"}, ["accepted_values_period_type"]),
    ("active", {}, ["unique_combination_period_start_date_period_type_acq_source_country"]),
    ("active", {"country": "TH", "active_user_count": -1}, ["expression_active_user_count"]),
    ("lifecycle", {"cutoff_week": None}, ["not_null_cutoff_week"]),
    ("lifecycle", {"acq_source": None}, ["not_null_acq_source"]),
    ("lifecycle", {"country": None}, ["not_null_country"]),
    ("lifecycle", {"user_status": None}, ["not_null_user_status"]),
    ("lifecycle", {"country": "TH", "user_count": None}, ["not_null_user_count"]),
    ("lifecycle", {"country": "TH", "ds": None}, ["not_null_ds"]),
    ("lifecycle", {"user_status": "asleep"}, ["accepted_values_user_status"]),
    ("lifecycle", {}, ["unique_combination_cutoff_week_acq_source_country_user_status"]),
    ("lifecycle", {"country": "TH", "user_count": -1}, ["expression_user_count"]),
    ("retention", {"cohort_week": None}, ["not_null_cohort_week"]),
    ("retention", {"week_offset": None}, ["not_null_week_offset"]),
    ("retention", {"week_offset": 1, "retained_users": None}, ["not_null_retained_users"]),
    ("retention", {"week_offset": 1, "cohort_size": None}, ["not_null_cohort_size"]),
    ("retention", {"week_offset": 1, "retention_rate": None}, ["not_null_retention_rate"]),
    ("retention", {"ds": None}, ["not_null_ds"]),
    ("retention", {"week_offset": 17}, ["accepted_values_week_offset"]),
    ("retention", {}, ["unique_combination_cohort_week_week_offset_ds"]),
    ("retention", {"week_offset": 1, "retained_users": -1}, ["expression_retained_users"]),
    ("retention", {"week_offset": 1, "cohort_size": 0}, ["expression_cohort_size"]),
    ("retention", {"week_offset": 1, "retention_rate": Decimal("100.01")}, ["expression_retention_rate"]),
]


def test_all_model_checks_are_violated_once(spark):
    checks = {table: {c.name for c in listed} for table, (_, listed) in good_tables(spark).items()}
    assert {t: len(names) for t, names in checks.items()} == {
        "dim_users": 6, "fct_events": 8, "active": 9, "lifecycle": 9, "retention": 11,
    }
    violated = {table: set() for table in checks}
    for table, _, names in MODEL_VIOLATIONS:
        violated[table].update(names)
    assert violated == checks


def test_built_tables_pass(spark):
    for table, (df, checks) in good_tables(spark).items():
        assert failed_checks(df, checks) == {}, table


@pytest.mark.parametrize("table, change, expected", MODEL_VIOLATIONS)
def test_model_violation(spark, table, change, expected):
    schema, row = GOOD_ROWS[table]
    second = tuple(change.get(name, value) for name, value in zip(schema.names, row, strict=True))
    checks = {
        "dim_users": models.dim_users_checks,
        "fct_events": lambda: [*models.fct_events_checks(), models.miles_presence_check()],
        "active": models.active_user_checks,
        "lifecycle": models.lifecycle_checks,
        "retention": models.retention_checks,
    }[table]()
    df = spark.createDataFrame([row, second], schema)
    assert failed_checks(df, checks) == dict.fromkeys(expected, 1)


def test_single_attribute(spark):
    rows = stream(
        spark,
        {}, {"country": "TH"},
        {"user_id": "u_0002"}, {"user_id": "u_0002", "utm_source": "tiktok"}, {"user_id": "u_0002"},
        {"user_id": "u_0003"}, {"user_id": "u_0003", "country": None},
    )
    failing = models.single_attribute_check().failing(rows).orderBy("user_id")
    assert tuples(failing) == [("u_0001", 1, 2), ("u_0002", 2, 1)]


def test_gate_stores_failing_rows_and_names_every_failed_check(spark, tmp_path):
    rows = staging(spark, {}, {"country": "XX", "user_id": "u_9999"}, {"platform": None})
    with pytest.raises(DataQualityError) as error:
        gate("stg", rows, staging_checks(), str(tmp_path))
    assert error.value.failed == {"accepted_values_country": 1, "not_null_platform": 1}
    stored = spark.read.parquet(f"{tmp_path}/stg/accepted_values_country")
    assert [tuple(r) for r in stored.collect()] == [("XX", 1)]  # the bad value and its number of records
    assert stored.columns == ["country", "n_records"]
    assert spark.read.parquet(f"{tmp_path}/stg/not_null_platform").columns == list(GOOD)


def test_row_checks_share_one_scan(spark, tmp_path):
    staging(spark, {}).write.parquet(f"{tmp_path}/stg")
    df = summary(spark.read.parquet(f"{tmp_path}/stg"), staging_checks())
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1


def test_null_passes_accepted_values_and_formats(spark):
    rows = spark.createDataFrame([(None,)], "x string")
    checks = [c for c in staging_checks() if c.name in ("accepted_values_platform", "matches_user_id")]
    nulls = rows.select(F.col("x").alias("platform"), F.col("x").alias("user_id"))
    assert failed_checks(nulls, checks) == {}
