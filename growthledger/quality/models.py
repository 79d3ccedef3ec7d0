"""The checks on each built table.

The two aggregate tables that are checked for unique keys without ``ds`` have to be
checked one snapshot at a time.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.jsonmap import has_json_key, json_number, json_text
from ..sources.schemas import MAX_WEEK_OFFSET, PERIOD_TYPES, USER_STATUSES
from .checks import (
    Check,
    GroupCheck,
    RowCheck,
    accepted_values,
    expression_is_true,
    not_null,
    single_value_per,
    unique,
    unique_combination,
)

def single_attribute_check() -> GroupCheck:
    """Users of the event stream with several sources or countries."""
    return single_value_per(
        "user_id",
        {"utm_source": "acq_source_count", "country": "country_count"},
        name="single_attribute_per_user",
    )


def miles_presence_check() -> RowCheck:
    """Miles on an event that must not have any, or none on one that must."""
    has_miles = json_text(F.col("event_json"), "miles_amount").isNotNull()
    kind = F.col("event_type")
    without = kind.isin("share", "like", "reward_search")
    with_miles = kind.isin("miles_earned", "miles_redeemed")
    return RowCheck("miles_presence", (without & has_miles) | (with_miles & ~has_miles))


def dim_users_checks() -> list[Check]:
    balance = F.col("total_miles_earned") - F.col("total_miles_redeemed")
    return [
        not_null("user_id"),
        not_null("acq_source"),
        not_null("user_country"),
        not_null("ds"),
        unique_combination("user_id", "ds"),
        expression_is_true("miles_balance", F.col("miles_balance") == balance),
    ]


def fct_events_checks() -> list[Check]:
    document = F.col("event_json")
    miles = json_number(document, "miles_amount")
    keys = [has_json_key(document, k) for k in ("event_type", "transaction_category", "miles_amount")]
    return [
        unique("event_id"),
        not_null("event_id"),
        not_null("user_id"),
        not_null("event_time"),
        not_null("ds"),
        expression_is_true("miles_positive", miles.isNull() | (miles > 0)),
        expression_is_true("json_keys", keys[0] & keys[1] & keys[2]),
    ]


def active_user_checks() -> list[Check]:
    key = ("period_start_date", "period_type", "acq_source", "country")
    return [
        *map(not_null, key),
        not_null("active_user_count"),
        not_null("ds"),
        accepted_values("period_type", PERIOD_TYPES),
        unique_combination(*key),
        _at_least("active_user_count", 0),
    ]


def lifecycle_checks() -> list[Check]:
    key = ("cutoff_week", "acq_source", "country", "user_status")
    return [
        *map(not_null, key),
        not_null("user_count"),
        not_null("ds"),
        accepted_values("user_status", USER_STATUSES),
        unique_combination(*key),
        _at_least("user_count", 0),
    ]


def retention_checks() -> list[Check]:
    columns = ("cohort_week", "week_offset", "retained_users", "cohort_size", "retention_rate", "ds")
    rate: Column = F.col("retention_rate")
    return [
        *map(not_null, columns),
        accepted_values("week_offset", list(range(MAX_WEEK_OFFSET + 1))),
        unique_combination("cohort_week", "week_offset", "ds"),
        _at_least("retained_users", 0),
        _at_least("cohort_size", 1),
        expression_is_true("retention_rate", (rate >= 0) & (rate <= 100)),
    ]


def _at_least(column: str, bound: int) -> RowCheck:
    return expression_is_true(column, F.col(column) >= bound)
