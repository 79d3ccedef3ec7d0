"""The fifteen checks on the raw text rows."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from ..sources.schemas import COUNTRIES, EVENT_TYPES, PLATFORMS, TRANSACTION_CATEGORIES, UTM_SOURCES
from .checks import RowCheck, accepted_values, matches, not_null

# Patterns of the two formatted columns.
EVENT_TIME_PATTERN = r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\.\d{6}"
USER_ID_PATTERN = r"u_\d{4}"


def staging_checks() -> list[RowCheck]:
    """Built on demand: Column expressions need a running session."""
    has_category = ~F.col("event_type").isin("share", "like")
    has_miles = ~F.col("event_type").isin("share", "like", "reward_search")

    accepted = [
        accepted_values("event_type", EVENT_TYPES),
        accepted_values("transaction_category", TRANSACTION_CATEGORIES),
        accepted_values("platform", PLATFORMS),
        accepted_values("utm_source", UTM_SOURCES),
        accepted_values("country", COUNTRIES),
    ]
    required = [
        not_null(column)
        for column in (
            "event_time", "user_id", "event_type", "transaction_category",
            "miles_amount", "platform", "utm_source", "country",
        )
    ]
    formats = [matches("event_time", EVENT_TIME_PATTERN), matches("user_id", USER_ID_PATTERN)]

    only_for = {
        "accepted_values_transaction_category": has_category,
        "not_null_transaction_category": has_category,
        "not_null_miles_amount": has_miles,
    }
    return [
        replace(c, bad=only_for[c.name] & c.bad) if c.name in only_for else c
        for c in [*accepted, *required, *formats]
    ]

