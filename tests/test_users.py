import json
from decimal import Decimal

from helpers import stream, tuples

from growthledger.plans.users import dim_users, latest_event_per_user
from growthledger.sources.schemas import DIM_USERS


def test_totals_flags_and_latest_event(spark):
    events = stream(
        spark,
        {"event_time": "2025-05-25 00:00:00", "miles_amount": "10.50"},
        {"event_time": "2025-05-24 23:59:59", "event_type": "miles_redeemed", "miles_amount": "30.00"},
        {"event_time": "2025-05-01 00:00:00", "event_type": "share", "miles_amount": None},
        {"user_id": "u_0002", "event_time": "2025-05-24 23:59:59"},
        {"user_id": "u_0003", "event_time": "2025-03-03 00:00:00"},
        {"user_id": "u_0004", "event_time": "2025-03-02 23:59:59"},
        {"user_id": "u_0005", "event_time": "2026-01-01 00:00:00"},  # in the future: active
    )
    users = dim_users(events, "2025-06-01")
    assert users.columns == DIM_USERS.names
    rows = {r.user_id: r for r in users.collect()}
    first = rows["u_0001"]
    assert (first.total_miles_earned, first.total_miles_redeemed, first.miles_balance) == (
        Decimal("10.50"), Decimal("30.00"), Decimal("-19.50"),
    )
    assert json.loads(first.latest_event_json) == {
        "event_time": "2025-05-25T00:00:00", "event_type": "miles_earned",
        "transaction_category": "dining", "miles_amount": 10.5,
    }
    flags = {u: (r.active_in_7days, r.active_in_30days, r.active_in_90days) for u, r in rows.items()}
    assert flags == {
        "u_0001": (True, True, True),
        "u_0002": (False, True, True),
        "u_0003": (False, False, True),
        "u_0004": (False, False, False),
        "u_0005": (True, True, True),
    }
    assert {r.ds for r in rows.values()} == {"2025-06-01"}


def test_latest_event_ties_and_missing_time(spark):
    events = stream(
        spark,
        {"event_type": "like"}, {"event_type": "share"}, {"event_type": "miles_earned"},
        {"user_id": "u_0002", "event_time": None, "event_type": "like"}, {"user_id": "u_0002"},
    )
    latest = {r.user_id: r.event_type for r in latest_event_per_user(events).collect()}
    assert latest == {"u_0001": "share", "u_0002": "like"}


def test_user_with_two_sources_gets_two_rows_with_one_latest_event(spark):
    events = stream(
        spark,
        {"utm_source": "google", "event_time": "2025-06-01 00:00:00"},
        {"utm_source": "tiktok", "event_time": "2025-06-02 00:00:00"},
    )
    rows = dim_users(events, "2025-06-03").collect()
    assert sorted(r.acq_source for r in rows) == ["google", "tiktok"]
    assert {json.loads(r.latest_event_json)["event_time"] for r in rows} == {"2025-06-02T00:00:00"}


def test_event_without_user_has_no_latest_event(spark):
    rows = tuples(dim_users(stream(spark, {"user_id": None}), "2025-06-03").select("user_id", "latest_event_json"))
    assert rows == [
        (None, '{"event_time":null,"event_type":null,"transaction_category":null,"miles_amount":null}')
    ]
