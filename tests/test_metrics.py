import datetime as dt
from decimal import Decimal

import pytest
from helpers import TESTDATA
from helpers import active_in, stream, tuples
from pyspark.sql import functions as F

from growthledger.plans import reports
from growthledger.plans.active import active_users
from growthledger.plans.facts import fct_events
from growthledger.plans.lifecycle import lifecycle_weekly, lifecycle_weekly_from_history, user_week_history
from growthledger.plans.retention import retention
from growthledger.plans.users import dim_users
from growthledger.sources.adapters import ORDERS_AS_OF, ORDERS_START_DS, orders_stream

START, AS_OF = "2025-01-01", "2025-12-31"
BOTH_FORMS = pytest.mark.parametrize("form", [lifecycle_weekly, lifecycle_weekly_from_history])


def weeks(*numbers):
    """Labels of the n-th weeks of a year that starts with the week of 2025-01-05."""
    return [(dt.date(2025, 1, 5) + dt.timedelta(weeks=n - 1)).isoformat() for n in numbers]


def built(spark, *events):
    typed = stream(spark, *events)
    return fct_events(typed), dim_users(typed, AS_OF)


def statuses(spark, form, events, country):
    """Status per week of the only user of a country."""
    counts = form(*built(spark, *events), START, AS_OF).where(F.col("country") == country)
    rows = counts.select(F.split("cutoff_week", " ")[1].alias("week"), "user_status", "user_count")
    assert all(r.user_count == 1 for r in rows.collect())
    return [r.user_status for r in rows.orderBy("week").collect()]


@BOTH_FORMS
def test_lifecycle_example(spark, form):
    events = active_in("u_1234", *weeks(1, 2, 5, 6), country="TH") + active_in("u_0002", *weeks(3, 4))
    assert statuses(spark, form, events, "TH") == ["new", "retained", "dormant", "dormant", "retained", "retained"]


@BOTH_FORMS
def test_lifecycle_four_week_edge(spark, form):
    everyone = active_in("u_0002", *weeks(*range(1, 9)))
    gone = active_in("u_1234", *weeks(1), country="TH") + everyone
    assert statuses(spark, form, gone, "TH") == ["new", *["dormant"] * 4, *["churned"] * 3]
    back = active_in("u_1234", *weeks(1, 7), country="TH") + everyone
    assert statuses(spark, form, back, "TH") == [
        "new", *["dormant"] * 4, "churned", "resurrected", "dormant",
    ]
    in_time = active_in("u_1234", *weeks(1, 5), country="TH") + everyone
    assert statuses(spark, form, in_time, "TH")[4] == "retained"


@BOTH_FORMS
def test_lifecycle_skips_weeks_without_anybody(spark, form):
    events = active_in("u_1234", *weeks(1), country="TH") + active_in("u_0002", *weeks(1, 2, 4, 5, 6, 7))
    # Week 6 is four rows after week 1, as week 3 does not exist.
    assert statuses(spark, form, events, "TH") == ["new", *["dormant"] * 4, "churned"]


def test_history_of_the_example(spark):
    events = active_in("u_1234", *weeks(1, 2, 5, 6)) + active_in("u_0002", *weeks(3, 4))
    history = user_week_history(*built(spark, *events), START).where("user_id = 'u_1234'").orderBy("week_start")
    before = [r.last_active_week for r in history.collect()]
    assert [b and b.isoformat() for b in before] == [None, *weeks(1, 2, 2, 2, 5)]
    assert {r.first_week.isoformat() for r in history.collect()} == set(weeks(1))


def test_history_keeps_a_long_absence_as_one_row(spark):
    events = active_in("u_1234", *weeks(1, 9)) + active_in("u_0002", *weeks(*range(1, 21)))
    history = user_week_history(*built(spark, *events), START).where("user_id = 'u_1234'").orderBy("number")
    assert [(r.number, r.n_weeks, r.is_active) for r in history.collect()] == [
        (1, 1, 1), (2, 1, 0), (3, 1, 0), (4, 1, 0), (5, 1, 0), (6, 3, 0),
        (9, 1, 1), (10, 1, 0), (11, 1, 0), (12, 1, 0), (13, 1, 0), (14, 7, 0),
    ]


def test_active_users_by_period(spark):
    events, users = built(
        spark,
        {"event_time": "2025-06-01 08:00:00"}, {"event_time": "2025-06-01 09:00:00"},
        {"event_time": "2025-06-02 08:00:00"}, {"event_time": "2025-06-03 08:00:00"},
        {"user_id": "u_0002", "event_time": "2025-06-03 23:59:59"},
        {"user_id": "u_0003", "event_time": "2025-06-03 00:00:00", "country": "TH"},
        {"user_id": "u_0001", "event_time": "2024-12-31 00:00:00"},  # before the start
    )
    result = active_users(events, users, START, AS_OF)
    day = dt.date
    assert [tuple(r)[:5] for r in result.collect()] == [
        (day(2025, 5, 25), "weekly", "google", "SG", 1),
        (day(2025, 6, 1), "daily", "google", "SG", 1),
        (day(2025, 6, 1), "monthly", "google", "SG", 2),
        (day(2025, 6, 1), "monthly", "google", "TH", 1),
        (day(2025, 6, 1), "weekly", "google", "SG", 2),
        (day(2025, 6, 1), "weekly", "google", "TH", 1),
        (day(2025, 6, 2), "daily", "google", "SG", 1),
        (day(2025, 6, 3), "daily", "google", "SG", 2),
        (day(2025, 6, 3), "daily", "google", "TH", 1),
    ]


def test_users_outside_the_snapshot_are_not_counted(spark):
    events, users = built(spark, {}, {"user_id": "u_0002"})
    known = users.where("user_id = 'u_0001'")
    assert {r.active_user_count for r in active_users(events, known, START, AS_OF).collect()} == {1}


def test_retention_rate_and_window(spark):
    events, _ = built(
        spark,
        *active_in("u_0001", *weeks(1, 2, 17)),
        *active_in("u_0002", *weeks(1, 18)),
        *active_in("u_0003", *weeks(1, 2, 2)),
        *active_in("u_0004", *weeks(2)),
        {"user_id": None},
    )
    rows = tuples(retention(events, START, AS_OF).orderBy("cohort_week", "week_offset"))
    first, second = (dt.date.fromisoformat(w) for w in weeks(1, 2))
    assert rows == [
        (first, 0, 3, 3, Decimal("100.00"), AS_OF),
        (first, 1, 2, 3, Decimal("66.67"), AS_OF),
        (first, 16, 1, 3, Decimal("33.33"), AS_OF),
        (second, 0, 1, 1, Decimal("100.00"), AS_OF),
    ]


def test_invariants_between_the_metrics(spark):
    typed = orders_stream(spark, f"{TESTDATA}/sf0.001")
    events, users = fct_events(typed), dim_users(typed, ORDERS_AS_OF)
    n_users = typed.select("user_id").distinct().count()

    life = lifecycle_weekly(events, users, ORDERS_START_DS, ORDERS_AS_OF)
    by_week = reports.lifecycle_by_week(life).selectExpr("cutoff_week", "new + retained + resurrected AS active", "new")
    assert by_week.agg(F.sum("new")).first()[0] == n_users
    weekly = reports.active_by_segment(active_users(events, users, ORDERS_START_DS, ORDERS_AS_OF), "weekly")
    active = {r.period_start_date.isoformat(): r.active_user_count for r in weekly.collect()}
    assert {r.cutoff_week.split(" ")[1]: r.active for r in by_week.collect()} == active

    cohorts = retention(events, ORDERS_START_DS, ORDERS_AS_OF).where("week_offset = 0")
    assert cohorts.agg(F.sum("cohort_size")).first()[0] == n_users
    assert [r.retention_rate for r in cohorts.select("retention_rate").distinct().collect()] == [Decimal("100.00")]


def test_triangle_report(spark):
    events, _ = built(spark, *active_in("u_0001", *weeks(1, 3)), *active_in("u_0002", *weeks(1)))
    row = reports.retention_triangle(retention(events, START, AS_OF)).first()
    assert (row.cohort_size, row.w0, row.w1, row.w2) == (2, Decimal("100.00"), None, Decimal("50.00"))
    assert len(row) == 19
