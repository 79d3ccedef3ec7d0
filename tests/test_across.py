"""Checks across the metric tables, and of trends."""

import datetime as dt

import pytest
from helpers import active_in, stream

from growthledger.plans.active import active_users
from growthledger.plans.facts import fct_events
from growthledger.plans.lifecycle import lifecycle_weekly
from growthledger.plans.pipeline import Warehouse, check_metrics
from growthledger.plans.retention import retention
from growthledger.plans.users import dim_users
from growthledger.quality.across import across_checks, trend_check, trend_scores
from growthledger.quality.gate import DataQualityError, gate
from growthledger.sources.tables import replace_snapshot
from pyspark.sql import functions as F

AS_OF, START = "2025-08-01", "2025-01-01"
WEEKS = ["2025-06-01", "2025-06-08", "2025-06-15", "2025-07-20"]


@pytest.fixture(scope="module")
def tables(spark):
    events = stream(
        spark,
        *active_in("u_0001", *WEEKS), *active_in("u_0002", WEEKS[0], WEEKS[3]), *active_in("u_0003", WEEKS[1], country=None),
    )
    facts, users = fct_events(events), dim_users(events, AS_OF)
    return {
        "agg_active_user": active_users(facts, users, START, AS_OF),
        "agg_user_lifecycle_weekly": lifecycle_weekly(facts, users, START, AS_OF),
        "agg_user_retention": retention(facts, START, AS_OF),
    }


def failing(tables):
    return {c.name: [tuple(r) for r in c.failing(tables).collect()] for c in across_checks() if c.failing(tables).count()}


def test_whole_tables_agree(tables):
    assert failing(tables) == {}


def test_tampered_tables_do_not(tables):
    less = {**tables, "agg_user_retention": tables["agg_user_retention"].where("cohort_week != '2025-06-08'")}
    assert failing(less) == {"cohorts_are_new_users": [(dt.date(2025, 6, 8), 0, 1)]}
    count = F.when(F.col("country").isNull(), 7).otherwise(F.col("active_user_count"))
    more = {**tables, "agg_active_user": tables["agg_active_user"].withColumn("active_user_count", count)}
    assert failing(more) == {"weekly_active_users_have_a_status": [(dt.date(2025, 6, 8), "google", None, 7, 1)]}
    lost = tables["agg_user_lifecycle_weekly"].where("user_status != 'dormant' OR cutoff_week NOT LIKE '%2025-06-15'")
    found = failing({**tables, "agg_user_lifecycle_weekly": lost})
    assert {k: sorted(v, key=str) for k, v in found.items()} == {
        "every_user_has_one_status": [
            (dt.date(2025, 6, 15), "google", "SG", 1, 2),
        ]
    }


def test_the_gate_fires_and_stores_the_rows(spark, tables, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    for name, table in tables.items():
        replace_snapshot(table, wh.path(name), AS_OF)
    check_metrics(wh)
    replace_snapshot(tables["agg_active_user"].limit(0), wh.path("agg_active_user"), AS_OF)
    with pytest.raises(DataQualityError, match="weekly_active_users_have_a_status: 5"):
        check_metrics(wh)
    assert spark.read.parquet(f"{wh.audit_path}/metrics/weekly_active_users_have_a_status").count() == 5
    replace_snapshot(tables["agg_active_user"], wh.path("agg_active_user"), AS_OF)
    check_metrics(wh)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(f"{wh.audit_path}/metrics/weekly_active_users_have_a_status").count()


def daily(spark, series):
    rows = [(name, dt.date(2025, 1, 1) + dt.timedelta(days=k), v) for name, values in series.items() for k, v in enumerate(values)]
    return spark.createDataFrame(rows, "series string, day date, users long")


def test_planted_jumps_are_found_and_clean_series_pass(spark, tmp_path):
    calm = [100 + (k * 7) % 11 for k in range(60)]
    jump = [*calm[:40], 400, *calm[41:]]
    drop = [*calm[:50], 3, *calm[51:]]
    growing = [100 + 3 * k for k in range(60)]
    check = trend_check(["series"], "day", "users")
    df = daily(spark, {"calm": calm, "growing": growing, "flat": [5] * 60, "jump": jump, "drop": drop, "short": [1, 1, 900], "gone": [None] * 9})
    found = sorted((r.series, r.day.isoformat(), r.users) for r in check.failing(df).collect())
    assert found == [("drop", "2025-02-20", 3), ("jump", "2025-02-10", 400)]
    gate("calm", df.where("series IN ('calm', 'growing', 'flat')"), [check])
    with pytest.raises(DataQualityError, match="trend_users: 2"):
        gate("metrics", df, [check], str(tmp_path))


def test_scores_by_hand(spark):
    df = daily(spark, {None: [1, 2, 4, 10, 0]})  # a null series is a series
    rows = trend_scores(df, ["series"], "day", "users", days=3, history=2).orderBy("day").collect()
    assert [(r.n_before, r.typical, r.spread) for r in rows] == [
        (0, None, None), (1, 1.0, 0.0), (2, 1.5, 0.5), (3, 2.0, 1.0), (3, 4.0, 2.0),
    ]
    assert [r.score for r in rows] == [None, None, 2.5, 8 / 1.4826, 4 / (2 * 1.4826)]
    assert trend_scores(df.limit(0), ["series"], "day", "users").count() == 0
