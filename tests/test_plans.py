"""Plan shapes that the scale behaviour depends on, and skewed input."""

import datetime as dt
import re

import pytest
from helpers import TESTDATA
from pyspark.sql import functions as F

from growthledger.operators.activity import active_days
from growthledger.plans.active import active_users
from growthledger.plans.facts import fct_events
from growthledger.plans.lifecycle import lifecycle_weekly, user_week_history
from growthledger.plans.retention import retention
from growthledger.plans.users import dim_users
from growthledger.sources.adapters import ORDERS_AS_OF, ORDERS_START_DS, orders_stream
from growthledger.sources.schemas import FCT_EVENT_STREAM
from growthledger.sources.tables import cluster_by_ds

ARGS = (ORDERS_START_DS, ORDERS_AS_OF)


@pytest.fixture
def tables(spark):
    typed = orders_stream(spark, f"{TESTDATA}/sf0.001")
    return fct_events(typed), dim_users(typed, ORDERS_AS_OF)


@pytest.fixture
def no_broadcast(spark):
    """Plan as if no table were small."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_retention_shuffles_events_once_and_joins_nothing(tables):
    plan = physical(retention(tables[0], *ARGS))
    assert plan.count("FileScan") == 1 and "Join" not in plan
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan
    assert plan.count("Exchange hashpartitioning(user_id") == 1


def test_calendar_is_combined_before_the_shuffle(tables):
    plan = physical(active_days(tables[0], ORDERS_START_DS))
    assert plan.index("collect_set") < plan.index("Exchange hashpartitioning(user_id") < plan.index("partial_collect_set")


def test_active_users_reads_events_once_and_reuses_the_calendar_partitioning(tables, no_broadcast):
    plan = physical(active_users(*tables, *ARGS))
    # One scan for the events, one for the users derived from the same stream.
    assert plan.count("FileScan") == 2
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    calendar_shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning(user_id" in line]
    # calendar, users' aggregate, users for the join; none for the counting of distinct users
    assert len(calendar_shuffles) == 3


@pytest.mark.parametrize("attempt", [1, 2, 3])
def test_lifecycle_has_no_grid_and_runs_the_user_level_once(tables, attempt):
    result = lifecycle_weekly(*tables, *ARGS)
    result.collect()
    plan = physical(result)
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    # The list of weeks is read off the shuffled step counts, not computed from events again.
    assert re.search(r"ReusedExchange \[[^\]]*from_week", plan)
    # The number of a week is looked up, not searched for.
    assert "array_position" not in plan


def test_week_history_looks_numbers_up(tables):
    assert "array_position" not in physical(user_week_history(*tables, ORDERS_START_DS))


def test_users_take_one_scan_and_combine_first(tables):
    plan = physical(tables[1])
    assert plan.count("FileScan") == 1 and "Join" not in plan
    assert "partial_max" in plan


def test_pruned_users_do_not_compute_the_latest_event(tables):
    plan = physical(tables[1].select("user_id", "acq_source"))
    assert "Window" not in plan and "o_totalprice" not in plan


def test_facts_are_narrow(tables):
    assert "Exchange" not in physical(tables[0])


def test_one_user_owning_most_rows(spark):
    """A third and more of all events from one user on one day; every result stays whole."""
    n = 60_000
    hot = F.col("id") % 3 != 0
    when = F.timestamp_micros(F.lit(1748736000000000) + F.when(hot, F.col("id")).otherwise(F.col("id") * 86_400_000_0))
    rows = spark.range(0, n, 1, 8).select(
        when.cast("timestamp_ntz").alias("event_time"),
        F.when(hot, "u_0001").otherwise(F.concat(F.lit("u_"), F.lpad((F.col("id") % 500).cast("string"), 4, "0")))
        .alias("user_id"),
        F.lit("miles_earned").alias("event_type"),
        F.lit("dining").alias("transaction_category"),
        F.lit(1).cast("decimal(10,2)").alias("miles_amount"),
        F.lit("ios").alias("platform"),
        F.lit("google").alias("utm_source"),
        F.lit("SG").alias("country"),
    ).select(*FCT_EVENT_STREAM.names)
    events, users = fct_events(rows), dim_users(rows, dt.date(2027, 1, 1))
    assert users.agg(F.sum("total_miles_earned")).first()[0] == n
    days = events.select("user_id", "ds").distinct()
    daily = active_users(events, users, "2025-01-01", "2027-01-01").where("period_type = 'daily'")
    assert daily.agg(F.sum("active_user_count")).first()[0] == days.count()


def test_hot_day_is_split_on_write(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100k")
    try:
        rows = spark.range(0, 200_000, 1, 8).select(
            F.col("id"), F.expr("uuid()").alias("text"),
            F.when(F.col("id") % 3 == 0, F.concat(F.lit("2025-01-"), F.lpad((F.col("id") % 9 + 1).cast("string"), 2, "0")))
            .otherwise("2025-02-01").alias("ds"),
        )
        cluster_by_ds(rows).write.partitionBy("ds").parquet(f"{tmp_path}/t")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = list((tmp_path / "t" / "ds=2025-02-01").glob("*.parquet"))
    assert len(files) > 4
    assert spark.read.parquet(f"{tmp_path}/t").count() == 200_000
