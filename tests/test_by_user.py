"""Events stored by user: no shuffle of rows in the plans, the same results, and users with very many rows."""

import datetime as dt

import pytest
from helpers import TESTDATA, stream
from pyspark.sql import functions as F

from growthledger.operators.activity import active_days, segments
from growthledger.plans.active import active_users
from growthledger.plans.by_user import EventsByUser, read_by_user, store_by_user, store_users
from growthledger.plans.facts import fct_events
from growthledger.plans.lifecycle import lifecycle_weekly
from growthledger.plans.retention import retention
from growthledger.plans.users import dim_users
from growthledger.sources.adapters import ORDERS_AS_OF, ORDERS_START_DS, orders_stream

ARGS = (ORDERS_START_DS, ORDERS_AS_OF)


@pytest.fixture(scope="module")
def orders(spark, tmp_path_factory):
    typed = orders_stream(spark, f"{TESTDATA}/sf0.001")
    return typed, store_by_user(typed, "by_user_orders", str(tmp_path_factory.mktemp("orders")), 8)


@pytest.fixture
def no_broadcast(spark):
    """Plan as if no table were small."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange" in line]


def same(ours, theirs):
    return ours.columns == theirs.columns and ours.exceptAll(theirs).isEmpty() and theirs.exceptAll(ours).isEmpty()


def test_no_exchange_of_event_or_user_rows(orders, no_broadcast):
    bucketed = EventsByUser(orders[1].parts[:1])
    assert not exchanges(bucketed.users(ORDERS_AS_OF))
    assert not exchanges(bucketed.calendar(*ARGS))
    assert not exchanges(bucketed.repeated_event_ids())
    for metric in (bucketed.active_users(*ARGS), bucketed.lifecycle_weekly(*ARGS), bucketed.retention(*ARGS)):
        found = exchanges(metric)
        assert found and not [line for line in found if "user_id" in line]


def test_rows_apart_are_combined_before_they_move(orders, no_broadcast):
    plan = active_days(fct_events(orders[1].parts[1]), ORDERS_START_DS)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange hashpartitioning(user_id") < plan.index("partial_collect_set")


def test_stored_users_join_without_an_exchange(spark, orders, tmp_path, no_broadcast):
    bucketed = EventsByUser(orders[1].parts[:1])
    users = store_users(bucketed, "by_user_dim", str(tmp_path / "users"), 8, ORDERS_AS_OF)
    assert not exchanges(active_days(fct_events(bucketed.parts[0]), ORDERS_START_DS).join(segments(users), "user_id"))
    assert same(users, bucketed.users(ORDERS_AS_OF))


def test_same_results(orders):
    typed, stored = orders
    events, users = fct_events(typed), dim_users(typed, ORDERS_AS_OF)
    assert same(stored.users(ORDERS_AS_OF), users)
    assert same(stored.active_users(*ARGS), active_users(events, users, *ARGS))
    assert same(stored.lifecycle_weekly(*ARGS), lifecycle_weekly(events, users, *ARGS))
    assert same(stored.retention(*ARGS), retention(events, *ARGS))


def hot_rows(spark):
    day = dt.datetime(2025, 6, 2, 9)
    rows = stream(spark, *[{"user_id": f"u_{k:04d}", "event_time": day + dt.timedelta(days=k % 30)} for k in range(60)])
    hot = stream(spark, {"user_id": "u_0007"}, {"user_id": "u_0008"}).crossJoin(spark.range(400)).drop("id")
    nobody = stream(spark, {"user_id": None}).crossJoin(spark.range(50)).drop("id")
    return rows.unionByName(hot).unionByName(nobody)


def test_large_users_and_rows_of_nobody_are_kept_apart(spark, tmp_path):
    rows = hot_rows(spark)
    stored = store_by_user(rows, "by_user_hot", str(tmp_path / "t"), 4)
    apart = stored.parts[1].groupBy("user_id").count().collect()
    assert {(r.user_id, r["count"]) for r in apart} == {("u_0007", 401), ("u_0008", 401), (None, 50)}
    assert stored.parts[0].count() == 58
    args = ("2025-01-01", "2025-12-31")
    assert same(stored.active_users(*args), active_users(fct_events(rows), dim_users(rows, args[1]), *args))
    assert same(stored.users(args[1]), dim_users(rows, args[1]))
    repeated = stored.repeated_event_ids()
    assert sorted(map(str, repeated.select(F.col("user_id"), "n_records").collect())) == sorted(
        map(str, fct_events(rows).groupBy("user_id", "event_id").agg(F.count("*").alias("n_records"))
            .where("n_records > 1").select("user_id", "n_records").collect())
    )


def test_a_bucket_is_one_file_and_is_replaced_whole(spark, tmp_path):
    path = tmp_path / "t"
    store_by_user(hot_rows(spark), "by_user_twice", str(path), 4)
    store_by_user(stream(spark, {}), "by_user_twice", str(path), 4)
    stored = read_by_user(spark, "by_user_twice")
    assert [part.count() for part in stored.parts] == [1, 0]
    assert len(list((path / "events").glob("*.parquet"))) == 1


def test_no_events(spark, tmp_path):
    stored = store_by_user(stream(spark, {}).limit(0), "by_user_none", str(tmp_path / "t"), 4)
    assert stored.users("2025-12-31").isEmpty()
    assert stored.active_users("2025-01-01", "2025-12-31").isEmpty()
    assert stored.repeated_event_ids().isEmpty()
