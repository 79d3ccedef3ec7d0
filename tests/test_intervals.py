"""Validity intervals against the snapshots they come from, and user bitmaps against distinct counts."""

from helpers import TESTDATA, tuples

from growthledger.plans.bitmaps import activity_bitmaps, distinct_users, user_numbers
from growthledger.plans.intervals import snapshot_on, validity_intervals, with_attributes_on
from growthledger.sources.adapters import ORDERS_START_DS, orders_stream
from growthledger.plans.facts import fct_events
from pyspark.sql import functions as F

DAYS = ["2025-06-01", "2025-06-02", "2025-06-04", "2025-06-05"]
# Values of each user on these days; "-" where the user is missing.
USERS = {"a": ["x", "x", "x", "x"], "b": ["x", "y", "y", "x"], "c": [None, None, "x", None], "d": ["x", "-", "x", "x"], "e": ["-", "-", "z", "-"]}


def snapshots(spark):
    rows = [(u, v, d) for u, values in USERS.items() for d, v in zip(DAYS, values, strict=True) if v != "-"]
    return spark.createDataFrame([*rows, rows[0]], "user_id string, country string, ds string")


def test_intervals_by_hand(spark):
    found = validity_intervals(snapshots(spark), ["user_id"])
    assert found.columns == ["user_id", "country", "valid_from", "valid_to"]
    assert sorted(tuples(found), key=str) == sorted([
        ("a", "x", DAYS[0], None),
        ("b", "x", DAYS[0], DAYS[1]), ("b", "y", DAYS[1], DAYS[3]), ("b", "x", DAYS[3], None),
        ("c", None, DAYS[0], DAYS[2]), ("c", "x", DAYS[2], DAYS[3]), ("c", None, DAYS[3], None),
        ("d", "x", DAYS[0], DAYS[1]), ("d", "x", DAYS[2], None), ("e", "z", DAYS[2], DAYS[3]),
    ], key=str)
    assert validity_intervals(snapshots(spark).limit(0), ["user_id"]).count() == 0


def test_every_snapshot_can_be_read_back(spark):
    stored = snapshots(spark)
    intervals = validity_intervals(stored, ["user_id"]).cache()
    for day in DAYS:
        want = stored.where(F.col("ds") == day).distinct()
        assert sorted(tuples(snapshot_on(intervals, day)), key=str) == sorted(tuples(want), key=str)
    between = snapshot_on(intervals, "2025-06-03")
    assert sorted(r.user_id for r in between.collect()) == ["a", "b", "c"]


def test_attributes_on_a_day(spark):
    intervals = validity_intervals(snapshots(spark), ["user_id"])
    facts = spark.createDataFrame([("b", "2025-05-30"), ("b", "2025-06-03"), ("b", "2025-07-01"), ("d", "2025-06-02"), ("q", "2025-06-02"), (None, None)], "user_id string, day string")
    found = with_attributes_on(facts, intervals, "user_id", "day")
    assert sorted(tuples(found), key=str) == sorted([
        ("b", "2025-05-30", None), ("b", "2025-06-03", "y"), ("b", "2025-07-01", "x"),
        ("d", "2025-06-02", None), ("q", "2025-06-02", None), (None, None, None),
    ], key=str)


def test_numbers_are_dense_and_bitmaps_count_distinct_users(spark):
    events = fct_events(orders_stream(spark, f"{TESTDATA}/sf0.001")).cache()
    numbers = user_numbers(events).cache()
    n = events.select("user_id").distinct().count()
    assert sorted(r.number for r in numbers.collect()) == list(range(1, n + 1))
    bitmaps = activity_bitmaps(events, numbers, ["platform", "event_type"], ORDERS_START_DS).cache()
    for by in ([], ["platform"], ["period_start_date"], ["event_type", "platform"]):
        some = bitmaps.where("period_type = 'monthly' AND event_type != 'like'")
        active = events.where(f"ds >= '{ORDERS_START_DS}' AND event_type != 'like'")
        active = active.withColumn("period_start_date", F.trunc(F.to_date("event_time"), "month"))
        want = active.groupBy(*by).agg(F.countDistinct("user_id").alias("n_users"))
        assert sorted(tuples(distinct_users(some, by))) == sorted(tuples(want)), by


def test_bitmaps_over_more_than_one_bucket(spark):
    users = spark.range(70_000).select(F.col("id").cast("string").alias("user_id"))
    numbers = user_numbers(users.unionByName(users))
    sums = numbers.agg(F.count("*"), F.min("number"), F.max("number"), F.countDistinct("number")).first()
    assert tuple(sums) == (70_000, 1, 70_000, 70_000)
    events = users.select(
        "user_id", F.lit("2025-06-02").alias("ds"), F.to_timestamp_ntz(F.lit("2025-06-02 10:00:00")).alias("event_time")
    )
    bitmaps = activity_bitmaps(events, numbers, [], "2025-01-01")
    assert tuples(distinct_users(bitmaps.where("period_type = 'weekly'"), ["period_start_date"]))[0][1] == 70_000
