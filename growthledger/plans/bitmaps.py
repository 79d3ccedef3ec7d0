"""Exact distinct users over any set of segments and periods, from bitmaps.

Counts of users can't be added up over segments or periods when a user is in several. Sets can: users get dense numbers,
and a set of users is a few rows of 4 KB, one per 32,768 numbers. Sets are made once per period and segment; after
that a distinct count over any of them is an OR of stored rows and no look at users or events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import month_start, week_start
from ..operators.activity import events_since

#: Parts in which users are numbered at the same time.
PARTS = 256


def user_numbers(users: DataFrame) -> DataFrame:
    """user_id, number: the distinct users, from 1 without gaps; the same for the same users.

    Each part numbers its own users and starts where the one before it ends; only the parts' sizes are looked at together.
    """
    distinct = users.where("user_id IS NOT NULL").select("user_id").distinct()
    parted = distinct.withColumn("part", F.pmod(F.xxhash64("user_id"), F.lit(PARTS)))
    sizes = parted.groupBy("part").agg(F.count("*").alias("users"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # at most PARTS rows
    offsets = sizes.select("part", F.coalesce(F.sum("users").over(before), F.lit(0)).alias("offset"))
    place = F.row_number().over(Window.partitionBy("part").orderBy("user_id"))
    return parted.withColumn("place", place).join(offsets, "part").select("user_id", (F.col("offset") + F.col("place")).alias("number"))


def activity_bitmaps(events: DataFrame, numbers: DataFrame, segment: list[str], start_ds: str) -> DataFrame:
    """period_type, period_start_date, segment columns, bucket, users: the active users as bitmaps.

    ``segment``: columns of the events. Events become one row per user, day and segment before users are looked up.
    Numbers are shuffled, not bitmaps: most hold few users, and 4 KB each would be many times the rows they come from. All
    segments of a period and bucket lie in one task, in the order in which ``distinct_users`` unites them.
    """
    day = F.to_date("event_time")
    active = events_since(events, start_ds).select("user_id", day.alias("day"), *segment).distinct()
    starts = {"daily": F.col("day"), "weekly": week_start(F.col("day")), "monthly": month_start(F.col("day"))}
    periods = F.inline(
        F.array(*[F.struct(F.lit(p).alias("period_type"), s.alias("period_start_date")) for p, s in starts.items()])
    )
    return (
        active.join(numbers, "user_id")
        .select(
            F.bitmap_bucket_number("number").alias("bucket"), F.bitmap_bit_position("number").alias("position"), *segment, periods
        )
        .repartition("bucket", "period_type", "period_start_date")
        .groupBy("bucket", "period_type", "period_start_date", *segment)
        .agg(F.bitmap_construct_agg("position").alias("users"))
        .select("period_type", "period_start_date", *segment, "bucket", "users")
    )


def distinct_users(bitmaps: DataFrame, by: list[str]) -> DataFrame:
    """``by``, n_users: distinct users over all rows of ``bitmaps`` that share ``by``; filter the rows before."""
    united = bitmaps.groupBy("bucket", *by).agg(F.bitmap_or_agg("users").alias("users"))
    return united.groupBy(*by).agg(F.sum(F.bitmap_count("users")).alias("n_users"))
