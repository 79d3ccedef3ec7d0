"""Per-user activity calendars: the one shuffle of event rows that the metrics need.

Each calendar has one row per user with the sorted distinct days (or weeks) on which the
user was active. The set is built by a partial aggregate on the map side, so a user who
owns a large share of all events sends at most one small set per map task, and it can
never hold more entries than there are calendar days in the table. The result is
hash-partitioned by ``user_id``, which the later join with the users reuses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import week_start


def events_since(events: DataFrame, start_ds: str) -> DataFrame:
    """Events from ``start_ds`` on; prunes partitions when ``ds`` is a directory."""
    return events.where((F.col("ds") >= start_ds) & F.col("user_id").isNotNull())


def active_days(events: DataFrame, start_ds: str) -> DataFrame:
    """user_id, days: sorted distinct active dates of each user."""
    day = F.to_date("event_time")
    return events_since(events, start_ds).groupBy("user_id").agg(F.sort_array(F.collect_set(day)).alias("days"))


def active_weeks(events: DataFrame, start_ds: str) -> DataFrame:
    """user_id, weeks: sorted distinct week labels of each user."""
    week = week_start(F.col("event_time"))
    return events_since(events, start_ds).groupBy("user_id").agg(F.sort_array(F.collect_set(week)).alias("weeks"))


def with_weeks(calendar: DataFrame) -> DataFrame:
    """A daily calendar turned into a weekly one, row by row."""
    weeks = F.array_distinct(F.transform("days", week_start))
    return calendar.withColumn("weeks", weeks).drop("days")


def segments(users: DataFrame) -> DataFrame:
    """user_id, acq_source, country: what the metrics need of one users snapshot."""
    return users.select("user_id", "acq_source", F.col("user_country").alias("country"))


def with_segments(calendar: DataFrame, users: DataFrame) -> DataFrame:
    """Calendars of the users in the snapshot, with their segment.

    No broadcast is asked for: the users grow with the data. Adaptive execution still
    uses one where the measured size is below the session's threshold.
    """
    return calendar.join(segments(users), "user_id")
