"""Events stored by user: the metrics and the key check without a shuffle of event or user rows.

The typed events lie in a catalog table that is bucketed by ``user_id`` and sorted by user and time. One shuffle, when
they are stored, is the only one: calendars, the user dimension and their join all ask for rows gathered by user, and the
scan of a bucketed table already delivers that. A bucket is one task, so a user with more rows than an even share of a
bucket is kept out of it, as are events without a user: these rows go to a second table that is not bucketed, where the
map-side combining of the aggregates does the work. There are fewer such users than buckets, whatever the data.

Users are in one of the two tables only, so everything by user is built from each and put together by a union.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import resolve_as_of
from ..operators.activity import active_days, segments, with_weeks
from ..quality.checks import unique_within
from .active import active_users_from_calendar
from .facts import fct_events
from .lifecycle import lifecycle_from_calendar
from .retention import retention_from_calendar
from .users import dim_users

_APART = "_apart"


@dataclass(frozen=True)
class EventsByUser:
    """The stored parts; no user is in two of them."""

    parts: tuple[DataFrame, ...]

    def per_user(self, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """``build``, which has to treat users one by one, over all events."""
        return reduce(DataFrame.unionByName, [build(part) for part in self.parts])

    def users(self, as_of: str | dt.date | None = None) -> DataFrame:
        """One snapshot of the user dimension."""
        return self.per_user(lambda part: dim_users(part, as_of))

    def calendar(self, start_ds: str, as_of: str | dt.date | None = None) -> DataFrame:
        """user_id, days, acq_source, country: the active days of each user with the segment."""

        def build(part: DataFrame) -> DataFrame:
            return active_days(fct_events(part), start_ds).join(segments(dim_users(part, as_of)), "user_id")

        return self.per_user(build)

    def active_users(self, start_ds: str, as_of: str | dt.date | None = None) -> DataFrame:
        return active_users_from_calendar(self.calendar(start_ds, as_of), as_of)

    def lifecycle_weekly(self, start_ds: str, as_of: str | dt.date | None = None) -> DataFrame:
        return lifecycle_from_calendar(with_weeks(self.calendar(start_ds, as_of)), as_of)

    def retention(self, start_ds: str, as_of: str | dt.date | None = None) -> DataFrame:
        days = self.per_user(lambda part: active_days(fct_events(part), start_ds))
        return retention_from_calendar(with_weeks(days), as_of)

    def repeated_event_ids(self) -> DataFrame:
        """user_id, event_id, n_records: keys that occur more than once.

        The key is made of time, user and type. No valid type contains the ``-`` between them, so users share no key.
        """
        check = unique_within("user_id", "event_id")
        return self.per_user(lambda part: check.failing(fct_events(part)))


def store_by_user(stream: DataFrame, table: str, path: str, buckets: int) -> EventsByUser:
    """Store typed events as ``table`` under ``path``, in place of what is there.

    ``buckets`` should leave a bucket small enough for one task, say 100 to 200 MB. The rows are counted by user first, so
    ``stream`` is read twice.
    """
    spark = stream.sparkSession
    user = F.col("user_id")
    counts = stream.where(user.isNotNull()).groupBy("user_id").agg(F.count("*").alias("n"))
    even_share = F.ceil(counts.select(F.sum("n")).scalar() / buckets)
    large = [r.user_id for r in counts.where(F.col("n") > even_share).select("user_id").collect()]
    apart = user.isNull() | user.isin(large)

    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"DROP TABLE IF EXISTS {table}{_APART}")
    gathered = stream.where(~apart).repartition(buckets, "user_id")  # a bucket is one file
    _writer(gathered, f"{path}/events").bucketBy(buckets, "user_id").sortBy("user_id", "event_time").saveAsTable(table)
    _writer(stream.where(apart), f"{path}/events{_APART}").saveAsTable(f"{table}{_APART}")
    return read_by_user(spark, table)


def read_by_user(spark: SparkSession, table: str) -> EventsByUser:
    """Events that ``store_by_user`` stored in this catalog."""
    parts = spark.table(table), spark.table(f"{table}{_APART}")
    return EventsByUser(parts)


def store_users(events: EventsByUser, table: str, path: str, buckets: int, as_of: str | dt.date | None = None) -> DataFrame:
    """Store a snapshot of the user dimension, bucketed like the events; joins by user with them then move nothing."""
    users = events.users(resolve_as_of(as_of)).repartition(buckets, "user_id")
    users.sparkSession.sql(f"DROP TABLE IF EXISTS {table}")
    _writer(users, path).bucketBy(buckets, "user_id").sortBy("user_id").saveAsTable(table)
    return users.sparkSession.table(table)


def _writer(df: DataFrame, path: str):
    return df.write.format("parquet").mode("overwrite").option("path", path)
