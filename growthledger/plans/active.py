"""Daily, weekly and monthly active users."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import ds_column, month_start, resolve_as_of, week_start
from ..operators.activity import active_days, with_segments
from ..sources.schemas import AGG_ACTIVE_USER


def active_users(
    events: DataFrame, users: DataFrame, start_ds: str, as_of: str | dt.date | None = None
) -> DataFrame:
    """Distinct active users per period, acquisition source and country.

    ``users`` is one snapshot of the user dimension.
    """
    return active_users_from_calendar(with_segments(active_days(events, start_ds), users), as_of)


def active_users_from_calendar(calendar: DataFrame, as_of: str | dt.date | None = None) -> DataFrame:
    """The same, from the daily calendar with segments."""
    return active_users_from_counts(period_counts(calendar), as_of)


def period_counts(calendar: DataFrame) -> DataFrame:
    """Users per period and segment, from the daily calendar with segments.

    Every user contributes each period once: a week or month is counted on the user's
    first active day in it, which is where it differs from the previous day's. Counting
    distinct users is then a plain count, all three granularities come out of one pass,
    and the final shuffle carries only partial counts per period and segment.
    """
    previous = F.concat(F.array(F.lit(None).cast("date")), F.col("days"))
    day_pairs = F.inline(F.arrays_zip(F.col("days").alias("day"), previous.alias("previous_day")))
    day, before = F.col("day"), F.col("previous_day")
    periods = F.array(
        _period("daily", day, F.lit(True)),
        _period("weekly", week_start(day), ~week_start(day).eqNullSafe(week_start(before))),
        _period("monthly", month_start(day), ~month_start(day).eqNullSafe(month_start(before))),
    )
    return (
        calendar.select("acq_source", "country", day_pairs)
        .where(day.isNotNull())  # the pair after the last day
        .select("acq_source", "country", F.inline(periods))
        .where(F.col("period_start_date").isNotNull())
        .groupBy("period_start_date", "period_type", "acq_source", "country")
        .agg(F.count("*").alias("active_user_count"))
    )


def active_users_from_counts(counts: DataFrame, as_of: str | dt.date | None = None) -> DataFrame:
    """The counts as the published table: with the build date, in order."""
    return (
        counts.withColumn("ds", ds_column(resolve_as_of(as_of)))
        .select(*AGG_ACTIVE_USER.names)
        .orderBy(*[F.asc_nulls_last(c) for c in ("period_start_date", "period_type", "acq_source", "country")])
    )


def _period(period_type: str, start: Column, counts: Column) -> Column:
    """One period of a day; without a start date when it was counted before."""
    return F.struct(F.lit(period_type).alias("period_type"), F.when(counts, start).alias("period_start_date"))
