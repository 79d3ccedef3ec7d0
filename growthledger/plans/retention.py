"""Weekly cohort retention."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import ds_column, resolve_as_of, weeks_between
from ..operators.activity import active_weeks
from ..sources.schemas import AGG_USER_RETENTION, MAX_WEEK_OFFSET, RATE


def retention(events: DataFrame, start_ds: str, as_of: str | dt.date | None = None) -> DataFrame:
    """Share of each weekly cohort that is active 0 to 16 weeks after its first week."""
    return retention_from_calendar(active_weeks(events, start_ds), as_of)


def retention_from_calendar(calendar: DataFrame, as_of: str | dt.date | None = None) -> DataFrame:
    """The same, from the weekly calendar of one row per user."""
    return retention_from_counts(cohort_counts(calendar), as_of)


def cohort_counts(calendar: DataFrame) -> DataFrame:
    """cohort_week, week_offset, retained_users, from the weekly calendar of one row per user.

    Cohort and offsets are read off the user's own row, so neither a self-join nor a
    distinct count is needed.
    """
    first = F.col("weeks")[0]
    return (
        calendar.select(first.alias("cohort_week"), F.explode("weeks").alias("week"))
        .select("cohort_week", weeks_between(F.col("week"), F.col("cohort_week")).alias("week_offset"))
        .where(F.col("week_offset").between(0, MAX_WEEK_OFFSET))
        .groupBy("cohort_week", "week_offset")
        .agg(F.count("*").alias("retained_users"))
    )


def retention_from_counts(counts: DataFrame, as_of: str | dt.date | None = None) -> DataFrame:
    """Rates from the counts. The cohort size is its count at offset 0, taken by a window over them."""
    size = F.max(F.when(F.col("week_offset") == 0, F.col("retained_users"))).over(Window.partitionBy("cohort_week"))
    rate = F.round(F.col("retained_users") * F.lit(100).cast("decimal(4,1)") / F.nullif("cohort_size", F.lit(0)), 2)
    return (
        counts.withColumn("cohort_size", size)
        .withColumn("retention_rate", rate.cast(RATE))
        .withColumn("ds", ds_column(resolve_as_of(as_of)))
        .select(*AGG_USER_RETENTION.names)
    )
