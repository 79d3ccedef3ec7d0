"""Reads behind the three reports. Each looks at one snapshot of its table.

Give ``Warehouse.latest(table)``, or the table and its ``ds``: both read one partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.schemas import MAX_WEEK_OFFSET, USER_STATUSES
from ..sources.tables import latest_snapshot


def snapshot(df: DataFrame, ds: str | None) -> DataFrame:
    """The rows of one build date, the latest when none is named."""
    return latest_snapshot(df) if ds is None else df.where(F.col("ds") == ds)


def active_by_segment(
    active: DataFrame,
    period_type: str,
    acq_source: str | list[str] | None = None,
    country: str | list[str] | None = None,
    ds: str | None = None,
) -> DataFrame:
    """Active users per period over the chosen segments (all when not given).

    Segments can be added up because a user belongs to one of them; snapshots can't.
    """
    chosen = snapshot(active, ds).where(F.col("period_type") == period_type)
    for column, wanted in (("acq_source", acq_source), ("country", country)):
        if wanted is not None:
            chosen = chosen.where(F.col(column).isin(wanted))
    return (
        chosen.groupBy("period_start_date")
        .agg(F.sum("active_user_count").alias("active_user_count"))
        .orderBy("period_start_date")
    )


def lifecycle_by_week(lifecycle: DataFrame, ds: str | None = None) -> DataFrame:
    """One row per week with the users in each status as columns."""
    counts: list[Column] = [
        F.coalesce(F.sum(F.when(F.col("user_status") == s, F.col("user_count"))), F.lit(0)).alias(s)
        for s in USER_STATUSES
    ]
    return snapshot(lifecycle, ds).groupBy("cutoff_week").agg(*counts).orderBy("cutoff_week")


def retention_triangle(retention: DataFrame, ds: str | None = None) -> DataFrame:
    """One row per cohort with its size and the rate of week 0 to 16 as columns w0 .. w16."""
    offsets = list(range(MAX_WEEK_OFFSET + 1))
    return (
        snapshot(retention, ds).groupBy("cohort_week", "cohort_size")
        .pivot("week_offset", offsets)
        .agg(F.max("retention_rate"))
        .select("cohort_week", "cohort_size", *[F.col(str(n)).alias(f"w{n}") for n in offsets])
        .orderBy("cohort_week")
    )
