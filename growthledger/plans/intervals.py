"""Snapshots of users as validity intervals.

A daily snapshot repeats every user, though few change from one day to the next. An interval row holds the attributes
once, with the first build date they were seen on (``valid_from``) and the first one after it on which they no longer were
(``valid_to``, null while they hold). Any build date's snapshot can be read back from the intervals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def validity_intervals(snapshots: DataFrame, keys: list[str], ds: str = "ds") -> DataFrame:
    """keys, the other columns, valid_from, valid_to, from one row per ``keys`` and build date.

    An interval ends where a column changes, also from or to null, and where the key is missing in a snapshot. Repeated
    rows count once. One shuffle by the keys; a key has at most one row per build date, so no
    partition of the window outgrows the number of days.
    """
    attributes = [c for c in snapshots.columns if c not in (*keys, ds)]
    rows = snapshots.select(*keys, F.struct(F.lit(True), *attributes).alias("_state"), F.col(ds).alias("_ds"))
    dates = snapshots.select(F.col(ds).alias("_ds")).distinct()
    in_order = Window.orderBy("_ds")  # one row per build date
    dates = dates.select("_ds", F.lag("_ds").over(in_order).alias("_previous"), F.lead("_ds").over(in_order).alias("_next"))
    of_key = Window.partitionBy(*keys).orderBy("_ds")
    same = F.lag("_state").over(of_key).eqNullSafe(F.col("_state")) & F.lag("_ds").over(of_key).eqNullSafe(F.col("_previous"))
    starts = (
        rows.join(dates, "_ds").distinct().withColumn("_starts", F.when(same, 0).otherwise(1))
        .withColumn("_number", F.sum("_starts").over(of_key.rowsBetween(Window.unboundedPreceding, 0)))
    )
    return (
        starts.groupBy(*keys, "_number")
        .agg(F.min_by("_state", "_ds").alias("_state"), F.min("_ds").alias("valid_from"), F.max_by("_next", "_ds").alias("valid_to"))
        .select(*keys, *[F.col("_state")[c].alias(c) for c in attributes], "valid_from", "valid_to")
    )


def _holds_on(day: Column) -> Column:
    return (F.col("valid_from") <= day) & (F.col("valid_to").isNull() | (F.col("valid_to") > day))


def snapshot_on(intervals: DataFrame, day: str) -> DataFrame:
    """The snapshot of a build date; between two build dates, that of the earlier one."""
    rows = intervals.where(_holds_on(F.lit(day))).drop("valid_from", "valid_to")
    return rows.withColumn("ds", F.lit(day))


def with_attributes_on(facts: DataFrame, intervals: DataFrame, key: str, day: str) -> DataFrame:
    """Every fact row with the attributes that held for its ``key`` on its ``day``; nulls where none did.

    Columns of the intervals must not be called like those of the facts, the key aside. A hash join by the key, which
    adaptive execution splits for a key that owns a large share of the facts: a key's intervals are few.
    """
    on = intervals.withColumnRenamed(key, "_key")
    joined = facts.join(on, (facts[key] == on["_key"]) & _holds_on(facts[day]), "left")
    return joined.drop("_key", "valid_from", "valid_to")
