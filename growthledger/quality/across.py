"""Checks across tables, and of trends.

The metric tables are computed on separate ways from the same events, so numbers that must agree
between them show a table that is stale, partly loaded or changed by hand. Both sides of a comparison are small
counts; they are brought together by a union and one aggregate, in which null segments are equal.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .checks import GroupCheck


@dataclass(frozen=True)
class TablesCheck:
    """A check that looks at several tables; it selects the rows in which they disagree."""

    name: str
    select_failing: Callable[[Mapping[str, DataFrame]], DataFrame]

    def failing(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        return self.select_failing(tables)


def disagreeing(left: DataFrame, right: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, left_value, right_value: keys whose sums of ``value`` differ. A missing side counts as 0."""
    none = F.lit(0).cast("long")
    sides = left.select(*keys, F.col(value).alias("left_value"), none.alias("right_value")).unionByName(
        right.select(*keys, none.alias("left_value"), F.col(value).alias("right_value"))
    )
    sums = sides.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("left_value", "right_value")])
    return sums.where(~F.col("left_value").eqNullSafe(F.col("right_value")))


def _label_week() -> Column:
    """The date in a week label, ``WKnn YYYY-MM-DD``."""
    return F.to_date(F.substring("cutoff_week", -10, 10))


def _cohorts_are_new_users(tables: Mapping[str, DataFrame]) -> DataFrame:
    cohorts = tables["agg_user_retention"].where("week_offset = 0")
    new = tables["agg_user_lifecycle_weekly"].where("user_status = 'new'")
    return disagreeing(
        cohorts.select(F.col("cohort_week").alias("week"), F.col("cohort_size").alias("users")),
        new.select(_label_week().alias("week"), F.col("user_count").alias("users")),
        ["week"],
        "users",
    )


def _weekly_active_users_have_a_status(tables: Mapping[str, DataFrame]) -> DataFrame:
    weekly = tables["agg_active_user"].where("period_type = 'weekly'")
    active = tables["agg_user_lifecycle_weekly"].where("user_status IN ('new', 'retained', 'resurrected')")
    segment = ("acq_source", "country")
    return disagreeing(
        weekly.select(F.col("period_start_date").alias("week"), *segment, F.col("active_user_count").alias("users")),
        active.select(_label_week().alias("week"), *segment, F.col("user_count").alias("users")),
        ["week", *segment],
        "users",
    )


def _every_user_has_one_status(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Users of a status in a week: all that were new up to then have exactly one."""
    lifecycle = tables["agg_user_lifecycle_weekly"].withColumn("week", _label_week())
    weeks = lifecycle.groupBy("acq_source", "country", "week").agg(
        F.sum("user_count").alias("all_users"),
        F.sum(F.when(F.col("user_status") == "new", F.col("user_count")).otherwise(0)).alias("new_users"),
    )
    up_to = Window.partitionBy("acq_source", "country").orderBy("week").rowsBetween(Window.unboundedPreceding, 0)
    sums = weeks.select(
        "week", "acq_source", "country", F.col("all_users").alias("left_value"),
        F.sum("new_users").over(up_to).alias("right_value"),
    )
    return sums.where("left_value != right_value")


def across_checks() -> list[TablesCheck]:
    """What the metric tables of one build must agree on, when every user is in the user dimension.

    A cohort's size is the number of users that are new in its week; the weekly active users of a segment are its new,
    retained and resurrected ones; and everybody who was ever new has one status in each later week.
    """
    return [
        TablesCheck("cohorts_are_new_users", _cohorts_are_new_users),
        TablesCheck("weekly_active_users_have_a_status", _weekly_active_users_have_a_status),
        TablesCheck("every_user_has_one_status", _every_user_has_one_status),
    ]


# To make the median deviation comparable with a standard deviation of normal values.
_NORMAL = 1.4826


def trend_scores(
    df: DataFrame,
    series: list[str],
    day: str,
    value: str,
    days: int = 28,
    history: int = 7,
    least_spread: float = 1.0,
) -> DataFrame:
    """series, day, value and n_before, typical, spread, score: how far a value is from the ``days`` days before.

    ``typical`` is the median of these values, ``spread`` their median distance from it, ``score`` the distance of the
    value in spreads (scaled like standard deviations, at least ``least_spread``). One earlier jump moves neither. Without
    ``history`` values before it a value has no score. A frame holds the rows of one series
    in ``days`` days, one each, so it is bounded; null values and dates take no part.
    """
    known = df.where(F.col(value).isNotNull() & F.col(day).isNotNull())
    number = F.unix_date(day)
    before = Window.partitionBy(*series).orderBy(number).rangeBetween(-days, -1)
    values = F.sort_array(F.collect_list(F.col(value).cast("double")).over(before))
    framed = known.select(*series, day, value, values.alias("_before"))
    typical = framed.withColumn("typical", _median("_before"))
    distances = F.sort_array(F.transform("_before", lambda v: F.abs(v - F.col("typical"))))
    spread = typical.withColumn("_distances", distances).withColumn("spread", _median("_distances"))
    score = F.abs(F.col(value) - F.col("typical")) / F.greatest(F.col("spread") * _NORMAL, F.lit(float(least_spread)))
    enough = F.size("_before") >= history
    return spread.select(
        *series, day, value, F.size("_before").alias("n_before"), "typical", "spread",
        F.when(enough, score).alias("score"),
    )


def _median(column: str) -> Column:
    """The median of a sorted array; null for an empty one."""
    n = F.size(column)
    lower, upper = F.get(column, F.floor((n - 1) / 2).cast("int")), F.get(column, F.floor(n / 2).cast("int"))
    return F.when(n > 0, (lower + upper) / 2)


def trend_check(series: list[str], day: str, value: str, limit: float = 5.0, **frame) -> GroupCheck:
    """Values further than ``limit`` from their own recent past; ``frame`` as in ``trend_scores``."""
    return GroupCheck(
        f"trend_{value}", lambda df: trend_scores(df, series, day, value, **frame).where(F.col("score") > limit)
    )
