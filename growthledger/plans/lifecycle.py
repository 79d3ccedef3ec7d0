"""Weekly user lifecycle: new, retained, resurrected, dormant, churned.

Two forms with the same result, and neither builds a grid of users x weeks.
``lifecycle_weekly`` is the one to use: it reduces the users to counts before it looks at
any status. ``lifecycle_weekly_from_history`` classifies the history of every user row by
row; it is the readable statement of the rules and the check of the first.

"Weeks" below are the weeks in which anybody was active, numbered 1, 2, 3, ...
A user is

* new          in the first active week,
* retained     when active, and last active at most 4 numbers earlier,
* resurrected  when active, and last active longer ago,
* dormant      when inactive, and last active at most 4 numbers earlier,
* churned      when inactive, and last active longer ago.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import cutoff_label, ds_column, resolve_as_of
from ..operators.activity import active_weeks, with_segments
from ..sources.schemas import AGG_USER_LIFECYCLE_WEEKLY

LOOKBACK_WEEKS = 4

# Ends of a user's calendar: before the first and after the last active week. They are
# real dates, not nulls, so that they survive joins and order correctly.
BEFORE_FIRST = "0001-01-01"
AFTER_LAST = "9999-12-31"


def lifecycle_weekly(
    events: DataFrame, users: DataFrame, start_ds: str, as_of: str | dt.date | None = None
) -> DataFrame:
    """Users per week label, acquisition source, country and lifecycle status.

    ``users`` is one snapshot of the user dimension with one row per user.
    """
    return lifecycle_from_calendar(_weekly_calendar(events, users, start_ds), as_of)


def _weekly_calendar(events: DataFrame, users: DataFrame, start_ds: str) -> DataFrame:
    """Weekly calendars with segments, planned the same way wherever they are read.

    The calendars are read by the list of weeks and by the counts, which run as separate
    adaptive queries. Left alone, the two may turn this join into different broadcasts
    when the users happen to be few, and then nothing after it could be shared. Both sides
    hold one row per user and the calendars are partitioned already, so a merge join is
    what large data gets anyway.
    """
    return with_segments(active_weeks(events, start_ds), users.hint("merge"))


def lifecycle_from_calendar(calendar: DataFrame, as_of: str | dt.date | None = None) -> DataFrame:
    """The same, from the weekly calendar with segments.

    Users are reduced to step counts per segment first; from there on the data is bounded
    by segments x weeks^2, however many users there are.
    """
    return lifecycle_from_steps(activity_steps(calendar), as_of)


def lifecycle_from_steps(steps: DataFrame, as_of: str | dt.date | None = None) -> DataFrame:
    """The same, from the counts of ``activity_steps``."""
    all_weeks = week_list(steps)
    counts = running_counts(status_changes(steps, all_weeks))
    return _labelled(counts.withColumn("week", _week(all_weeks, F.col("number"))), as_of)


def activity_steps(calendar: DataFrame) -> DataFrame:
    """Number of users per segment going from one active week straight to the next.

    Every user has one step from BEFORE_FIRST and one to AFTER_LAST.
    """
    starts = F.concat(F.array(_date(BEFORE_FIRST)), F.col("weeks"))
    ends = F.concat(F.col("weeks"), F.array(_date(AFTER_LAST)))
    step = F.inline(F.arrays_zip(starts.alias("from_week"), ends.alias("to_week")))
    return (
        calendar.select("acq_source", "country", step)
        .groupBy("acq_source", "country", "from_week", "to_week")
        .agg(F.count("*").alias("users"))
    )


def week_list(steps: DataFrame) -> Column:
    """weeks: all weeks with activity in order, then AFTER_LAST; ranks: numbers by calendar week.

    ``ranks`` has an entry for every calendar week from the first active one on, so that the number of
    a week is found by its distance from the first. Quiet weeks hold the number before
    them and are never asked for.

    A scalar subquery with one entry per calendar week: the DATE type has no more than
    521,723 of them (about 4 MB), however much data there is. Looking at the users keeps
    the steps equal to the ones that are counted, so that they are computed only once.
    """
    active = F.when(F.col("users") > 0, F.col("to_week"))
    weeks = steps.agg(F.sort_array(F.collect_set(active)).alias("weeks"))
    known = F.slice("weeks", 1, F.greatest(F.size("weeks") - 1, F.lit(0)))
    numbered = F.transform(
        "known",
        lambda w, k: F.array_repeat(
            k + 1, F.coalesce((F.datediff(F.get("known", k + 1), w) / 7).cast("int"), F.lit(1))
        ),
    )
    ranks = weeks.withColumn("known", known).select(F.struct("weeks", F.flatten(numbered).alias("ranks")))
    return ranks.scalar()


def status_changes(steps: DataFrame, all_weeks: Column) -> DataFrame:
    """segment, user_status, number, change: users entering (+) or leaving (-) a status.

    A step from number i to number q gives these stays [lo, hi): the status of the arrival
    at q, dormant on the up to 4 weeks after i, and churned from then until q. Numbers are
    positions in the list of weeks; that of BEFORE_FIRST is 0.
    """
    i, q = F.col("i"), F.col("q")
    first, last = i == 0, F.col("to_week") == _date(AFTER_LAST)
    arrival = F.when(first, "new").when(q - i <= LOOKBACK_WEEKS, "retained").otherwise("resurrected")
    lapse = i + LOOKBACK_WEEKS + 1
    changes = F.array(
        *_stay(arrival, q, q + 1, ~last),
        *_stay(F.lit("dormant"), i + 1, F.least(lapse, q), ~first & (i + 1 < q)),
        *_stay(F.lit("churned"), lapse, q, ~first & (lapse < q)),
    )
    return (
        steps.withColumns({"i": _position(all_weeks, "from_week"), "q": _position(all_weeks, "to_week")})
        .select("acq_source", "country", F.inline(changes))
        .where(F.col("change") != 0)
        .groupBy("acq_source", "country", "user_status", "number")
        .agg(F.sum("change").alias("change"))
    )


def _stay(status: Column, lo: Column, hi: Column, applies: Column) -> list[Column]:
    """The users of a step enter ``status`` at ``lo`` and leave it at ``hi``."""
    users = F.when(applies, F.col("users")).otherwise(F.lit(0).cast("long"))
    return [
        F.struct(status.alias("user_status"), number.alias("number"), change.alias("change"))
        for number, change in ((lo, users), (hi, -users))
    ]


def _position(all_weeks: Column, week: str) -> Column:
    """Number of a week, from 1; 0 for BEFORE_FIRST. Constant time."""
    weeks, day = all_weeks.getField("weeks"), F.col(week)
    apart = (F.datediff(day, F.get(weeks, F.lit(0))) / 7).cast("int")
    return (
        F.when(day == _date(BEFORE_FIRST), 0)
        .when(day == _date(AFTER_LAST), F.size(weeks))
        .otherwise(F.get(all_weeks.getField("ranks"), apart))
    )


def _week(all_weeks: Column, number: Column) -> Column:
    return F.element_at(all_weeks.getField("weeks"), number)


def _date(text: str) -> Column:
    return F.lit(text).cast("date")


def running_counts(changes: DataFrame) -> DataFrame:
    """segment, user_status, number, user_count for every week where the count is not 0.

    A count holds until the next change, so each change row is repeated over that gap.
    """
    timeline = Window.partitionBy("acq_source", "country", "user_status").orderBy("number")
    return (
        changes.withColumns(
            {
                "user_count": F.sum("change").over(timeline.rowsBetween(Window.unboundedPreceding, 0)),
                "until": F.lead("number").over(timeline),
            }
        )
        .where(F.col("user_count") > 0)
        .select(
            "acq_source", "country", "user_status", "user_count",
            F.explode(F.sequence("number", F.col("until") - 1)).alias("number"),
        )
    )


def user_week_history(events: DataFrame, users: DataFrame, start_ds: str) -> DataFrame:
    """The weeks of every user from the first active one on, with the user's history.

    Columns: number and label of the week, how many weeks the row stands for, whether the
    user was active, the first active week, activity 1 to 4 weeks back, and the last active
    week before this one. Nothing but the label changes from the fifth inactive week in a
    row on, so those weeks are one row; the result therefore grows with the activity and
    not with users x weeks.
    """
    calendar = _weekly_calendar(events, users, start_ds)
    all_weeks = week_list(activity_steps(calendar))
    following = F.concat(F.slice("weeks", 2, F.size("weeks")), F.array(_date(AFTER_LAST)))
    stretch = F.inline(F.arrays_zip(F.col("weeks").alias("week"), following.alias("next_week")))
    lapse = F.col("i") + LOOKBACK_WEEKS + 1
    number, until = F.col("number"), F.col("q")
    rows = (
        calendar.select("user_id", "acq_source", "country", stretch)
        .select(
            "user_id", "acq_source", "country",
            _position(all_weeks, "week").alias("i"), _position(all_weeks, "next_week").alias("q"),
        )
        .select("*", F.explode(F.sequence("i", F.least(lapse, until - 1))).alias("number"))
        .select(
            "user_id", "acq_source", "country", "number",
            _week(all_weeks, number).alias("week_start"),
            F.when(number == lapse, until - number).otherwise(1).alias("n_weeks"),
            (number == F.col("i")).cast("int").alias("is_active"),
        )
    )
    user = Window.partitionBy("user_id")
    by_week = user.orderBy("number")
    active = F.col("is_active")
    active_week = F.when(active == 1, F.col("week_start"))
    lags = {
        f"active_{n}_back": F.coalesce(F.lag(active, n).over(by_week), F.lit(0)) for n in range(1, LOOKBACK_WEEKS + 1)
    }
    before = by_week.rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumns(
        {
            "first_week": F.min(active_week).over(user),
            **lags,
            "last_active_week": F.max(active_week).over(before),
        }
    )


def lifecycle_weekly_from_history(
    events: DataFrame, users: DataFrame, start_ds: str, as_of: str | dt.date | None = None
) -> DataFrame:
    """The weekly counts by classifying every row of ``user_week_history``."""
    active = F.col("is_active") == 1
    recently = F.lit(False)
    for n in range(1, LOOKBACK_WEEKS + 1):
        recently = recently | (F.col(f"active_{n}_back") == 1)
    lapsed = F.col("last_active_week") < F.date_sub("week_start", 7 * LOOKBACK_WEEKS)
    status = (
        F.when(active & (F.col("week_start") == F.col("first_week")), "new")
        .when(active & recently, "retained")
        .when(active, "resurrected")
        .when(recently, "dormant")
        .when(lapsed, "churned")
    )
    number = F.col("number")
    edges = F.array(
        F.struct(number.alias("number"), F.lit(1).cast("long").alias("change")),
        F.struct((number + F.col("n_weeks")).alias("number"), F.lit(-1).cast("long").alias("change")),
    )
    changes = (
        user_week_history(events, users, start_ds)
        .select("acq_source", "country", status.alias("user_status"), F.inline(edges))
        .where(F.col("user_status").isNotNull())
        .groupBy("acq_source", "country", "user_status", "number")
        .agg(F.sum("change").alias("change"))
    )
    all_weeks = week_list(activity_steps(_weekly_calendar(events, users, start_ds)))
    return _labelled(running_counts(changes).withColumn("week", _week(all_weeks, number)), as_of)


def _labelled(counts: DataFrame, as_of: str | dt.date | None) -> DataFrame:
    """Week label and build date added; ordered by the label text."""
    return (
        counts.withColumn("cutoff_week", cutoff_label(F.col("week")))
        .withColumn("ds", ds_column(resolve_as_of(as_of)))
        .select(*AGG_USER_LIFECYCLE_WEEKLY.names)
        .orderBy(*[F.asc_nulls_last(c) for c in ("cutoff_week", "acq_source", "country", "user_status")])
    )
