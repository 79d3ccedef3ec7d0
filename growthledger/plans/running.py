"""Incremental metrics: calendars and counts that are kept, and changed by what is new.

``metric_state`` holds the daily calendar of every user with the segment it was counted under, and the three kinds of
counts that the metric tables are derived from. An update reads the event fact's new folders only. It merges their
days into the calendars, takes what the changed users contributed before from the counts, and adds what they contribute
now. Users without a new day and with the same segment are compared, not counted again.

Calendars are kept as steps: an update appends its changed users, the last step of a user counts, and after
``MAX_STEPS`` updates they become one. All parts of the state and the note of the folders they come from are published in one step
(see ``sources.versions``), so an update that is killed has no effect and is run again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import resolve_as_of
from ..operators.activity import active_days, segments, with_weeks
from ..sources.tables import read_folders, read_table, write_full
from ..sources.versions import Manifest, current, publish
from .active import active_users_from_counts, period_counts
from .incremental import add_new_facts, load_new_files
from .lifecycle import activity_steps, lifecycle_from_steps
from .pipeline import DEFAULT_START_DS, SCHEMAS, Warehouse, build_dim_users, check_metrics, publish_metrics
from .retention import cohort_counts, retention_from_counts

STATE = "metric_state"
#: Steps that are read together before they become one.
MAX_STEPS = 8

_CALENDAR = [
    T.StructField("days", T.ArrayType(T.DateType())),
    T.StructField("acq_source", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("is_known", T.BooleanType()),
]
_STEP = T.StructType([T.StructField("user_id", T.StringType()), *_CALENDAR, T.StructField("step", T.IntegerType())])
_CHANGE = T.StructType([*_STEP.fields, T.StructField("before", T.StructType(_CALENDAR))])


def _counts_of_known(count: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    return lambda calendars: count(calendars.where("is_known"))


# Each kind of counts: how calendars are counted, and the columns, the last of which is the number.
_COUNTS: dict[str, tuple[Callable[[DataFrame], DataFrame], str]] = {
    "active": (
        _counts_of_known(period_counts),
        "period_start_date date, period_type string, acq_source string, country string, active_user_count long",
    ),
    "steps": (
        _counts_of_known(lambda calendars: activity_steps(with_weeks(calendars))),
        "acq_source string, country string, from_week date, to_week date, users long",
    ),
    "cohorts": (
        lambda calendars: cohort_counts(with_weeks(calendars)),
        "cohort_week date, week_offset int, retained_users long",
    ),
}


def _schema(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def calendars(spark: SparkSession, path: str, state: Manifest) -> DataFrame:
    """user_id, before: the last calendar of each user with its segment."""
    steps = state.folders.get("calendar", [])
    stored = read_folders(spark, path, _STEP, steps).select("user_id", F.struct(*[f.name for f in _CALENDAR]).alias("before"), "step")
    if len(steps) < 2:
        return stored.drop("step")
    return stored.groupBy("user_id").agg(F.max_by("before", "step").alias("before"))


def changed_calendars(before: DataFrame, new_days: DataFrame, known: DataFrame, step: int) -> DataFrame:
    """The calendars that differ from those before: by new days, or by the segment in the user dimension."""
    none = F.array().cast("array<date>")
    days = [F.coalesce(F.col(c), none) for c in ("before.days", "new_days")]
    joined = (
        before.join(new_days.withColumnRenamed("days", "new_days"), "user_id", "full")
        .join(known, "user_id", "left")
        .select(
            "user_id", F.array_sort(F.array_union(*days)).alias("days"), "acq_source", "country",
            F.coalesce("is_known", F.lit(False)).alias("is_known"), F.lit(step).alias("step"), "before",
        )
    )
    same = F.struct(*[f.name for f in _CALENDAR]).eqNullSafe(F.col("before"))
    return joined.where(~same)


def update_metrics(wh: Warehouse, start_ds: str = DEFAULT_START_DS, as_of: str | dt.date | None = None) -> None:
    """Bring the metric tables up to the event fact and the latest user dimension.

    The state starts anew when the fact was replaced or ``start_ds`` is another one.
    """
    spark, path = wh.spark, wh.path(STATE)
    built = resolve_as_of(as_of)
    fact = current(spark, wh.path("fct_events")) or Manifest()
    state = current(spark, path) or Manifest()
    if not (state.loaded.keys() <= fact.all_folders() and set(state.loaded.values()) <= {start_ds}):
        state = Manifest(state.number)
    new = sorted(fact.all_folders() - state.loaded.keys())
    events = read_folders(spark, wh.path("fct_events"), SCHEMAS["fct_events"], new)
    known = segments(wh.latest_users()).withColumn("is_known", F.lit(True))
    compact = len(state.folders.get("calendar", [])) >= MAX_STEPS

    def write(aside: str) -> None:
        before = calendars(spark, path, state)
        write_full(changed_calendars(before, active_days(events, start_ds), known, state.number + 1), f"{aside}/calendar")
        changed = read_table(spark, f"{aside}/calendar", _CHANGE)
        added, retracted = changed.drop("before"), changed.where("before IS NOT NULL").select("user_id", "before.*")
        for name, (count, ddl) in _COUNTS.items():
            *keys, number = _schema(ddl).names
            parts = read_folders(spark, path, _schema(ddl), state.folders.get(name, []))
            parts = parts.unionByName(count(added)).unionByName(count(retracted).withColumn(number, -F.col(number)))
            sums = parts.groupBy(*keys).agg(F.sum(number).alias(number)).where(F.col(number) != 0)
            write_full(sums, f"{aside}/{name}")
        if compact:
            last = changed.select("user_id", F.struct(*[f.name for f in _CALENDAR]).alias("after"))
            whole = before.join(last, "user_id", "full").withColumn("row", F.coalesce("after", "before"))
            write_full(whole.select("user_id", "row.*", F.lit(state.number + 1).alias("step")), f"{aside}/whole")

    def change(_: Manifest, folder: str) -> Manifest:
        steps = [f"{folder}/whole"] if compact else [*state.folders.get("calendar", []), f"{folder}/calendar"]
        counts = {name: [f"{folder}/{name}"] for name in _COUNTS}
        return Manifest(folders={"calendar": steps, **counts}, loaded={**state.loaded, **dict.fromkeys(new, start_ds)})

    after = publish(spark, path, write, change)
    kept = {n: read_folders(spark, path, _schema(ddl), after.folders[n]) for n, (_, ddl) in _COUNTS.items()}
    publish_metrics(
        wh,
        active_users_from_counts(kept["active"], built),
        lifecycle_from_steps(kept["steps"], built),
        retention_from_counts(kept["cohorts"], built),
        built,
    )


def run_increment(
    wh: Warehouse,
    paths: list[str],
    as_of: str | dt.date | None = None,
    start_ds: str = DEFAULT_START_DS,
    multiline: bool = False,
) -> None:
    """The daily run: load the raw files that are not loaded yet, and bring all tables up to date."""
    built = resolve_as_of(as_of)
    load_new_files(wh, paths, multiline)
    build_dim_users(wh, built)
    add_new_facts(wh)
    update_metrics(wh, start_ds, built)
    check_metrics(wh)
