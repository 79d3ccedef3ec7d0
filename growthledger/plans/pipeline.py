"""The gated build of all tables.

Every step reads published tables only. A table is written once, beside the published one,
checked there, and published when all checks passed, so that readers never see data
that failed and a failed build leaves the old table whole. The user and metric tables keep
one partition per build date.
"""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from collections.abc import Collection
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import resolve_as_of
from ..operators.activity import active_days, segments, with_weeks
from ..quality import models
from ..quality.across import across_checks
from ..quality.checks import Check, RowCheck, bad_row_counts
from ..quality.gate import gate
from ..session import work_path
from ..sources import schemas
from ..sources.tables import read_latest, read_table, remove, replace_full, replace_snapshot, write_full
from .active import active_users, active_users_from_calendar
from .facts import fct_events
from .ingest import load_staging, load_stream, read_stream
from .lifecycle import lifecycle_from_calendar, lifecycle_weekly
from .retention import retention, retention_from_calendar
from .users import dim_users

log = logging.getLogger(__name__)

# Fixed value: first event day the metrics look at unless told otherwise.
DEFAULT_START_DS = "2025-01-01"

SCHEMAS = {
    "stg_event_stream": schemas.STG_EVENT_STREAM,
    "fct_event_stream": schemas.FCT_EVENT_STREAM,
    "fct_events": schemas.FCT_EVENTS,
    "dim_users": schemas.DIM_USERS,
    "agg_active_user": schemas.AGG_ACTIVE_USER,
    "agg_user_lifecycle_weekly": schemas.AGG_USER_LIFECYCLE_WEEKLY,
    "agg_user_retention": schemas.AGG_USER_RETENTION,
}

_CALENDAR = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("days", T.ArrayType(T.DateType())),
        T.StructField("acq_source", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("is_known", T.BooleanType()),
    ]
)


@dataclass(frozen=True)
class Warehouse:
    """The tables under one root folder.

    ``warn``: checks, as ``<table>.<check>``, that the source is known to fail. Their failing rows are counted in the log and,
    but for the raw checks, stored in the audit; they stay in the tables and stop no build. None unless told so.
    """

    spark: SparkSession
    root: str
    warn: Collection[str] = ()

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def read(self, table: str) -> DataFrame:
        if table == "fct_event_stream":
            return read_stream(self.spark, self.path(table))
        return read_table(self.spark, self.path(table), SCHEMAS[table])

    def latest_users(self) -> DataFrame:
        return self.latest("dim_users")

    def latest(self, table: str) -> DataFrame:
        """The latest snapshot of a table that keeps one per build date."""
        return read_latest(self.spark, self.path(table), SCHEMAS[table])

    @property
    def audit_path(self) -> str:
        return self.path("audit")

    def register_views(self, *tables: str) -> None:
        """Make the tables (all by default) visible to ``spark.sql`` under their names."""
        for table in tables or SCHEMAS:
            self.read(table).createOrReplaceTempView(table)


def run_sql(spark: SparkSession, statement: str, message: str = "SQL executed") -> DataFrame:
    """Run one SQL statement and log the message."""
    result = spark.sql(statement)
    log.info(message)
    return result


def ingest(wh: Warehouse, csv_path: str | list[str], multiline: bool = False) -> None:
    load_staging(wh.spark, csv_path, wh.path("stg_event_stream"), multiline, wh.warn)
    load_stream(wh.spark, wh.path("stg_event_stream"), wh.path("fct_event_stream"))


def build_fct_events(wh: Warehouse) -> None:
    """Write the event fact beside the published one, check it there, then replace it.

    The row checks are observed while it is written: the write has no shuffle, so no row
    is observed twice. Only the key's uniqueness takes another pass.
    """
    checks = [*models.fct_events_checks(), models.miles_presence_check()]
    observed = Observation("fact checks")
    row_checks = [c for c in checks if isinstance(c, RowCheck)]
    events = fct_events(wh.read("fct_event_stream")).observe(observed, *bad_row_counts(row_checks))

    def check(aside: str) -> None:
        written = read_table(wh.spark, aside, SCHEMAS["fct_events"])
        gate("fct_events", written, checks, wh.audit_path, observed.get, wh.warn)

    # The stream is stored by day, so each task already holds few days: no shuffle.
    replace_full(events, wh.path("fct_events"), "ds", check)


def build_dim_users(wh: Warehouse, as_of: str | dt.date | None = None) -> None:
    stream = wh.read("fct_event_stream")
    gate("fct_event_stream", stream, [models.single_attribute_check()], wh.audit_path, warn=wh.warn)
    built = resolve_as_of(as_of)
    _publish(wh, "dim_users", dim_users(stream, built), models.dim_users_checks(), built)


def build_agg_active_user(
    wh: Warehouse, start_ds: str = DEFAULT_START_DS, as_of: str | dt.date | None = None
) -> None:
    built = resolve_as_of(as_of)
    result = active_users(wh.read("fct_events"), wh.latest_users(), start_ds, built)
    _publish(wh, "agg_active_user", result, models.active_user_checks(), built)


def build_agg_user_lifecycle_weekly(
    wh: Warehouse, start_ds: str = DEFAULT_START_DS, as_of: str | dt.date | None = None
) -> None:
    built = resolve_as_of(as_of)
    result = lifecycle_weekly(wh.read("fct_events"), wh.latest_users(), start_ds, built)
    _publish(wh, "agg_user_lifecycle_weekly", result, models.lifecycle_checks(), built)


def build_agg_user_retention(
    wh: Warehouse, start_ds: str = DEFAULT_START_DS, as_of: str | dt.date | None = None
) -> None:
    built = resolve_as_of(as_of)
    result = retention(wh.read("fct_events"), start_ds, built)
    _publish(wh, "agg_user_retention", result, models.retention_checks(), built)


def build_metrics(wh: Warehouse, start_ds: str = DEFAULT_START_DS, as_of: str | dt.date | None = None) -> None:
    """All three metric tables from one pass over the events.

    The per-user daily calendar is written once to the work folder; the three datasets
    then read a table of users instead of scanning and shuffling the events three times.
    """
    known = segments(wh.latest_users()).withColumn("is_known", F.lit(True))
    calendar = active_days(wh.read("fct_events"), start_ds).join(known, "user_id", "left")
    built = resolve_as_of(as_of)
    path = work_path(wh.spark, wh.root, f"user_calendar-{built}-{uuid.uuid4().hex}")
    write_full(calendar.select(*_CALENDAR.names), path)

    daily = read_table(wh.spark, path, _CALENDAR)
    weekly = with_weeks(daily)
    try:
        publish_metrics(
            wh,
            active_users_from_calendar(daily.where("is_known"), built),
            lifecycle_from_calendar(weekly.where("is_known"), built),
            retention_from_calendar(weekly, built),
            built,
        )
    finally:
        remove(wh.spark, path)


def publish_metrics(wh: Warehouse, active: DataFrame, lifecycle: DataFrame, rates: DataFrame, built: dt.date) -> None:
    """Publish the three metric tables of one build date, each behind its checks."""
    _publish(wh, "agg_active_user", active, models.active_user_checks(), built)
    _publish(wh, "agg_user_lifecycle_weekly", lifecycle, models.lifecycle_checks(), built)
    _publish(wh, "agg_user_retention", rates, models.retention_checks(), built)


def check_metrics(wh: Warehouse) -> None:
    """The checks across the latest metric tables; failing rows are stored under ``audit/metrics``."""
    tables = {t: wh.latest(t) for t in ("agg_active_user", "agg_user_lifecycle_weekly", "agg_user_retention")}
    gate("metrics", tables, across_checks(), wh.audit_path, warn=wh.warn)


def run_pipeline(
    spark: SparkSession,
    csv_path: str | list[str],
    root: str,
    as_of: str | dt.date | None = None,
    start_ds: str = DEFAULT_START_DS,
    multiline: bool = False,
    warn: Collection[str] = (),
) -> Warehouse:
    """Everything in order. The first failed check that ``warn`` doesn't name raises and nothing after it runs."""
    wh = Warehouse(spark, root, warn)
    built = resolve_as_of(as_of)  # one date for all tables, also around midnight
    ingest(wh, csv_path, multiline)
    build_dim_users(wh, built)
    build_fct_events(wh)
    build_metrics(wh, start_ds, built)
    check_metrics(wh)
    return wh


def _publish(wh: Warehouse, table: str, result: DataFrame, checks: list[Check], built: dt.date) -> None:
    """Compute once beside the table, check there, then put the snapshot of ``built`` in place."""
    ds = built.isoformat()

    def check(aside: str) -> None:
        # The date is the directory's name, which the table beside doesn't have yet.
        stored = T.StructType([f for f in SCHEMAS[table].fields if f.name != "ds"])
        computed = read_table(wh.spark, aside, stored).withColumn("ds", F.lit(ds)).select(*SCHEMAS[table].names)
        gate(table, computed, checks, wh.audit_path, warn=wh.warn)

    replace_snapshot(result, wh.path(table), ds, check)
