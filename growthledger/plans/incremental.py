"""Incremental loads: new raw files are added to the event stream, new stream rows to the event fact.

Each table's manifest notes what it was loaded from, in the same step that makes the rows visible. A run that is killed
is simply run again: what is noted is skipped, what is not was never seen. Days without new rows are not
touched, and in days with late rows the files that are there stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..quality import models
from ..quality.checks import RowCheck, bad_row_counts
from ..quality.gate import gate
from ..sources.schemas import FCT_EVENT_STREAM
from ..sources.tables import append_days, cluster_by_ds, read_folders, read_table
from ..sources.versions import Manifest, current, file_system
from .facts import fct_events
from .ingest import load_staging, typed_load
from .pipeline import SCHEMAS, Warehouse


def _stamp(wh: Warehouse, path: str) -> str:
    """Length and time of a file: what tells that it was changed."""
    files, at = file_system(wh.spark, path)
    status = files.getFileStatus(at(path))
    return f"{status.getLen()} {status.getModificationTime()}"


def load_new_files(wh: Warehouse, paths: list[str], multiline: bool = False) -> list[str]:
    """Load the raw files that are not loaded yet into the event stream; the days they touch.

    The files pass the raw checks together or none is loaded. A loaded file that has changed since is an error, as
    its rows can't be told from others any more.
    """
    stamps = {p: _stamp(wh, p) for p in paths}
    known = (current(wh.spark, wh.path("fct_event_stream")) or Manifest()).loaded
    changed = sorted(p for p, stamp in stamps.items() if known.get(p, stamp) != stamp)
    if changed:
        raise ValueError(f"loaded files have changed: {changed}")
    new = sorted(p for p in stamps if p not in known)
    if not new:
        return []
    load_staging(wh.spark, new, wh.path("stg_event_stream"), multiline, wh.warn)
    typed = typed_load(wh.read("stg_event_stream"))
    by_day = typed.withColumn("ds", F.to_date("event_time").cast("string"))
    return append_days(cluster_by_ds(by_day), wh.path("fct_event_stream"), {p: stamps[p] for p in new})


def add_new_facts(wh: Warehouse) -> list[str]:
    """Add the events of the stream that are not in the event fact yet; the days they touch.

    The new rows pass the fact's row checks; the key is checked over whole days, together with what is there.
    A fact that was built from a stream which is gone can't be added to: that is an error.
    """
    spark, path = wh.spark, wh.path("fct_events")
    stream = current(spark, wh.path("fct_event_stream")) or Manifest()
    fact = current(spark, path) or Manifest()
    if fact.folders and not (fact.loaded and fact.loaded.keys() <= stream.all_folders()):
        raise ValueError("the event fact does not come from this event stream: build it as a whole")
    new = sorted(stream.all_folders() - fact.loaded.keys())
    if not new:
        return []
    stored = T.StructType([*FCT_EVENT_STREAM.fields, T.StructField("ds", T.StringType())])
    rows = read_folders(spark, wh.path("fct_event_stream"), stored, new).select(*FCT_EVENT_STREAM.names)

    checks = [*models.fct_events_checks(), models.miles_presence_check()]
    observed = Observation("new facts")
    events = fct_events(rows).observe(observed, *bad_row_counts([c for c in checks if isinstance(c, RowCheck)]))
    days = {f.rpartition("/")[2] for f in new}
    there = [f for day in sorted(days & fact.folders.keys()) for f in fact.folders[day]]

    def check(aside: str) -> None:
        written = read_table(spark, aside, SCHEMAS["fct_events"])
        both = written.unionByName(read_folders(spark, path, SCHEMAS["fct_events"], there))
        gate("fct_events", both, checks, wh.audit_path, observed.get, wh.warn)

    # The stream is stored by day, so each task already holds few days: no shuffle.
    return append_days(events, path, dict.fromkeys(new, ""), check)

