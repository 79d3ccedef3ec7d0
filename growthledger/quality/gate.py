"""The gate: stop the run at a failed check and keep the failing rows."""

from __future__ import annotations

import logging
from collections.abc import Collection, Iterable, Mapping

from pyspark.sql import DataFrame

from ..sources.tables import remove
from .across import TablesCheck
from .checks import Check, RowCheck, bad_row_counts

log = logging.getLogger(__name__)


class DataQualityError(Exception):
    """Carries the failed checks of one table with their bad row counts."""

    def __init__(self, table: str, failed: dict[str, int]):
        self.table = table
        self.failed = failed
        listed = ", ".join(f"{name}: {count}" for name, count in failed.items())
        super().__init__(f"{table} failed its checks ({listed})")


def failed_checks(
    df: DataFrame | Mapping[str, DataFrame],
    checks: Iterable[Check | TablesCheck],
    known: dict[str, int] | None = None,
) -> dict[str, int]:
    """Failed checks with their number of failing rows.

    One pass for all row checks together, one for every group check; only counts reach
    the driver. ``known``: counts that were observed before, say while ``df`` was written.
    """
    checks = list(checks)
    counts = dict(known or {})
    row_checks = [c for c in checks if isinstance(c, RowCheck) and c.name not in counts]
    if row_checks:
        counts |= df.agg(*bad_row_counts(row_checks)).first().asDict()
    for check in checks:
        if check.name not in counts:
            counts[check.name] = check.failing(df).count()
    return {c.name: counts[c.name] for c in checks if counts[c.name]}


def enforce(
    table: str, checks: Iterable[Check | TablesCheck], failed: dict[str, int], warn: Collection[str] = ()
) -> None:
    """Log every check and raise when any failed, unless ``warn`` names it as ``<table>.<check>``."""
    stopping = {name: count for name, count in failed.items() if f"{table}.{name}" not in warn}
    for check in checks:
        if check.name in stopping:
            log.error("check FAILED: %s %s (%d rows)", table, check.name, failed[check.name])
        elif check.name in failed:
            log.warning("check failed, reported only: %s %s (%d rows)", table, check.name, failed[check.name])
        else:
            log.info("check passed: %s %s", table, check.name)
    if stopping:
        raise DataQualityError(table, stopping)


def gate(
    table: str,
    df: DataFrame | Mapping[str, DataFrame],
    checks: Iterable[Check | TablesCheck],
    audit_path: str | None = None,
    known: dict[str, int] | None = None,
    warn: Collection[str] = (),
) -> None:
    """Run the checks; on failure store the failing rows per check and raise.

    Failing rows of a check that ``warn`` names are stored alike, but don't stop the run.

    ``df``: the table, or several by their names for checks across tables.
    What earlier runs stored for these checks is removed, so that the audit shows this run.
    """
    checks = list(checks)
    failed = failed_checks(df, checks, known)
    spark = (next(iter(df.values())) if isinstance(df, Mapping) else df).sparkSession
    if audit_path:
        for check in checks:
            path = f"{audit_path}/{table}/{check.name}"
            if check.name in failed:
                check.failing(df).write.mode("overwrite").parquet(path)
            else:
                remove(spark, path)
    enforce(table, checks, failed, warn)
