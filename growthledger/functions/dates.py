"""Calendar expressions. All of them work on DATE values, so no time zone is involved."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def week_start(when: Column) -> Column:
    """Label of the Monday-to-Sunday week of ``when``: the Sunday before its Monday.

    A Sunday therefore belongs to the bucket labelled seven days earlier.
    """
    return F.date_sub(F.trunc(F.to_date(when), "week"), 1)


def month_start(when: Column) -> Column:
    return F.trunc(F.to_date(when), "month")


def cutoff_label(week: Column) -> Column:
    """``WKnn YYYY-MM-DD``: ISO week number of the label date, then the date itself."""
    number = F.lpad(F.weekofyear(week).cast("string"), 2, "0")
    return F.concat(F.lit("WK"), number, F.lit(" "), week.cast("string"))


def weeks_between(later: Column, earlier: Column) -> Column:
    """Whole weeks from ``earlier`` to ``later``; both are week labels."""
    return (F.datediff(later, earlier) / 7).cast("int")


def resolve_as_of(as_of: str | dt.date | None) -> dt.date:
    """The build date: the given one, or today in UTC."""
    if as_of is None:
        return dt.datetime.now(dt.timezone.utc).date()
    if isinstance(as_of, dt.datetime):
        return as_of.date()
    if isinstance(as_of, dt.date):
        return as_of
    return dt.date.fromisoformat(as_of)


def ds_column(as_of: dt.date) -> Column:
    return F.lit(as_of.isoformat()).alias("ds")
