"""Test tables: where the given ones lie, and small event tables made here."""

import datetime as dt
import os
from decimal import Decimal

from growthledger.sources.schemas import FCT_EVENT_STREAM, RAW_COLUMNS

TESTDATA = os.environ.get("TESTDATA", "/root/testdata")

GOOD = {
    "event_time": "2025-06-02 10:00:00.000000",
    "user_id": "u_0001",
    "event_type": "miles_earned",
    "transaction_category": "dining",
    "miles_amount": "10.00",
    "platform": "ios",
    "utm_source": "google",
    "country": "SG",
}


def staging(spark, *changes):
    """Raw text rows: GOOD with the given changes each."""
    schema = ", ".join(f"{name} string" for name in RAW_COLUMNS)
    return spark.createDataFrame([tuple({**GOOD, **c}[n] for n in RAW_COLUMNS) for c in changes], schema)


def stream(spark, *changes):
    """Typed events: GOOD with the given changes each; times as datetime or ISO text."""

    def typed(row):
        when, miles = row["event_time"], row["miles_amount"]
        if isinstance(when, str):
            when = dt.datetime.fromisoformat(when)
        values = {**row, "event_time": when, "miles_amount": None if miles is None else Decimal(miles)}
        return tuple(values[name] for name in FCT_EVENT_STREAM.names)

    return spark.createDataFrame([typed({**GOOD, **c}) for c in changes], FCT_EVENT_STREAM)


def active_in(user, *weeks, **more):
    """One event of the user in each week; a week is given by its label (a Sunday)."""
    monday = [dt.datetime.fromisoformat(w) + dt.timedelta(days=1, hours=9) for w in weeks]
    return [{"user_id": user, "event_time": day, **more} for day in monday]


def tuples(df):
    return [tuple(row) for row in df.collect()]
