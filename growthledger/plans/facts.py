"""Event fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.jsonmap import json_object
from ..functions.keys import surrogate_key
from ..sources.schemas import FCT_EVENTS


def event_json() -> Column:
    return json_object(
        event_type=F.col("event_type"),
        transaction_category=F.col("transaction_category"),
        miles_amount=F.col("miles_amount"),
    )


def fct_events(stream: DataFrame) -> DataFrame:
    """One row per event with a surrogate key, date parts, a JSON payload and its day.

    A narrow projection: it runs in the scan stage and readers only pay for the columns
    they use.
    """
    when = F.col("event_time")
    return stream.select(
        surrogate_key("event_time", "user_id", "event_type").alias("event_id"),
        "event_time",
        F.year(when).alias("event_year"),
        F.month(when).alias("event_month"),
        F.dayofmonth(when).alias("event_day"),
        F.weekofyear(when).alias("event_week"),
        "user_id",
        "event_type",
        event_json().alias("event_json"),
        "platform",
        F.to_date(when).cast("string").alias("ds"),
    ).select(*FCT_EVENTS.names)
