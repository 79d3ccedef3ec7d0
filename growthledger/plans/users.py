"""User dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import ds_column, resolve_as_of
from ..functions.jsonmap import iso_timestamp, json_object
from ..sources.schemas import DIM_USERS, MILES


def recency(as_of: dt.date, days: int) -> Column:
    """1 for an event in the last ``days`` days before ``as_of`` or later, else 0."""
    since = F.lit(as_of - dt.timedelta(days=days)).cast("timestamp_ntz")
    return F.when(F.col("event_time") >= since, 1).otherwise(0)


def miles_of(event_type: str) -> Column:
    return F.when(F.col("event_type") == event_type, F.col("miles_amount")).otherwise(F.lit(0).cast(MILES))


def latest_event_order() -> Column:
    """Struct that is greatest for the latest event of a user.

    A missing time counts as latest; equal times are decided by the remaining columns.
    """
    return F.struct(
        F.col("event_time").isNull().alias("untimed"),
        "event_time", "event_type", "transaction_category", "miles_amount",
    )


def latest_event_per_user(stream: DataFrame) -> DataFrame:
    """user_id and the columns of the user's latest event."""
    latest = stream.groupBy("user_id").agg(F.max(latest_event_order()).alias("latest"))
    return latest.select(
        "user_id", "latest.event_time", "latest.event_type",
        "latest.transaction_category", "latest.miles_amount",
    )


def dim_users(stream: DataFrame, as_of: str | dt.date | None = None) -> DataFrame:
    """Snapshot of every user: attributes, miles totals, recency flags, latest event.

    One scan and one map-side combined aggregate; the latest event travels through it as
    a ``max`` over a struct. The window afterwards sees one row per user and attribute
    pair: it carries the latest event over when a user has several pairs.
    """
    built = resolve_as_of(as_of)
    totals = stream.groupBy(
        "user_id", F.col("utm_source").alias("acq_source"), F.col("country").alias("user_country")
    ).agg(
        F.sum(miles_of("miles_earned")).alias("total_miles_earned"),
        F.sum(miles_of("miles_redeemed")).alias("total_miles_redeemed"),
        *[(F.max(recency(built, n)) == 1).alias(f"active_in_{n}days") for n in (7, 30, 90)],
        F.max(latest_event_order()).alias("latest"),
    )
    # An event without a user is nobody's latest event.
    of_user = F.when(F.col("user_id").isNotNull(), F.max("latest").over(Window.partitionBy("user_id")))
    latest_json = json_object(
        event_time=iso_timestamp(F.col("latest.event_time")),
        event_type=F.col("latest.event_type"),
        transaction_category=F.col("latest.transaction_category"),
        miles_amount=F.col("latest.miles_amount"),
    )
    balance = F.col("total_miles_earned") - F.col("total_miles_redeemed")
    return (
        totals.withColumn("latest", of_user)
        .withColumns({"miles_balance": balance, "latest_event_json": latest_json})
        .withColumn("ds", ds_column(built))
        .select(*DIM_USERS.names)
    )

