"""Typed event streams derived from general event and order tables.

Both adapters are narrow projections: the source columns are renamed, and the missing
loyalty columns are filled by fixed rules on the row key ``k`` and the user key ``u``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import COUNTRIES, FCT_EVENT_STREAM, PLATFORMS, TRANSACTION_CATEGORIES, UTM_SOURCES

# Build parameters that suit the time range of each source table.
EVENTS_START_DS, EVENTS_AS_OF = "2024-01-01", "2024-01-31"
ORDERS_START_DS, ORDERS_AS_OF = "1995-01-01", "2001-08-02"

# Source event kinds, and the kinds of orders by key modulo 5.
KIND_OF_EVENT = {
    "purchase": "miles_earned", "signup": "miles_redeemed", "view": "reward_search",
    "click": "like", "error": "share",
}
KIND_OF_ORDER = ["miles_earned", "miles_redeemed", "reward_search", "like", "share"]


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = " ".join(f"WHEN '{source}' THEN '{kind}'" for source, kind in KIND_OF_EVENT.items())
    return _as_stream(
        spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr(
            "ts AS event_time", "user_id AS u", "event_id AS k", "value AS amount",
            f"CASE event_type {kinds} END AS event_type",
        )
    )


def orders_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_stream(
        spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr(
            "o_orderdate AS event_time", "o_custkey AS u", "o_orderkey AS k", "o_totalprice AS amount",
            f"{_pick(KIND_OF_ORDER, 'o_orderkey')} AS event_type",
        )
    )


def as_staging(stream: DataFrame) -> DataFrame:
    """The stream as it would look in the raw file: text only, six fraction digits."""
    texts = stream.select(*[F.col(name).cast("string").alias(name) for name in FCT_EVENT_STREAM.names])
    when = F.col("event_time")  # the cast drops trailing zeros of the fraction
    dotted = F.when(when.contains("."), when).otherwise(F.concat(when, F.lit(".")))
    return texts.withColumn("event_time", F.rpad(dotted, len("YYYY-MM-DD HH:MM:SS.ffffff"), "0"))


def _pick(values: list[str], key: str) -> str:
    """SQL for the value at position ``key`` modulo the length of the list."""
    listed = ", ".join(f"'{v}'" for v in values)
    return f"element_at(array({listed}), int({key} % {len(values)}) + 1)"


def _as_stream(source: DataFrame) -> DataFrame:
    # lpad alone would cut ids of more than four digits.
    user_id = "'u_' || lpad(string(u), greatest(4, length(string(u))), '0')"
    return source.selectExpr(
        "event_time",
        f"{user_id} AS user_id",
        "event_type",
        f"if(event_type NOT IN ('share', 'like'), {_pick(TRANSACTION_CATEGORIES, 'k')}, NULL) AS transaction_category",
        "if(event_type IN ('miles_earned', 'miles_redeemed'), CAST(amount AS DECIMAL(10, 2)), NULL) AS miles_amount",
        f"{_pick(PLATFORMS, 'k')} AS platform",
        f"{_pick(UTM_SOURCES, 'u')} AS utm_source",
        f"{_pick(COUNTRIES, '(u div 5)')} AS country",
    )
