"""Table schemas and the allowed values of the event domain."""

from __future__ import annotations

from pyspark.sql import types as T

# Allowed contents of the raw columns.
EVENT_TYPES = ["miles_earned", "share", "miles_redeemed", "reward_search", "like"]
TRANSACTION_CATEGORIES = [
    "dining", "ecommerce", "flight", "shopping", "shopee", "hotel", "lululemon", "apple",
]
PLATFORMS = ["ios", "android", "web"]
UTM_SOURCES = ["google", "facebook", "tiktok", "organic", "referral"]
COUNTRIES = ["TH", "SG", "MY", "PH", "ID"]
PERIOD_TYPES = ["daily", "weekly", "monthly"]
USER_STATUSES = ["new", "retained", "resurrected", "dormant", "churned"]
MAX_WEEK_OFFSET = 16

# Column order, and the text length limits of the typed event table.
RAW_COLUMNS = [
    "event_time", "user_id", "event_type", "transaction_category",
    "miles_amount", "platform", "utm_source", "country",
]
VARCHAR_LIMITS = {
    "user_id": 50, "event_type": 255, "transaction_category": 50,
    "platform": 50, "utm_source": 50, "country": 10,
}

MILES = T.DecimalType(10, 2)
# What Spark makes of sum(MILES); the balance is one digit wider.
MILES_TOTAL = T.DecimalType(20, 2)
RATE = T.DecimalType(5, 2)


def _table(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


STG_EVENT_STREAM = _table(*[(name, T.StringType()) for name in RAW_COLUMNS])

FCT_EVENT_STREAM = _table(
    ("event_time", T.TimestampNTZType()),
    ("user_id", T.StringType()),
    ("event_type", T.StringType()),
    ("transaction_category", T.StringType()),
    ("miles_amount", MILES),
    ("platform", T.StringType()),
    ("utm_source", T.StringType()),
    ("country", T.StringType()),
)

FCT_EVENTS = _table(
    ("event_id", T.StringType()),
    ("event_time", T.TimestampNTZType()),
    ("event_year", T.IntegerType()),
    ("event_month", T.IntegerType()),
    ("event_day", T.IntegerType()),
    ("event_week", T.IntegerType()),
    ("user_id", T.StringType()),
    ("event_type", T.StringType()),
    ("event_json", T.StringType()),
    ("platform", T.StringType()),
    ("ds", T.StringType()),
)

DIM_USERS = _table(
    ("user_id", T.StringType()),
    ("acq_source", T.StringType()),
    ("user_country", T.StringType()),
    ("total_miles_earned", MILES_TOTAL),
    ("total_miles_redeemed", MILES_TOTAL),
    ("miles_balance", T.DecimalType(21, 2)),
    ("active_in_7days", T.BooleanType()),
    ("active_in_30days", T.BooleanType()),
    ("active_in_90days", T.BooleanType()),
    ("latest_event_json", T.StringType()),
    ("ds", T.StringType()),
)

AGG_ACTIVE_USER = _table(
    ("period_start_date", T.DateType()),
    ("period_type", T.StringType()),
    ("acq_source", T.StringType()),
    ("country", T.StringType()),
    ("active_user_count", T.LongType()),
    ("ds", T.StringType()),
)

AGG_USER_LIFECYCLE_WEEKLY = _table(
    ("cutoff_week", T.StringType()),
    ("acq_source", T.StringType()),
    ("country", T.StringType()),
    ("user_status", T.StringType()),
    ("user_count", T.LongType()),
    ("ds", T.StringType()),
)

AGG_USER_RETENTION = _table(
    ("cohort_week", T.DateType()),
    ("week_offset", T.IntegerType()),
    ("retained_users", T.LongType()),
    ("cohort_size", T.LongType()),
    ("retention_rate", RATE),
    ("ds", T.StringType()),
)
