import datetime as dt
import hashlib
from decimal import Decimal

import pytest
from helpers import stream, tuples
from pyspark.sql import functions as F

from growthledger.functions import dates, jsonmap, keys
from growthledger.plans.facts import fct_events


def test_week_labels(spark):
    days = ["2025-06-01", "2025-06-02", "2025-06-07", "2025-06-08", "2024-12-30"]
    df = spark.createDataFrame([(dt.datetime.fromisoformat(d),) for d in days], "t timestamp_ntz")
    week = dates.week_start(F.col("t"))
    assert tuples(df.select(week.cast("string"), dates.cutoff_label(week))) == [
        ("2025-05-25", "WK21 2025-05-25"),  # a Sunday belongs to the week before
        ("2025-06-01", "WK22 2025-06-01"),
        ("2025-06-01", "WK22 2025-06-01"),
        ("2025-06-01", "WK22 2025-06-01"),
        ("2024-12-29", "WK52 2024-12-29"),
    ]


def test_dates_do_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([(dt.datetime(2025, 3, 30, 2, 30),)], "t timestamp_ntz")
    week = dates.week_start(F.col("t"))
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/Sao_Paulo", "Asia/Singapore"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert tuples(df.select(week.cast("string"))) == [("2025-03-23",)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_resolve_as_of():
    assert dates.resolve_as_of("2025-06-01") == dt.date(2025, 6, 1)
    assert dates.resolve_as_of(dt.datetime(2025, 6, 1, 5)) == dt.date(2025, 6, 1)
    assert dates.resolve_as_of(None) == dt.datetime.now(dt.timezone.utc).date()


def test_surrogate_key_with_null(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    expected = hashlib.md5(b"a-_dbt_utils_surrogate_key_null_").hexdigest()
    assert tuples(df.select(keys.surrogate_key("x", "y"))) == [(expected,)]


def test_fact_row(spark):
    row = fct_events(
        stream(spark, {"event_time": "2025-06-01 10:00:00.120000", "event_type": "like", "miles_amount": None})
    ).first()
    assert row.event_id == hashlib.md5(b"2025-06-01 10:00:00.12-u_0001-like").hexdigest()
    assert (row.event_year, row.event_month, row.event_day, row.event_week) == (2025, 6, 1, 22)
    assert row.event_json == '{"event_type":"like","transaction_category":"dining","miles_amount":null}'
    assert row.ds == "2025-06-01"


def test_json_access(spark):
    df = spark.createDataFrame([('{"a":null,"b":"x","n":12345678.90}',)], "j string")
    j = F.col("j")
    row = df.select(
        jsonmap.json_text(j, "a"), jsonmap.json_text(j, "b"), jsonmap.json_text(j, "c"),
        jsonmap.json_number(j, "n", 10, 2), jsonmap.json_number(j, "a"),
        jsonmap.has_json_key(j, "a"), jsonmap.has_json_key(j, "c"),
    ).first()
    assert tuple(row) == (None, "x", None, Decimal("12345678.90"), None, True, False)


def test_json_number_rejects_text(spark):
    df = spark.createDataFrame([('{"n":"many"}',)], "j string")
    with pytest.raises(Exception, match="MALFORMED"):
        df.select(jsonmap.json_number(F.col("j"), "n")).collect()
