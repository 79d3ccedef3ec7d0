"""Raw file -> staging table -> checks -> typed event table."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..quality.checks import bad_row_counts
from ..quality.gate import enforce
from ..quality.staging import staging_checks
from ..session import require_ansi
from ..sources.csvfiles import read_raw_csv
from ..sources.schemas import FCT_EVENT_STREAM, STG_EVENT_STREAM, VARCHAR_LIMITS
from ..sources.tables import cluster_by_ds, read_table, replace_full


def typed_load(staging: DataFrame) -> DataFrame:
    """Text columns cast to the event table's types; a bad or too long value is an error."""
    require_ansi(staging.sparkSession)
    return staging.select(*[_typed(field).alias(field.name) for field in FCT_EVENT_STREAM.fields])


def _typed(field: T.StructField) -> Column:
    value = F.col(field.name)
    if field.name not in VARCHAR_LIMITS:
        return value.cast(field.dataType)
    limit = VARCHAR_LIMITS[field.name]
    message = F.concat(F.lit(f"{field.name} is longer than {limit} characters: "), value)
    return (
        F.when(value.isNull() | (F.length(value) <= limit), value)
        # Only trailing spaces may be cut off.
        .when(F.length(F.rtrim(value)) <= limit, F.substring(value, 1, limit))
        .otherwise(F.raise_error(message))
    )


def load_staging(
    spark: SparkSession, csv_path: str | list[str], staging_path: str, multiline: bool = False, warn: Collection[str] = ()
) -> None:
    """Replace the staging table with the file's rows if they pass the fifteen checks, but for those that ``warn`` names.

    The checks are observed while the rows are written, so they cost no second scan.
    The write has no shuffle, so no row is observed twice.
    """
    checks = staging_checks()
    observed = Observation("staging checks")
    rows = read_raw_csv(spark, csv_path, multiline=multiline)

    def check(aside: str) -> None:
        failed = {name: count for name, count in observed.get.items() if count}
        enforce("stg_event_stream", checks, failed, warn)

    replace_full(rows.observe(observed, *bad_row_counts(checks)), staging_path, check=check)


def load_stream(spark: SparkSession, staging_path: str, stream_path: str) -> None:
    """Replace the typed event table from the staging table.

    Stored by day, which prunes scans and leaves the event fact without a shuffle.
    """
    typed = typed_load(read_table(spark, staging_path, STG_EVENT_STREAM))
    by_day = typed.withColumn("ds", F.to_date("event_time").cast("string"))
    replace_full(cluster_by_ds(by_day), stream_path, partition_by="ds")


def ingest_events(
    spark: SparkSession, csv_path: str | list[str], staging_path: str, stream_path: str, multiline: bool = False,
    warn: Collection[str] = (),
) -> DataFrame:
    """The whole ingest; returns the typed event table. A failed check that ``warn`` doesn't name stops before the load."""
    load_staging(spark, csv_path, staging_path, multiline, warn)
    load_stream(spark, staging_path, stream_path)
    return read_stream(spark, stream_path)


def read_stream(spark: SparkSession, stream_path: str) -> DataFrame:
    """The typed event table; its day directories are not part of its columns."""
    stored = T.StructType([*FCT_EVENT_STREAM.fields, T.StructField("ds", T.StringType())])
    return read_table(spark, stream_path, stored).select(*FCT_EVENT_STREAM.names)
