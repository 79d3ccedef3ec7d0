"""Parquet tables: reads with a fixed schema, full replacement, snapshot replacement, days that grow."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .versions import Manifest, current, file_system, names_in, publish


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Scan a table. The schema is given, so ``ds`` stays text when it is a directory name.

    A published table is read in the state of this moment, whatever is published later.
    """
    state = current(spark, path)
    if state is None:  # written by ``write_full``, or not there
        return spark.read.schema(schema).parquet(path).select(*schema.names)
    return read_folders(spark, path, schema, sorted(state.all_folders()))


def read_folders(spark: SparkSession, path: str, schema: T.StructType, folders: list[str]) -> DataFrame:
    """Scan some folders of a published table."""
    if not folders:
        return spark.createDataFrame([], schema)
    path = path.rstrip("/")
    reader = spark.read.schema(schema).option("basePath", path)
    return reader.parquet(*[f"{path}/{f}" for f in folders]).select(*schema.names)


def write_full(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Write a table that nobody reads yet, over what is there."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def replace_full(
    df: DataFrame, path: str, partition_by: str | None = None, check: Callable[[str], None] | None = None
) -> None:
    """Replace the whole table, or leave it as it is when the write or ``check`` fails.

    The new table is written once, beside the old one, and ``check`` is given its path.
    """
    spark = df.sparkSession

    def change(before: Manifest, folder: str) -> Manifest:
        return Manifest(folders=_partitions(spark, path, folder, partition_by))

    publish(spark, path, lambda aside: write_full(df, aside, partition_by), change, check)


def replace_snapshot(df: DataFrame, path: str, ds: str, check: Callable[[str], None] | None = None) -> None:
    """Replace the snapshot of ``ds``, also by an empty one; the others stay as they are.

    Written, checked and published like a whole table. ``df`` holds rows of that ``ds`` only.
    """

    def change(before: Manifest, folder: str) -> Manifest:
        return Manifest(folders={**before.folders, f"ds={ds}": [f"{folder}/ds={ds}"]}, loaded=before.loaded)

    def written(aside: str) -> None:
        write_full(df.drop("ds"), f"{aside}/ds={ds}")

    publish(df.sparkSession, path, written, change, check and (lambda aside: check(f"{aside}/ds={ds}")))


def append_days(
    df: DataFrame, path: str, loaded: dict[str, str], check: Callable[[str], None] | None = None
) -> list[str]:
    """Add rows to the days of a table that is kept by ``ds``, and note what they were ``loaded`` from; the touched days.

    Rows and note become visible together, so what is noted was loaded once and whole. Files that
    are there stay as they are, also those of the touched days.
    """
    spark = df.sparkSession
    touched: list[str] = []

    def change(before: Manifest, folder: str) -> Manifest:
        new = _partitions(spark, path, folder, "ds")
        touched.extend(sorted(new))
        folders = {k: [*before.folders.get(k, []), *new.get(k, [])] for k in {*before.folders, *new}}
        return Manifest(folders=folders, loaded={**before.loaded, **loaded})

    publish(spark, path, lambda aside: write_full(df, aside, "ds"), change, check)
    return [t.removeprefix("ds=") for t in touched]


def _partitions(spark: SparkSession, path: str, folder: str, partition_by: str | None) -> dict[str, list[str]]:
    """The folders of a written version by partition."""
    if not partition_by:
        return {"": [folder]}
    names = names_in(spark, f"{path.rstrip('/')}/{folder}")
    return {n: [f"{folder}/{n}"] for n in names if n.startswith(f"{partition_by}=")}


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table if it is there."""
    files, at = file_system(spark, path)
    files.delete(at(path), True)


def latest_ds(spark: SparkSession, path: str) -> str | None:
    """The greatest ``ds`` of a published table; no data is read."""
    state = current(spark, path)
    return max((k.removeprefix("ds=") for k in state.folders if k.startswith("ds=")), default=None) if state else None


def read_latest(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The latest snapshot of a published table: a scan of one partition."""
    state = current(spark, path)
    newest = max(state.folders, default=None) if state else None
    return read_folders(spark, path, schema, state.folders[newest] if newest else [])


def cluster_by_ds(df: DataFrame) -> DataFrame:
    """Gather each ``ds`` in few tasks before a partitioned write.

    Rebalancing lets adaptive execution split a day that holds a large share of the rows
    and merge small ones; hashing on ``ds`` alone would give a hot day to a single task.
    """
    return df.hint("rebalance", "ds")


def latest_snapshot(df: DataFrame) -> DataFrame:
    """Rows of the greatest ``ds``.

    For a computed table. Of a stored one take ``read_latest``: the scalar subquery here
    passes over all snapshots to find the last.
    """
    return df.where(F.col("ds") == df.select(F.max("ds")).scalar())
