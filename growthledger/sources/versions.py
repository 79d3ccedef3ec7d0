"""Versioned tables: folders that are never changed, and numbered manifests that say which of them count.

``<table>/version=<number>-<run>/...`` hold the data, ``<table>/_manifests/<number>.json`` the published states. A
publication writes a new folder, has it checked, and becomes visible with one file: its manifest, which is written
aside and renamed to the next number. The greatest number is the table; readers look it up once and keep reading
those folders. So there is no moment without a table, nothing is copied or moved, and a build that is killed
anywhere leaves at most a folder that no manifest names; the next publication removes it.

There is one publisher at a time. Of two that overlap, the second finds its number taken and fails without effect.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

#: Published states whose folders are kept, so that running readers of earlier ones can finish.
KEEP = 2
_MANIFESTS = "_manifests"


@dataclass(frozen=True)
class Manifest:
    """A published state: the folders of each partition (or of "", the whole table), and what has been loaded into them."""

    number: int = 0
    folders: dict[str, list[str]] = field(default_factory=dict)
    loaded: dict[str, str] = field(default_factory=dict)

    def all_folders(self) -> set[str]:
        return {f for several in self.folders.values() for f in several}


class ConcurrentPublication(Exception):
    """Another publication of the table came in between."""


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and its path constructor."""
    at = spark._jvm.org.apache.hadoop.fs.Path
    return at(path).getFileSystem(spark._jsc.hadoopConfiguration()), at


def names_in(spark: SparkSession, path: str) -> list[str]:
    """What lies in a folder; nothing if it isn't there."""
    files, at = file_system(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(at(path))) if files.exists(at(path)) else []


def _numbers(spark: SparkSession, path: str) -> list[int]:
    names = names_in(spark, f"{path}/{_MANIFESTS}")
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))


def _read(spark: SparkSession, path: str, number: int) -> Manifest:
    files, at = file_system(spark, path)
    stream = files.open(at(f"{path}/{_MANIFESTS}/{number:08d}.json"))
    try:
        return Manifest(**json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
    finally:
        stream.close()


def current(spark: SparkSession, path: str) -> Manifest | None:
    """The table's published state, from one listing and one small file."""
    path = path.rstrip("/")
    numbers = _numbers(spark, path)
    return _read(spark, path, numbers[-1]) if numbers else None


def publish(
    spark: SparkSession,
    path: str,
    write: Callable[[str], None],
    change: Callable[[Manifest, str], Manifest],
    check: Callable[[str], None] | None = None,
) -> Manifest:
    """Write a new folder, check it, and make it part of the table, or leave the table as it is.

    ``write`` and ``check`` are given the folder's path; ``change`` the published state and the folder's name, and returns the
    state to publish.
    """
    path = path.rstrip("/")
    files, at = file_system(spark, path)
    before = current(spark, path) or Manifest()
    number = before.number + 1
    folder = f"version={number:08d}-{uuid.uuid4().hex[:8]}"
    try:
        write(f"{path}/{folder}")
        if check:
            check(f"{path}/{folder}")
        after = change(before, folder)
        after = Manifest(number, after.folders, after.loaded)
        _commit(spark, path, after)
    except BaseException:
        files.delete(at(f"{path}/{folder}"), True)
        if files.exists(at(path)) and not names_in(spark, path):
            files.delete(at(path), False)
        raise
    _expire(spark, path, number)
    return after


def _commit(spark: SparkSession, path: str, manifest: Manifest) -> None:
    files, at = file_system(spark, path)
    target = at(f"{path}/{_MANIFESTS}/{manifest.number:08d}.json")
    aside = at(f"{path}/{_MANIFESTS}/_{uuid.uuid4().hex}")
    out = files.create(aside, False)
    try:
        out.write(bytearray(json.dumps(manifest.__dict__, sort_keys=True).encode()))
    finally:
        out.close()
    if files.exists(target) or not files.rename(aside, target):
        files.delete(aside, False)
        raise ConcurrentPublication(f"version {manifest.number} of {path} was published meanwhile")


def _expire(spark: SparkSession, path: str, number: int) -> None:
    """Drop the states before the last KEEP, and the folders up to ``number`` that no kept state names."""
    files, at = file_system(spark, path)
    numbers = _numbers(spark, path)
    used = {f.partition("/")[0] for n in numbers[-KEEP:] for f in _read(spark, path, n).all_folders()}
    for name in names_in(spark, path):
        if name.startswith("version=") and name not in used and int(name[8:16]) <= number:
            files.delete(at(f"{path}/{name}"), True)
    for old in numbers[:-KEEP]:
        files.delete(at(f"{path}/{_MANIFESTS}/{old:08d}.json"), False)
