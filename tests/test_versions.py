"""Versioned publication: what readers see when builds fail, are killed, overlap or repeat."""

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from growthledger.sources import versions
from growthledger.sources.tables import append_days, latest_ds, read_latest, read_table, replace_full, replace_snapshot, write_full
from growthledger.sources.versions import ConcurrentPublication, current

SCHEMA = T.StructType([T.StructField("n", T.LongType()), T.StructField("ds", T.StringType())])


def rows(spark, *values):
    return spark.createDataFrame(list(values), SCHEMA)


def stored(spark, path):
    return sorted(tuple(r) for r in read_table(spark, path, SCHEMA).collect())


def folders(path):
    return sorted(n for n in os.listdir(path) if n.startswith("version="))


def test_full_replacement_and_expiry(spark, tmp_path):
    path = str(tmp_path / "t")
    for k in range(5):
        replace_full(rows(spark, (k, "a"), (k, "b")), path, "ds")
        assert stored(spark, path) == [(k, "a"), (k, "b")]
    assert len(folders(path)) == versions.KEEP and current(spark, path).number == 5
    replace_full(rows(spark), path, "ds")
    assert stored(spark, path) == []


def test_a_reader_keeps_its_version(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_full(rows(spark, (1, "a")), path)
    reader = read_table(spark, path, SCHEMA)
    replace_full(rows(spark, (2, "a")), path)
    assert [r.n for r in reader.collect()] == [1] and stored(spark, path) == [(2, "a")]


@pytest.mark.parametrize("step", ["write_full", "names_in", "_commit", "_expire"])
def test_killed_between_any_two_steps(spark, tmp_path, monkeypatch, step):
    """The process is gone: nothing is tidied up, and the table is the old or the new one, whole."""
    path = str(tmp_path / "t")
    replace_full(rows(spark, (1, "a")), path, "ds")

    class Killed(BaseException):
        pass

    def kill(*args, **kwargs):
        raise Killed

    home = "growthledger.sources.tables" if step in ("write_full", "names_in") else "growthledger.sources.versions"
    with monkeypatch.context() as m:
        m.setattr(f"{home}.{step}", kill)
        # A killed process runs no handlers.
        m.setattr("growthledger.sources.versions.file_system", _no_deletes(versions.file_system))
        with pytest.raises(Killed):
            replace_full(rows(spark, (2, "a"), (2, "b")), path, "ds")
    published = step == "_expire"
    assert stored(spark, path) == ([(2, "a"), (2, "b")] if published else [(1, "a")])
    replace_full(rows(spark, (3, "c")), path, "ds")
    assert stored(spark, path) == [(3, "c")]
    replace_full(rows(spark, (4, "c")), path, "ds")
    assert len(folders(path)) == versions.KEEP


def _no_deletes(file_system):
    class Files:
        def __init__(self, files):
            self.files = files

        def __getattr__(self, name):
            return (lambda *a: True) if name == "delete" else getattr(self.files, name)

    def wrapped(spark, path):
        files, at = file_system(spark, path)
        return Files(files), at

    return wrapped


def test_failed_check_leaves_no_trace(spark, tmp_path):
    path = str(tmp_path / "t")

    def refuse(aside):
        assert read_table(spark, aside, SCHEMA).count() == 1
        raise ValueError("refused")

    for published in (False, True):
        with pytest.raises(ValueError, match="refused"):
            replace_full(rows(spark, (2, "a")), path, "ds", refuse)
        assert os.path.exists(path) == published
        replace_full(rows(spark, (1, "a")), path, "ds")
        assert stored(spark, path) == [(1, "a")]


def test_of_two_overlapping_publications_one_fails(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_full(rows(spark, (1, "a")), path)
    with pytest.raises(ConcurrentPublication):
        replace_full(rows(spark, (2, "a")), path, check=lambda aside: replace_full(rows(spark, (3, "a")), path))
    assert stored(spark, path) == [(3, "a")] and current(spark, path).number == 2


def test_snapshots(spark, tmp_path):
    path = str(tmp_path / "t")
    assert latest_ds(spark, path) is None
    for n, ds in ((1, "2025-06-01"), (2, "2025-06-03"), (3, "2025-06-02"), (4, "2025-06-03")):
        replace_snapshot(rows(spark, (n, ds)), path, ds)
    assert stored(spark, path) == [(1, "2025-06-01"), (3, "2025-06-02"), (4, "2025-06-03")]
    assert latest_ds(spark, path) == "2025-06-03"
    replace_snapshot(rows(spark), path, "2025-06-03")
    assert read_latest(spark, path, SCHEMA).count() == 0 and len(stored(spark, path)) == 2


def test_days_grow_without_touching_files(spark, tmp_path):
    path = str(tmp_path / "t")
    assert append_days(rows(spark, (1, "a"), (1, "b")), path, {"one": "1"}) == ["a", "b"]
    before = set(read_table(spark, path, SCHEMA).inputFiles())
    assert append_days(rows(spark, (2, "b"), (2, "c")), path, {"two": "2"}) == ["b", "c"]
    assert before < set(read_table(spark, path, SCHEMA).inputFiles())
    assert stored(spark, path) == [(1, "a"), (1, "b"), (2, "b"), (2, "c")]
    assert current(spark, path).loaded == {"one": "1", "two": "2"}
    for _ in range(versions.KEEP + 1):
        append_days(rows(spark), path, {})
    assert len(stored(spark, path)) == 4


def test_tables_of_before_are_read_until_they_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    write_full(rows(spark, (1, "a")), path, "ds")
    assert stored(spark, path) == [(1, "a")]
    replace_full(rows(spark, (2, "b")), path, "ds")
    assert stored(spark, path) == [(2, "b")]
    manifest = json.load(open(f"{path}/_manifests/00000001.json"))
    assert list(manifest["folders"]) == ["ds=b"]


def test_days_prune(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_full(rows(spark, (1, "a"), (2, "b")), path, "ds")
    found = read_table(spark, path, SCHEMA).where(F.col("ds") == "b")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ds" in plan and [r.n for r in found.collect()] == [2]
