"""Incremental loads against one full load."""

import os

import pytest
from helpers import staging

from growthledger.plans import pipeline
from growthledger.plans.incremental import add_new_facts, load_new_files
from growthledger.plans.pipeline import Warehouse
from growthledger.quality.gate import DataQualityError
from growthledger.sources.versions import current


def csv_file(df, folder):
    df.coalesce(1).write.options(header=True, escape='"').csv(str(folder))
    return next(f"{folder}/{n}" for n in os.listdir(folder) if n.endswith(".csv"))


def batch(spark, *events):
    """(user, day, hour) of each event."""
    return staging(spark, *[{"user_id": f"u_{u:04d}", "event_time": f"2025-06-{d:02d} {h:02d}:00:00.000000"} for u, d, h in events])


BATCHES = [[(1, 1, 9), (2, 1, 9), (1, 2, 9)], [(1, 3, 9), (2, 2, 10)], [(3, 1, 11), (3, 3, 11), (3, 9, 11)]]


def same(left, right):
    return left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0


def test_three_batches_equal_one_load(spark, tmp_path):
    files = [csv_file(batch(spark, *b), tmp_path / f"raw{k}") for k, b in enumerate(BATCHES)]
    steps, whole = Warehouse(spark, str(tmp_path / "steps")), Warehouse(spark, str(tmp_path / "whole"))
    pipeline.ingest(whole, files)
    pipeline.build_fct_events(whole)
    touched, seen = [], set()
    for k in range(3):
        touched.append(load_new_files(steps, files[: k + 1]))
        assert add_new_facts(steps) == touched[-1]
        assert seen <= set(steps.read("fct_events").inputFiles())  # nothing is rewritten
        seen = set(steps.read("fct_events").inputFiles())
    assert touched == [["2025-06-01", "2025-06-02"], ["2025-06-02", "2025-06-03"], ["2025-06-01", "2025-06-03", "2025-06-09"]]
    for table in ("fct_event_stream", "fct_events"):
        assert same(steps.read(table), whole.read(table)), table
    assert load_new_files(steps, files) == [] and add_new_facts(steps) == []
    pipeline.build_dim_users(steps, "2025-06-10")
    pipeline.build_dim_users(whole, "2025-06-10")
    assert same(steps.read("dim_users"), whole.read("dim_users"))


def test_a_load_that_stops_is_run_again(spark, tmp_path, monkeypatch):
    files = [csv_file(batch(spark, *b), tmp_path / f"raw{k}") for k, b in enumerate(BATCHES)]
    wh = Warehouse(spark, str(tmp_path / "wh"))
    load_new_files(wh, files[:1])
    add_new_facts(wh)
    with monkeypatch.context() as m:
        m.setattr("growthledger.sources.versions._commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            load_new_files(wh, files[:2])
    assert wh.read("fct_event_stream").count() == 3
    load_new_files(wh, files)  # the second and third at once
    with monkeypatch.context() as m:
        m.setattr("growthledger.sources.versions._commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            add_new_facts(wh)
    assert wh.read("fct_events").count() == 3
    add_new_facts(wh)
    assert wh.read("fct_events").count() == wh.read("fct_event_stream").count() == 8


def test_bad_files_are_not_loaded(spark, tmp_path):
    good, again = (csv_file(batch(spark, *BATCHES[0]), tmp_path / f"raw{k}") for k in range(2))
    bad = csv_file(staging(spark, {"platform": "tv"}), tmp_path / "bad")
    wh = Warehouse(spark, str(tmp_path / "wh"))
    load_new_files(wh, [good])
    add_new_facts(wh)
    with pytest.raises(DataQualityError, match="accepted_values_platform: 1"):
        load_new_files(wh, [good, bad])
    assert list(current(spark, wh.path("fct_event_stream")).loaded) == [good]
    # The same events in another file: the key is checked over the whole days.
    load_new_files(wh, [again])
    with pytest.raises(DataQualityError, match="unique_event_id: 3"):
        add_new_facts(wh)
    assert wh.read("fct_events").count() == 3
    assert spark.read.parquet(f"{wh.audit_path}/fct_events/unique_event_id").count() == 3


def test_a_changed_file_and_a_replaced_stream_are_errors(spark, tmp_path):
    file = str(tmp_path / "plain.csv")
    with open(csv_file(batch(spark, *BATCHES[0]), tmp_path / "raw")) as raw, open(file, "w") as out:
        out.write(raw.read())
    wh = Warehouse(spark, str(tmp_path / "wh"))
    load_new_files(wh, [file])
    add_new_facts(wh)
    with open(file, "a") as out:
        out.write("\n")
    with pytest.raises(ValueError, match="have changed"):
        load_new_files(wh, [file])
    pipeline.ingest(wh, file)
    with pytest.raises(ValueError, match="build it as a whole"):
        add_new_facts(wh)
    pipeline.build_fct_events(wh)
    assert wh.read("fct_events").count() == 3
