import os

import pytest
from helpers import TESTDATA
from helpers import GOOD, staging

from pyspark.sql import functions as F
from pyspark.sql import types as T

from growthledger.__main__ import main
from growthledger.plans import pipeline, reports
from growthledger.plans.active import active_users
from growthledger.plans.lifecycle import lifecycle_weekly
from growthledger.plans.pipeline import Warehouse, run_pipeline, run_sql
from growthledger.plans.retention import retention
from growthledger.quality.gate import DataQualityError
from growthledger.sources.tables import latest_ds, read_latest, replace_snapshot
from growthledger.sources.adapters import EVENTS_AS_OF, EVENTS_START_DS, as_staging, events_stream


def write_csv(df, path):
    df.coalesce(1).write.mode("overwrite").options(header=True, escape='"').csv(str(path))
    return str(path)


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    return write_csv(as_staging(events_stream(spark, f"{TESTDATA}/sf0.001")), tmp_path_factory.mktemp("raw") / "csv")


@pytest.fixture(scope="module")
def wh(spark, raw, tmp_path_factory):
    return run_pipeline(spark, raw, str(tmp_path_factory.mktemp("wh")), EVENTS_AS_OF, EVENTS_START_DS)


def same(left, right):
    return left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0


def test_all_tables_are_built(wh):
    for table, schema in pipeline.SCHEMAS.items():
        df = wh.read(table)
        assert df.columns == schema.names
        assert df.count() > 0, table
    assert wh.read("fct_event_stream").count() == wh.read("stg_event_stream").count()
    assert not os.path.exists(wh.audit_path)


def test_metrics_equal_the_direct_queries(wh):
    events, users = wh.read("fct_events"), wh.latest_users()
    args = (EVENTS_START_DS, EVENTS_AS_OF)
    assert same(wh.read("agg_active_user"), active_users(events, users, *args))
    assert same(wh.read("agg_user_lifecycle_weekly"), lifecycle_weekly(events, users, *args))
    assert same(wh.read("agg_user_retention"), retention(events, *args))


def test_tables_are_visible_to_sql(wh):
    wh.register_views()
    sql = "SELECT period_type, sum(active_user_count) AS n FROM agg_active_user GROUP BY 1 ORDER BY 1"
    result = run_sql(wh.spark, sql, "counted").collect()
    assert [r.period_type for r in result] == ["daily", "monthly", "weekly"]


def test_ds_stays_text_and_prunes(wh):
    events = wh.read("fct_events").where("ds >= '2024-01-20'").select("event_id")
    plan = events._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ds" in plan and "ReadSchema: struct<event_id:string>" in plan
    assert dict(wh.read("fct_events").dtypes)["ds"] == "string"


def test_snapshots_keep_history_and_rebuild_replaces_one(spark, raw, tmp_path):
    wh = run_pipeline(spark, raw, str(tmp_path), "2024-01-30", EVENTS_START_DS)
    before = wh.read("agg_user_retention").count()
    pipeline.build_dim_users(wh, "2024-01-31")
    pipeline.build_dim_users(wh, "2024-01-31")
    pipeline.build_agg_user_retention(wh, EVENTS_START_DS, "2024-01-31")
    assert [r.ds for r in wh.read("dim_users").select("ds").distinct().orderBy("ds").collect()] == [
        "2024-01-30", "2024-01-31",
    ]
    assert {r.ds for r in wh.latest_users().select("ds").distinct().collect()} == {"2024-01-31"}
    users = wh.read("dim_users")
    assert users.groupBy("user_id", "ds").count().where("count > 1").count() == 0
    assert wh.read("agg_user_retention").count() == 2 * before


def test_single_steps_equal_the_whole_run(spark, wh, raw, tmp_path):
    root = str(tmp_path)
    dates = ["--as-of", EVENTS_AS_OF, "--start-ds", EVENTS_START_DS]
    main(["ingest", "--root", root, "--csv", raw])
    for step in ("dim_users", "fct_events", "agg_active_user", "agg_user_lifecycle_weekly", "agg_user_retention"):
        main([step, "--root", root, *dates])
    steps = Warehouse(spark, root)
    for table in pipeline.SCHEMAS:
        assert same(steps.read(table), wh.read(table)), table


def test_failed_fact_check_blocks_publication_and_keeps_the_rows(spark, tmp_path):
    root = str(tmp_path / "wh")
    raw = write_csv(staging(spark, {}, {}, {"user_id": "u_0002"}), tmp_path / "csv")
    with pytest.raises(DataQualityError) as error:
        run_pipeline(spark, raw, root, "2025-06-03")
    assert error.value.table == "fct_events" and error.value.failed == {"unique_event_id": 1}
    wh = Warehouse(spark, root)
    assert spark.read.parquet(f"{wh.audit_path}/fct_events/unique_event_id").count() == 1
    assert wh.read("dim_users").count() == 2
    assert not os.path.exists(wh.path("fct_events")) and not os.path.exists(wh.path("agg_active_user"))


def test_users_with_several_sources_block_the_dimension(spark, tmp_path):
    root = str(tmp_path / "wh")
    raw = write_csv(staging(spark, {}, {"utm_source": "tiktok"}), tmp_path / "csv")
    with pytest.raises(DataQualityError, match="single_attribute_per_user: 1"):
        run_pipeline(spark, raw, root, "2025-06-03")
    assert not os.path.exists(f"{root}/dim_users")


def test_failed_rebuild_leaves_the_published_snapshot(spark, wh, monkeypatch, tmp_path):
    root = str(tmp_path / "wh")
    raw = write_csv(staging(spark, GOOD), tmp_path / "csv")
    built = run_pipeline(spark, raw, root, "2025-06-03")
    before = built.read("agg_user_retention").collect()

    def worse(events, start_ds, as_of):
        return retention(events, start_ds, as_of).selectExpr(
            "cohort_week", "week_offset", "retained_users", "cohort_size",
            "CAST(101 AS DECIMAL(5,2)) AS retention_rate", "ds",
        )

    monkeypatch.setattr(pipeline, "retention", worse)
    with pytest.raises(DataQualityError):
        pipeline.build_agg_user_retention(built, "2025-01-01", "2025-06-03")
    assert built.read("agg_user_retention").collect() == before


def test_a_check_the_source_is_known_to_fail_reports_and_goes_on(spark, tmp_path):
    root = str(tmp_path / "wh")
    raw = write_csv(staging(spark, {}, {"user_id": "u_0002", "miles_amount": "0.00"}), tmp_path / "csv")
    with pytest.raises(DataQualityError, match="miles_positive: 1"):
        run_pipeline(spark, raw, root, "2025-06-03")
    wh = run_pipeline(spark, raw, root, "2025-06-03", warn={"fct_events.expression_miles_positive"})
    assert wh.read("fct_events").count() == 2 and wh.latest("agg_active_user").count() > 0
    kept = spark.read.parquet(f"{wh.audit_path}/fct_events/expression_miles_positive")
    assert [r.user_id for r in kept.collect()] == ["u_0002"]
    # Any other check stops as before.
    again = write_csv(staging(spark, {}, {}, {"user_id": "u_0002", "miles_amount": "0.00"}), tmp_path / "again")
    with pytest.raises(DataQualityError) as error:
        run_pipeline(spark, again, root, "2025-06-03", warn={"fct_events.expression_miles_positive"})
    assert error.value.failed == {"unique_event_id": 1}


def files(path):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(path) for f in names)


def test_a_failed_load_leaves_all_tables_whole(spark, tmp_path):
    root = str(tmp_path / "wh")
    built = run_pipeline(spark, write_csv(staging(spark, {}, {"user_id": "u_0002"}), tmp_path / "good"), root, "2025-06-03")
    before = files(root)
    header, line = ",".join(GOOD), ",".join(GOOD.values())
    long = tmp_path / "long.csv"
    long.write_text(f"{header}\n{line}\n{line},more\n")
    with pytest.raises(Exception, match="more than 8 fields"):
        pipeline.ingest(built, str(long))
    with pytest.raises(DataQualityError):
        pipeline.ingest(built, write_csv(staging(spark, {"platform": "tv"}), tmp_path / "tv"))
    assert files(root) == before
    # A cast that fails after the checks have passed: staging is new, the stream is the old one.
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        pipeline.ingest(built, write_csv(staging(spark, {"miles_amount": "123456789.00"}), tmp_path / "cast"))
    stream = f"{root}/fct_event_stream"
    assert files(stream) == [f for f in before if f.startswith(stream)]


def test_a_failed_fact_write_leaves_the_fact(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "wh")
    built = run_pipeline(spark, write_csv(staging(spark, {}), tmp_path / "csv"), root, "2025-06-03")
    before = files(root)

    def broken(stream):
        return pipeline_fact(stream).withColumn("event_type", F.raise_error(F.lit("broken")).cast("string"))

    pipeline_fact = pipeline.fct_events
    monkeypatch.setattr(pipeline, "fct_events", broken)
    with pytest.raises(Exception, match="broken"):
        pipeline.build_fct_events(built)
    assert files(root) == before


def test_an_empty_rebuild_empties_its_snapshot_only(spark, tmp_path):
    root = str(tmp_path / "wh")
    built = run_pipeline(spark, write_csv(staging(spark, {}), tmp_path / "csv"), root, "2025-06-03")
    pipeline.build_agg_active_user(built, as_of="2025-06-04")
    pipeline.build_agg_active_user(built, "2026-01-01", "2025-06-03")
    assert {r.ds for r in built.read("agg_active_user").collect()} == {"2025-06-04"}
    pipeline.build_agg_active_user(built, "2026-01-01", "2025-06-04")
    assert built.latest("agg_active_user").count() == 0 == built.read("agg_active_user").count()


def test_reports_look_at_one_snapshot(spark, tmp_path):
    root = str(tmp_path / "wh")
    rows = staging(spark, {}, {"user_id": "u_0002"}, {"event_time": "2025-06-09 10:00:00.000000"})
    built = run_pipeline(spark, write_csv(rows, tmp_path / "csv"), root, "2025-06-10")
    pipeline.build_dim_users(built, "2025-06-11")
    pipeline.build_metrics(built, as_of="2025-06-11")
    for read in (built.latest, built.read):
        weekly = reports.active_by_segment(read("agg_active_user"), "weekly").collect()
        assert [r.active_user_count for r in weekly] == [2, 1]
        assert [r.new for r in reports.lifecycle_by_week(read("agg_user_lifecycle_weekly")).collect()] == [2, 0]
        triangle = reports.retention_triangle(read("agg_user_retention")).collect()
        assert [(r.cohort_size, float(r.w1)) for r in triangle] == [(2, 50.0)]
    one = reports.active_by_segment(built.read("agg_active_user"), "weekly", ds="2025-06-10").collect()
    assert [r.active_user_count for r in one] == [2, 1]


def test_latest_snapshot_reads_one_partition(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    users = spark.range(3).selectExpr("CAST(id AS STRING) AS user_id")
    schema = "user_id string, ds string"
    for ds in ("2025-06-01", "2025-06-03", "2025-06-02"):
        replace_snapshot(users.selectExpr("user_id", f"'{ds}' AS ds"), wh.path("dim_users"), ds)
    assert latest_ds(spark, wh.path("dim_users")) == "2025-06-03"
    found = read_latest(spark, wh.path("dim_users"), T._parse_datatype_string(schema))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "[max(" not in plan
    assert found.inputFiles() and all("/ds=2025-06-03/" in f for f in found.inputFiles())
    assert len(found.inputFiles()) > 0 and {r.ds for r in found.collect()} == {"2025-06-03"}


def test_a_good_run_clears_the_audit(spark, tmp_path):
    root = str(tmp_path / "wh")
    with pytest.raises(DataQualityError):
        run_pipeline(spark, write_csv(staging(spark, {}, {}), tmp_path / "bad"), root, "2025-06-03")
    assert os.path.exists(f"{root}/audit/fct_events/unique_event_id")
    run_pipeline(spark, write_csv(staging(spark, {}), tmp_path / "good"), root, "2025-06-03")
    assert not os.path.exists(f"{root}/audit/fct_events/unique_event_id")
    assert not [f for f in files(root) if "/_new-" in f or "/_old-" in f]
