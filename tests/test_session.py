from growthledger.session import DEFAULTS, apply_defaults, checkpoint_dir, work_path


def test_the_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert checkpoint_dir(spark) == named
    path = work_path(spark, "/data/a", "dim_users")
    assert path.startswith(named) and path == work_path(spark, "/data/a", "dim_users")
    assert path != work_path(spark, "/data/b", "dim_users")


def test_defaults_are_applied(spark):
    apply_defaults(spark)
    assert {key: spark.conf.get(key) for key in DEFAULTS} == DEFAULTS
