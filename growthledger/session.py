"""Spark session settings and the shared work folder."""

from __future__ import annotations

import hashlib
import tempfile

from pyspark.sql import SparkSession

# Settings the results or the scale behaviour depend on. Everything else is left
# to the cluster.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}
# Can only be set when the session is built.
STATIC_DEFAULTS = {
    # No Python call sites on columns: they cost a round trip each.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "growthledger", conf: dict[str, str] | None = None) -> SparkSession:
    """Get or create a session with the package defaults, then ``conf`` on top."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**DEFAULTS, **STATIC_DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Put the package defaults on a session built elsewhere."""
    for key, value in DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def require_ansi(spark: SparkSession) -> None:
    """Refuse to run a load whose bad casts would turn into silent nulls."""
    if spark.conf.get("spark.sql.ansi.enabled", "true").lower() != "true":
        raise ValueError("spark.sql.ansi.enabled must be true: a bad cast has to abort the load")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by the cluster in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; on a cluster
    a machine-local folder would not be visible to the executors, so that is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    own = tempfile.mkdtemp(prefix="growthledger-")
    spark.sparkContext.setCheckpointDir(own)
    return own


def work_path(spark: SparkSession, owner: str, label: str) -> str:
    """Path under the shared folder for one intermediate table.

    ``owner`` (the warehouse root or input folder) makes it distinct. The path is the same
    on every run, so a rerun replaces the table instead of leaving another copy.
    """
    tag = hashlib.md5(owner.encode()).hexdigest()[:12]
    return f"{checkpoint_dir(spark).rstrip('/')}/growthledger/{tag}/{label}"
