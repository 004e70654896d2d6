"""Session settings every job relies on, and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "tidemart", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC days, AQE and skew-join splitting. Cluster sizing stays with the caller's conf."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Settings needed on any session, whoever built it: UTC days, and folder listings in as many
    tasks as the cluster can run at once instead of one task per folder."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    listing = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    if spark.conf.get(listing) == "10000":  # Spark's default
        spark.conf.set(listing, str(min(10_000, 2 * spark.sparkContext.defaultParallelism)))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir`` where set, a temp folder in local mode only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="tidemart-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch(spark: SparkSession, purpose: str) -> str:
    """A new, unused folder name under the shared folder."""
    return f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"
