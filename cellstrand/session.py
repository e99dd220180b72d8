"""Session with the settings that the engine relies on, and its folders on shared storage."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def session(app: str = "cellstrand", master: str | None = None, **settings: str) -> SparkSession:
    """UTC times, adaptive execution with skew joins, and filters pushed into the Python sources."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    own = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        PUSHDOWN: "true",
    }
    for key, value in {**own, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pushes(spark: SparkSession) -> str:
    """Whether the session lets Python sources take filters over; one that does not, as is Spark's default, refuses readers that would."""
    return spark.conf.get(PUSHDOWN, "false").lower()


def qualified(spark: SparkSession, path: str) -> str:
    """A path with the scheme that Spark's file systems give it, so that tasks, the driver and Spark's own writers mean the same place."""
    own = spark._jvm.org.apache.hadoop.fs.Path(path)
    return own.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(own).toString()


def _shared_root(spark: SparkSession) -> str:
    """The application's folder below the cluster's shared checkpoint folder, with the scheme that Spark's file systems give it.

    Only where the session has none and runs on one machine (tests) is a folder below the warehouse used instead.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: a cluster needs a folder that all its machines share")
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"
    return qualified(spark, f"{base.rstrip('/')}/cellstrand-{spark.sparkContext.applicationId}")


def shared_dir(spark: SparkSession, what: str) -> str:
    """A fresh folder on shared storage; executors and Spark's readers find it by the same URL."""
    return f"{_shared_root(spark)}/{what}-{uuid.uuid4().hex}"


def sweep(spark: SparkSession) -> None:
    """Delete all that the operators kept for this application; to be called when their results are written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_shared_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
