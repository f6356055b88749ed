"""Spark session settings and the folders jobs may write intermediate data to."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # larger generated methods are not compiled by the JVM; the split form is faster
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # do not inspect the Python stack for every expression that is built
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app_name: str = "tarmac", **settings: str) -> SparkSession:
    """Create (or get) a session with the settings the jobs are written for.

    Keyword settings use ``__`` for dots, e.g. ``spark__sql__shuffle__partitions="8"``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach: ``spark.checkpoint.dir`` of the session, or the folder given to
    ``setCheckpointDir``. Where neither is set, a folder below the warehouse, which is shared as well.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
    if context_dir.isDefined():
        return context_dir.get()
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name below the shared folder, unique for every call."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to a new folder below the shared folder, and read from there.

    Computes them once for several readers, ends the growth of the plan, survives lost executors, and lets
    the planner see the real size.
    """
    place = scratch_path(df.sparkSession, label)
    df.write.parquet(place)
    kept = df.sparkSession.read.schema(df.schema).parquet(place)
    kept.scratch_place = place
    return kept


def remove_path(spark: SparkSession, place: str) -> None:
    """Delete a folder through Spark's own file systems."""
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def discard(df: DataFrame) -> None:
    """Delete what ``stored`` wrote, once nothing reads it any more."""
    remove_path(df.sparkSession, df.scratch_place)
