"""Folders of earlier loads that no table uses any more."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.session import remove_path
from tarmac.sinks.tables import JOURNAL


def _folders(spark: SparkSession, location: str) -> list[tuple[str, dt.datetime]]:
    """(folder, time of last change) of the folders of loads: one for each load, not for each partition or file."""
    place = spark._jvm.org.apache.hadoop.fs.Path(location)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    found = files.listStatus(place) if files.exists(place) else []
    return [
        (s.getPath().toUri().getPath(), dt.datetime.fromtimestamp(s.getModificationTime() / 1000, dt.timezone.utc).replace(tzinfo=None))
        for s in found
        if s.isDirectory() and JOURNAL not in s.getPath().getName()
    ]


def _locations(spark: SparkSession, name: str) -> DataFrame:
    """The folders that a table and its partitions point at in the catalog."""
    catalog = spark._jsparkSession.sessionState().catalog()
    identifier = spark._jsparkSession.sessionState().sqlParser().parseTableIdentifier(name)
    table = catalog.getTableMetadata(identifier)
    uris = [table.location()]
    if table.partitionColumnNames().nonEmpty():
        none = spark._jvm.scala.Option.empty()
        parts = spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(catalog.listPartitions(identifier, none))
        uris += [p.location() for p in parts]
    return spark.createDataFrame([(u.getPath(),) for u in uris], "place string")


def unused_folders(spark: SparkSession, tables: Sequence[str], location: str, now: dt.datetime, grace: dt.timedelta) -> DataFrame:
    """(folder, changed_at): folders directly below ``location`` that no table or partition points into, unchanged for ``grace``.

    ``tables`` must name every table that keeps data there. The grace period covers readers that still use an
    old folder, and loads that have written one but not switched to it yet.
    """
    folders = spark.createDataFrame(_folders(spark, location), "folder string, changed_at timestamp_ntz")
    used = spark.createDataFrame([], "place string")
    for name in tables:
        used = used.unionByName(_locations(spark, name))
    root = spark._jvm.org.apache.hadoop.fs.Path(location).toUri().getPath().rstrip("/")
    # the part of a location that lies directly below the root
    top = F.concat(F.lit(root + "/"), F.substring_index(F.substring("place", len(root) + 2, 10_000), "/", 1))
    in_use = used.filter(F.startswith("place", F.lit(root + "/"))).select(top.alias("folder")).distinct()
    old = folders.filter(F.col("changed_at") <= F.lit(now - grace).cast("timestamp_ntz"))
    return old.join(in_use, "folder", "left_anti")


def remove_unused(spark: SparkSession, tables: Sequence[str], location: str, now: dt.datetime, grace: dt.timedelta) -> list[str]:
    """Delete what ``unused_folders`` lists; the folders' names."""
    found = sorted(r.folder for r in unused_folders(spark, tables, location, now, grace).collect())
    for folder in found:
        remove_path(spark, folder)
    return found
