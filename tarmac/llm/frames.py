"""Small helpers shared by the operators: tables, unused column names, checked broadcasts."""

from __future__ import annotations

import functools
import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is only hinted for broadcast after its rows were counted and found to be at most this many.
BROADCAST_ROWS = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of the frame is called so (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint for a side of at most ``limit`` rows; larger sides are joined as Spark decides."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def on_workers(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query, after Python workers were told where this package lies, for drivers started in another folder.

    On a cluster the package is installed or sent with the job, then this changes nothing.
    """

    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root, known = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
        paths = known.get("PYTHONPATH", os.environ.get("PYTHONPATH", ""))
        if root not in paths.split(os.pathsep):
            known["PYTHONPATH"] = os.pathsep.join(p for p in (root, paths) if p)
        return query(spark, sf_dir)

    return run
