"""Reading tables, and building them from literal rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.operators.conform import apply_defaults, conform
from tarmac.schemas import Table


def read_table(spark: SparkSession, table: Table, path: str) -> DataFrame:
    """Scan a parquet table with its declared schema; nothing is inferred."""
    return spark.read.schema(table.schema).parquet(path)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    properties: dict[str, str] | None = None,
    split_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
) -> DataFrame:
    """Read a table of a database connection, split into parallel ranges of a numeric column.

    The bounds only place the range limits, rows outside them are still read. Needs the driver jar of
    the database on the session's class path.
    """
    options = {"url": url, "dbtable": table, **(properties or {})}
    if split_column and bounds:
        options |= {
            "partitionColumn": split_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return spark.read.format("jdbc").options(**options).load()


def literal_rows(
    spark: SparkSession,
    table: Table,
    columns: Sequence[str],
    rows: Sequence[Sequence[Any]],
    run_ts: dt.datetime,
    id_column: str | None = None,
) -> DataFrame:
    """A table from written-out rows. Omitted columns take their defaults.

    ``id_column`` is numbered 1, 2, … in the order of the rows. Values may be given as text.
    """
    names = list(columns)
    if id_column:
        names = [id_column, *names]
        rows = [(position, *row) for position, row in enumerate(rows, start=1)]
    as_text = [tuple(v if v is None or isinstance(v, (list, bool)) else str(v) for v in row) for row in rows]
    kinds = {c: "array<string>" if table[c].type.startswith("array") else "string" for c in names}
    raw = spark.createDataFrame(as_text, ", ".join(f"`{c}` {kind}" for c, kind in kinds.items()))
    typed = raw.select(*[F.col(c).cast(table[c].type).alias(c) for c in names])
    return conform(apply_defaults(typed, table, run_ts), table)
