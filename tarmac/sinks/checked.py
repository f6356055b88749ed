"""Loads that set broken rows apart instead of ending: one pass writes target, quarantine and metrics."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tarmac.operators.conform import assignment
from tarmac.schemas import Table, sql_literal
from tarmac.sinks.tables import ensure_table


def row_problems(df: DataFrame, table: Table) -> Column:
    """What keeps a row out of the table, as texts: NULL or missing in a required column, no such type, too long."""
    found = []
    for name in table.names:
        for broken, text in assignment(df, table, name)[1]:
            found.append(F.when(broken, F.lit(f"{name} {text}")))
    return F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")


def checked_refresh(df: DataFrame, table: Table, name: str, quarantine: str, location: str) -> dict[str, int]:
    """Replace the rows of two tables: those that fit go to ``name``, the others to ``quarantine``; counts are returned.

    The quarantine has the whole row as JSON and its ``problems``. The source is read once: rows are written to one
    new folder, divided by whether they have problems, and the tables are pointed at its two halves. Counts come from the
    same pass: ``rows``, ``broken``, and one for each problem, by its text. Unique keys are not checked here. A failed load changes nothing.
    """
    spark = df.sparkSession
    ensure_table(spark, table, name, location)
    folder = f"{location.rstrip('/')}/{name.replace('.', '_')}-checked-{uuid.uuid4().hex}"
    judged = df.withColumn("problems", row_problems(df, table))
    broken = F.size("problems") > 0
    texts = [f"{c} {text}" for c in table.names for _, text in assignment(df, table, c)[1]]
    seen = Observation()
    counts = [F.count(F.when(F.array_contains("problems", text), 1)).alias(text) for text in texts]
    observed = judged.observe(seen, F.count(F.lit(1)).alias("rows"), F.count(F.when(broken, 1)).alias("broken"), *counts)
    row = F.when(broken, F.to_json(F.struct(*df.columns))).alias("source_row")
    shaped = [F.when(~broken, assignment(df, table, c)[0]).alias(c) for c in table.names]
    observed.select(*shaped, row, F.when(broken, F.col("problems")).alias("problems"), broken.alias("set_apart")).write.partitionBy("set_apart").parquet(folder)

    for half in ("false", "true"):
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/set_apart={half}")
        place.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(place)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {quarantine} (source_row STRING, problems ARRAY<STRING>) USING parquet "
        f"LOCATION {sql_literal(folder + '/set_apart=true')}"
    )
    for target, half in ((quarantine, "true"), (name, "false")):
        spark.sql(f"ALTER TABLE {target} SET LOCATION {sql_literal(f'{folder}/set_apart={half}')}")
        spark.catalog.refreshTable(target)
    return seen.get
