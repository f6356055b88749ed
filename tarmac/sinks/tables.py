"""Loads into catalog tables stored as parquet.

A refresh or upsert writes a new folder and then points the table (or the partition) at it in the catalog; an append
adds files to the folder in use. With the former, readers see the old rows or the new ones, never an empty or half-written table, and a load that fails
leaves the table as it was. One writer per table is assumed. Old folders stay, since readers may still use them, until
``retention.remove_unused`` takes them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tarmac.operators.conform import conform
from tarmac.operators.constraints import require_unique
from tarmac.operators.merge import upsert_rows
from tarmac.schemas import Table, sql_literal
from tarmac.sinks.journal import Journal


#: Part of the name of a journal's folder.
JOURNAL = "-journal-"


def ensure_table(spark: SparkSession, table: Table, name: str, location: str) -> None:
    """Create the table if it is missing; add columns it lacks, older rows show their default."""
    partitioned = f" PARTITIONED BY ({', '.join(table.partition_by)})" if table.partition_by else ""
    if table.bucket_by:
        partitioned += f" CLUSTERED BY ({', '.join(table.bucket_by)}) INTO {table.buckets} BUCKETS"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({table.ddl()}) USING parquet{partitioned} "
        f"LOCATION '{_folder(location, name, 'first')}'"
    )
    present = spark.table(name).columns
    for column in table.columns:
        if column.name not in present:
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS (`{column.name}` {column.type}{column.default_clause})")


def _folder(location: str, name: str, version: str) -> str:
    return f"{location.rstrip('/')}/{name.replace('.', '_')}-{version}"


def _new_folder(location: str, name: str) -> str:
    return _folder(location, name, uuid.uuid4().hex)


def append(df: DataFrame, table: Table, name: str) -> None:
    """INSERT of rows, whose columns may come in any order, into the folder in use; earlier files stay as they are."""
    conform(df, table).write.insertInto(name)


def full_refresh(df: DataFrame, table: Table, name: str, location: str) -> str:
    """Replace all rows of an unpartitioned table in one step; returns the folder now in use."""
    spark = df.sparkSession
    ensure_table(spark, table, name, location)
    folder = _new_folder(location, name)
    conform(df, table).write.parquet(folder)
    rows = spark.read.schema(table.schema).parquet(folder)
    for key in table.unique:
        require_unique(rows, list(key), name)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
    spark.catalog.refreshTable(name)
    return folder


def upsert(
    source: DataFrame,
    table: Table,
    name: str,
    location: str,
    keys: Sequence[str],
    updates: Sequence[str],
    id_column: str,
) -> None:
    """Insert rows, or update some columns where the key exists, in a table with one partition column.

    Only the partitions that occur in the source are read and rewritten; rows of theirs without a new
    version stay. A table in buckets of a key is not shuffled for that. The source is written out once, because several steps read
    it, and in the table's buckets, so that it is shuffled once for all of them. A key that occurs twice in the source ends the load.

    Partitions switch one after the other. What is to be switched is written down first, with the last generated id; if the load dies
    in between, the next one (or ``finish_upsert``) switches the rest before it does anything else.
    """
    spark = source.sparkSession
    ensure_table(spark, table, name, location)
    finish_upsert(spark, name, location)
    (part,) = table.partition_by
    folder = _new_folder(location, name)

    with _staged(source, name, f"{folder}-source", _layout(spark, name, keys)) as staged:
        # one value per partition that is rewritten; the catalog calls below need them by name
        values = [row[0] for row in staged.select(part).distinct().collect()]
        current = spark.table(name).select(*table.names)
        journal = _journal(spark, name, location)
        before = journal.last()
        last_id = before["last_id"] if before else current.agg(F.max(id_column)).first()[0] or 0
        seen = Observation()
        with _laid_out_by_some_keys(spark):
            target = current.filter(F.col(part).isin(*values))
            merged = upsert_rows(target, staged, list(keys), list(updates), id_column, last_id)
            _write_partitions(conform(merged, table).observe(seen, F.max(id_column).alias("last_id")), name, part, folder)
    intent = {
        "folder": folder,
        "part": part,
        "values": [str(value) for value in values],
        "last_id": max(last_id, seen.get["last_id"] or 0),
    }
    number = journal.begin(intent)
    _switch(spark, name, intent)
    journal.finish(number)


def _metadata(spark: SparkSession, name: str):
    state = spark._jsparkSession.sessionState()
    return state.catalog().getTableMetadata(state.sqlParser().parseTableIdentifier(name))


def _buckets(spark: SparkSession, name: str) -> tuple[int, list[str]] | None:
    """Number and columns of the buckets that the table has in the catalog, if it has some."""
    spec = _metadata(spark, name).bucketSpec()
    if spec.isEmpty():
        return None
    return spec.get().numBuckets(), spec.get().bucketColumnNames().mkString(",").split(",")


def _layout(spark: SparkSession, name: str, keys: Sequence[str]) -> tuple[int, list[str]] | None:
    """The table's buckets, if rows of one key lie in one of them."""
    found = _buckets(spark, name)
    return found if found and set(found[1]) <= set(keys) else None


@contextmanager
def _staged(source: DataFrame, name: str, place: str, layout: tuple[int, list[str]] | None) -> Iterator[DataFrame]:
    """The rows written to ``place``, for a target in buckets dealt into the same ones."""
    spark = source.sparkSession
    if layout is None:
        source.write.parquet(place)
        yield spark.read.parquet(place)
        return
    buckets, columns = layout
    # buckets are known to a table only; it is dropped in the end, its files stay
    staging = f"{name}_{uuid.uuid4().hex}"
    source.repartition(buckets, *columns).write.bucketBy(buckets, *columns).option("path", place).saveAsTable(staging)
    try:
        yield spark.table(staging)
    finally:
        spark.sql(f"DROP TABLE {staging}")


def _write_partitions(rows: DataFrame, name: str, part: str, folder: str) -> None:
    """Write the rows by partition, in the buckets that the table has in the catalog, if it has some."""
    spark, found = rows.sparkSession, _buckets(rows.sparkSession, name)
    if found is None:
        rows.write.partitionBy(part).parquet(folder)
        return
    buckets, columns = found
    # files of buckets are written through a table; it is dropped again, its files stay
    staging = f"{name}_{uuid.uuid4().hex}"
    rows.write.partitionBy(part).bucketBy(buckets, *columns).option("path", folder).saveAsTable(staging)
    spark.sql(f"DROP TABLE {staging}")


@contextmanager
def _laid_out_by_some_keys(spark: SparkSession) -> Iterator[None]:
    """Joins may use a table that is laid out by some of the join keys: a target in buckets stays where it is."""
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _journal(spark: SparkSession, name: str, location: str) -> Journal:
    """The journal of the table as it was created; one that is dropped and created again starts a new one."""
    created = _metadata(spark, name).createTime()
    return Journal(spark, f"{location.rstrip('/')}/{name.replace('.', '_')}{JOURNAL}{created}")


def _switch(spark: SparkSession, name: str, intent: dict) -> None:
    """Point the partitions of an intent at its folder. Doing it again changes nothing."""
    for value in intent["values"]:
        spec = f"PARTITION ({intent['part']} = {sql_literal(value)})"
        place = f"{intent['folder']}/{intent['part']}={value}"
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {spec} LOCATION '{place}'")
        spark.sql(f"ALTER TABLE {name} {spec} SET LOCATION '{place}'")
    spark.catalog.refreshTable(name)


def finish_upsert(spark: SparkSession, name: str, location: str) -> bool:
    """Switch what an upsert that died had still to switch; whether there was such a one."""
    journal = _journal(spark, name, location)
    last = journal.last()
    if last is None or last["done"]:
        return False
    _switch(spark, name, last)
    journal.finish(last["number"])
    return True


def reset(spark: SparkSession, views: Sequence[str], tables: Sequence[str]) -> None:
    """Drop views, then tables, where they exist; safe to run again."""
    for view in views:
        spark.catalog.dropTempView(view)
    for table in tables:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
