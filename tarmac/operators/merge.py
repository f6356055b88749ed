"""Keyed merge (insert or update) and generated ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.operators.constraints import require_unique
from tarmac.session import stored

# Rows are numbered inside this many buckets of equal expected size (three hex digits of a digest).
ID_BUCKETS = 4096

# Columns of the daily summary that a repeated load overwrites. The route, the aircraft, the passenger
# count and the id of an existing row stay as first written.
SUMMARY_UPDATES = (
    "flight_status",
    "total_crew_disruptions",
    "critical_count",
    "high_count",
    "medium_count",
    "low_count",
    "total_delay_mins",
    "total_cost_estimate",
    "affected_crew_count",
    "risk_flag",
    "risk_reason",
    "processed_at",
)


def assign_ids(df: DataFrame, keys: list[str], id_column: str, after: Column | int = 0) -> DataFrame:
    """Number the rows ``after + 1, after + 2, …`` without gaps and without sorting them in one task.

    ``keys`` must identify a row. The order is that of the key's digest, so a repeated run gives the same
    ids. Each bucket is numbered on its own; the offsets come from at most ``ID_BUCKETS`` counts. ``df`` is
    read twice, so it should be stored if it is costly.
    """
    key_text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    bucketed = df.withColumn("id_bucket", F.substring(F.md5(key_text), 1, 3))
    counts = bucketed.groupBy("id_bucket").agg(F.count(F.lit(1)).alias("bucket_rows"))
    before = Window.orderBy("id_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "id_bucket", F.coalesce(F.sum("bucket_rows").over(before), F.lit(0)).alias("bucket_offset")
    )
    inside = Window.partitionBy("id_bucket").orderBy(*keys)
    start = F.lit(after) if isinstance(after, int) else after
    return (
        bucketed.withColumn("bucket_position", F.row_number().over(inside))
        .join(F.broadcast(offsets), "id_bucket")
        .withColumn(id_column, start + F.col("bucket_offset") + F.col("bucket_position"))
        .drop("id_bucket", "bucket_position", "bucket_offset")
    )


def merge_rows(target: DataFrame, source: DataFrame, keys: list[str], updates: list[str]) -> DataFrame:
    """Result of inserting ``source`` into ``target``, updating ``updates`` where the key exists.

    Rows of the target without a partner stay. ``source`` must hold each key once (see
    ``constraints.require_unique``). Target columns the source lacks are NULL in new rows.
    """
    left = target.withColumn("in_target", F.lit(True)).alias("t")
    right = source.withColumn("in_source", F.lit(True)).alias("s")
    joined = left.join(right, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys], "full_outer")

    def merged(name: str) -> Column:
        old = F.col(f"t.{name}")
        if name not in source.columns:
            return old.alias(name)
        new = F.col(f"s.{name}")
        if name in updates:
            return F.when(F.col("in_source"), new).otherwise(old).alias(name)
        return F.when(F.col("in_target"), old).otherwise(new).alias(name)

    return joined.select(*[merged(name) for name in target.columns])


def upsert_rows(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    updates: list[str],
    id_column: str,
    after: Column | int,
) -> DataFrame:
    """``merge_rows`` with generated ids: existing rows keep theirs, new rows are numbered after ``after``.

    A key twice in the source ends the load. Ids are given to source rows whose key the target lacks, before the merge, so
    rows of the target are only read: where target and source are laid out by the key, only ids are shuffled. Without that,
    the source is shuffled once, with the ids, for both joins.
    """
    require_unique(source, keys, "source of the merge")
    new = stored(source.select(*keys).join(target.select(*keys), keys, "left_anti"), "new-keys")
    ids = assign_ids(new, keys, id_column, after).select(*keys, F.col(id_column).cast(target.schema[id_column].dataType))
    ids = stored(ids, "ids")
    return merge_rows(target, source.join(ids, keys, "left"), keys, updates)
