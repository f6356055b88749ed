"""Pair START and COMPLETE of a run as the events arrive, and tell runs that never complete."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tarmac.functions.time import seconds_between

#: State on local disk instead of in executor memory. A batch writes its changes to the checkpoint, not files of the whole
#: state; rows of state are not counted, which would look up every key before it is written.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


def _half(flat_events: DataFrame, event_type: str, prefix: str, lateness: str) -> DataFrame:
    return (
        flat_events.filter(F.col("event_type") == event_type)
        .select(F.col("run_id").alias(f"{prefix}_run"), F.col("event_time").cast("timestamp").alias(f"{prefix}_at"))
        .withWatermark(f"{prefix}_at", lateness)
        .dropDuplicatesWithinWatermark([f"{prefix}_run"])
    )


def _joined(flat_events: DataFrame, within: str, lateness: str, how: str) -> DataFrame:
    starts, completes = (_half(flat_events, kind, kind.lower(), lateness) for kind in ("START", "COMPLETE"))
    in_bound = F.expr(f"complete_at >= start_at AND complete_at <= start_at + INTERVAL {within}")
    started, completed = (F.col(c).cast("timestamp_ntz") for c in ("start_at", "complete_at"))
    return starts.join(completes, (F.col("start_run") == F.col("complete_run")) & in_bound, how).select(
        F.coalesce("start_run", "complete_run").alias("run_id"),
        started.alias("start_time"),
        completed.alias("complete_time"),
        seconds_between(started, completed).alias("duration_secs"),
    )


def pair_runs(flat_events: DataFrame, *, within: str = "1 hour", lateness: str = "1 hour") -> DataFrame:
    """Runs whose COMPLETE follows its START within a bound.

    ``flat_events`` has run_id, event_type and event_time (see ``lineage_runs.flatten_events``). Repeated
    deliveries are dropped. Events later than ``lateness`` may be ignored; the two bounds limit the
    state that is kept.
    """
    return _joined(flat_events, within, lateness, "inner")


def pair_or_release(flat_events: DataFrame, *, within: str = "1 hour", lateness: str = "1 hour") -> DataFrame:
    """Like ``pair_runs``, and each half that found no partner, once the watermark says that none can come.

    A half is released when events have been seen that lie ``lateness`` after its bound; until then it is neither paired nor
    released. Released halves have a NULL time on the other side.
    """
    return _joined(flat_events, within, lateness, "full_outer")


def run_states(released: DataFrame) -> DataFrame:
    """One row per run of what ``pair_or_release`` wrote, with its state.

    ``paired``; ``late`` where both halves came but not within the bound; ``never completed`` and ``no start`` where one
    half did not come, or too late to be looked at.
    """
    per_run = released.groupBy("run_id").agg(
        F.min("start_time").alias("start_time"),
        F.max("complete_time").alias("complete_time"),
        F.count("duration_secs").alias("n_paired"),
    )
    state = (
        F.when(F.col("n_paired") > 0, F.lit("paired"))
        .when(F.col("complete_time").isNull(), F.lit("never completed"))
        .when(F.col("start_time").isNull(), F.lit("no start"))
        .otherwise(F.lit("late"))
    )
    return per_run.select(
        "run_id",
        "start_time",
        "complete_time",
        seconds_between(F.col("start_time"), F.col("complete_time")).alias("duration_secs"),
        state.alias("state"),
    )


def write_available(pairs: DataFrame, output: str, state: str) -> StreamingQuery:
    """Process what is there, append it to parquet files and stop. Restarts continue from ``state``.

    The state store of a folder is fixed by its first start; new ones use ``STATE_STORE``.
    """
    conf = pairs.sparkSession.conf
    before = {key: conf.get(key, None) for key in STATE_STORE}
    for key, value in STATE_STORE.items():
        conf.set(key, value)
    try:
        query = (
            pairs.writeStream.format("parquet")
            .outputMode("append")
            .option("path", output)
            .option("checkpointLocation", state)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        for key, value in before.items():
            conf.unset(key) if value is None else conf.set(key, value)
    query.awaitTermination()
    return query
