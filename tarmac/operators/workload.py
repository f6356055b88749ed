"""Crew workload: one row per crew member who has at least one disruption event."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions.time import timestamp_lit


def crew_workload(crew: DataFrame, events: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """Totals over all events of a crew member, resolved ones included.

    Every aggregate can be combined in parts, so events are summed per crew id first: a crew id with very
    many events reaches the shuffle as one row per task. ``crew_id`` is unique in ``crew``, therefore
    the join adds attributes only.
    """
    totals = events.groupBy("crew_id").agg(
        F.count("disruption_id").alias("disruption_count"),
        F.sum(F.when(F.col("severity") == "CRITICAL", 1).otherwise(0)).alias("critical_disruptions"),
        F.coalesce(F.sum("estimated_delay_mins"), F.lit(0)).alias("total_delay_mins"),
        F.coalesce(F.sum("cost_estimate"), F.lit(0)).cast("decimal(20,2)").alias("total_cost_estimate"),
        F.max("reported_at").alias("last_disruption_at"),
    )
    return crew.join(totals, "crew_id").select(
        "crew_id",
        "employee_id",
        F.col("full_name").alias("crew_name"),
        F.col("role").alias("crew_role"),
        "base_airport",
        "hours_on_duty",
        "max_duty_hours",
        (F.col("max_duty_hours") - F.col("hours_on_duty")).alias("hours_remaining"),
        "disruption_count",
        "critical_disruptions",
        "total_delay_mins",
        "total_cost_estimate",
        "last_disruption_at",
        timestamp_lit(run_ts).alias("refreshed_at"),
    )


def workload_report(workload: DataFrame) -> DataFrame:
    """Most expensive crew first; equal costs are ordered by crew id."""
    return workload.orderBy(F.desc("total_cost_estimate"), "crew_id")
