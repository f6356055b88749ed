"""The two stacked views over flights, disruption events and crew."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions.risk import CREW_TYPES, IMPACTED_STATUSES, UNAVAILABLE_STATUSES, severity_rank
from tarmac.functions.time import hours_between

# Rows without a crew are spread over this many key values, so that they do not meet in one partition.
NULL_KEY_SPREAD = 1024
#: The crew is only hinted for broadcast after its rows were counted and found to be at most this many.
BROADCAST_ROWS = 500_000


def flight_disruptions(events: DataFrame, flights: DataFrame) -> DataFrame:
    """Every disruption of a known flight, with the flight's attributes and derived flags."""
    event_side = events.select(
        "disruption_id",
        "flight_id",
        "crew_id",
        "disruption_type",
        "severity",
        F.col("description").alias("disruption_description"),
        "estimated_delay_mins",
        "cost_estimate",
        "reported_at",
        "resolved_at",
    )
    flight_side = flights.select(
        "flight_id",
        "flight_number",
        "origin",
        "destination",
        "scheduled_dep",
        "scheduled_arr",
        "aircraft_type",
        F.col("status").alias("flight_status"),
        "passenger_count",
    )
    return event_side.join(flight_side, "flight_id").select(
        "disruption_id",
        "crew_id",
        "disruption_type",
        "severity",
        "disruption_description",
        "estimated_delay_mins",
        "cost_estimate",
        "reported_at",
        "resolved_at",
        F.col("resolved_at").isNull().alias("is_unresolved"),
        severity_rank(F.col("severity")).alias("severity_rank"),
        F.col("disruption_type").isin(*CREW_TYPES).alias("is_crew_disruption"),
        "flight_id",
        "flight_number",
        "origin",
        "destination",
        "scheduled_dep",
        "scheduled_arr",
        "aircraft_type",
        "flight_status",
        "passenger_count",
        hours_between(F.col("scheduled_dep"), F.col("scheduled_arr")).alias("flight_duration_hrs"),
        F.col("flight_status").isin(*IMPACTED_STATUSES).alias("is_impacted_flight"),
    )


def crew_disruption_detail(disruptions: DataFrame, crew: DataFrame) -> DataFrame:
    """``flight_disruptions`` rows with their crew member; crew columns are NULL where there is none.

    The second join key is 0 for every row that has a crew id. It only scatters the rows without one,
    which can never match but would otherwise all be shuffled to the same task. A crew that was counted to be small
    is broadcast, so that the wide rows of all disruptions are not shuffled a second time; any other is joined by a shuffle.
    """
    left = disruptions.withColumnsRenamed({"crew_id": "event_crew_id"}).withColumn(
        "spread",
        F.when(F.col("event_crew_id").isNull(), F.pmod(F.hash("disruption_id"), F.lit(NULL_KEY_SPREAD))).otherwise(0),
    )
    right = crew.select(
        F.col("crew_id"),
        F.col("employee_id"),
        F.col("full_name").alias("crew_name"),
        F.col("email").alias("crew_email"),
        F.col("role").alias("crew_role"),
        F.col("base_airport").alias("crew_base_airport"),
        F.col("status").alias("crew_status"),
        F.col("qualifications").alias("crew_qualifications"),
        "hours_on_duty",
        "max_duty_hours",
        F.when(F.col("crew_id").isNull(), 1).otherwise(0).alias("crew_spread"),
    )
    small = crew.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    right = F.broadcast(right) if small else right
    matched = left.join(
        right, (left["event_crew_id"] == right["crew_id"]) & (left["spread"] == right["crew_spread"]), "left"
    )
    return matched.select(
        "disruption_id",
        "disruption_type",
        "severity",
        "severity_rank",
        "disruption_description",
        "estimated_delay_mins",
        "cost_estimate",
        "reported_at",
        "resolved_at",
        "is_unresolved",
        "is_crew_disruption",
        "flight_id",
        "flight_number",
        "origin",
        "destination",
        "scheduled_dep",
        "scheduled_arr",
        "aircraft_type",
        "flight_status",
        "passenger_count",
        "flight_duration_hrs",
        "is_impacted_flight",
        "crew_id",
        "employee_id",
        "crew_name",
        "crew_email",
        "crew_role",
        "crew_base_airport",
        "crew_status",
        "crew_qualifications",
        "hours_on_duty",
        "max_duty_hours",
        (F.col("max_duty_hours") - F.col("hours_on_duty")).alias("crew_hours_remaining"),
        F.col("crew_status").isin(*UNAVAILABLE_STATUSES).alias("crew_is_unavailable"),
        (F.col("crew_base_airport") == F.col("origin")).alias("crew_based_at_origin"),
    )


def register_views(spark: SparkSession, events: DataFrame, flights: DataFrame, crew: DataFrame, prefix: str = "vw_") -> str:
    """Create or replace the views, so that SQL can read them; the name of the upper one.

    Views of one prefix replace each other: jobs that share a session on different tables need prefixes of their own.
    """
    lower, upper = f"{prefix}flight_disruptions", f"{prefix}crew_disruption_detail"
    flight_disruptions(events, flights).createOrReplaceTempView(lower)
    crew_disruption_detail(spark.table(lower), crew).createOrReplaceTempView(upper)
    return upper


def crew_qualifications(crew: DataFrame) -> DataFrame:
    """One row per crew member and aircraft type rating; members without a rating keep one row."""
    return crew.select("crew_id", F.explode_outer("qualifications").alias("aircraft_type"))
