"""Disruption summary: one row per flight that has open crew disruptions, with its risk class."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions.risk import CREW_TYPES, SEVERITIES, risk_flag, risk_reason
from tarmac.functions.time import date_lit, timestamp_lit

FLIGHT_KEYS = ("flight_number", "origin", "destination", "aircraft_type", "flight_status")

STAGING_COLUMNS = FLIGHT_KEYS + (
    "passenger_count",
    "disruption_id",
    "severity",
    "estimated_delay_mins",
    "cost_estimate",
    "crew_id",
)

SUMMARY_COLUMNS = (
    ("summary_date",)
    + FLIGHT_KEYS
    + (
        "passenger_count",
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
)

# Report read: the columns of the target a dashboard shows, without the risk class.
REPORT_COLUMNS = ("summary_id",) + tuple(c for c in SUMMARY_COLUMNS if not c.startswith("risk_"))


def staging(detail: DataFrame) -> DataFrame:
    """Open crew disruptions of the detail view, cut to the columns the summary needs."""
    return detail.filter(F.col("is_unresolved") & F.col("is_crew_disruption")).select(*STAGING_COLUMNS)


def open_crew_events(events: DataFrame) -> DataFrame:
    """The same filter on the event table itself; both conditions reach the scan."""
    return events.filter(F.col("resolved_at").isNull() & F.col("disruption_type").isin(*CREW_TYPES))


def _disruption_totals(rows: DataFrame, keys: tuple[str, ...], *, passengers: bool = False) -> DataFrame:
    """Counts of distinct disruptions per key, plain sums over all rows.

    The first grouping holds the disruption id as well, so the distinct counts become sums of 0/1 marks
    and a key with very many rows is still spread over all tasks. All five distinct counts share it.
    """
    marks = {name: f"{name.lower()}_count" for name in SEVERITIES}
    known = F.col("disruption_id").isNotNull()
    largest = [F.max("passenger_count").alias("passenger_count")] if passengers else []
    per_disruption = rows.groupBy(*keys, "disruption_id").agg(
        *[F.max(F.col("severity") == name).alias(mark) for name, mark in marks.items()],
        F.sum("estimated_delay_mins").alias("delay"),
        F.sum("cost_estimate").alias("cost"),
        *largest,
    )
    return per_disruption.groupBy(*keys).agg(
        F.count("disruption_id").alias("total_crew_disruptions"),
        *[F.count(F.when(known & F.col(mark), 1)).alias(mark) for mark in marks.values()],
        F.coalesce(F.sum("delay"), F.lit(0)).alias("total_delay_mins"),
        F.coalesce(F.sum("cost"), F.lit(0)).cast("decimal(20,2)").alias("total_cost_estimate"),
        *largest,
    )


def _crew_counts(pairs: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return pairs.groupBy(*keys).agg(F.count("crew_id").alias("affected_crew_count"))


def _distinct_crew(rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return rows.filter(F.col("crew_id").isNotNull()).select(*keys, "crew_id").distinct()


def summarize(rows: DataFrame) -> DataFrame:
    """Totals per flight from staging rows (any DataFrame with ``STAGING_COLUMNS``)."""
    totals = _disruption_totals(rows, FLIGHT_KEYS, passengers=True)
    crew = _crew_counts(_distinct_crew(rows, FLIGHT_KEYS), FLIGHT_KEYS).withColumnsRenamed(
        {key: f"crew_{key}" for key in FLIGHT_KEYS}
    )
    same_flight = [totals[key].eqNullSafe(crew[f"crew_{key}"]) for key in FLIGHT_KEYS]
    return totals.join(crew, same_flight, "left").select(
        *FLIGHT_KEYS,
        "passenger_count",
        *[c for c in totals.columns if c.endswith(("_count", "_disruptions")) and c != "passenger_count"],
        "total_delay_mins",
        "total_cost_estimate",
        F.coalesce("affected_crew_count", F.lit(0)).alias("affected_crew_count"),
    )


def summarize_events(events: DataFrame, flights: DataFrame, crew: DataFrame) -> DataFrame:
    """The totals of ``summarize(staging(detail))``, aggregated before the flights are joined.

    Relies on the declared keys: ``flight_id`` and ``flight_number`` are unique in ``flights`` and
    ``crew_id`` is unique in ``crew``. The event rows are shuffled with three narrow columns instead of
    the flight's attributes, and each flight is joined once instead of once per event. Only crew ids
    that exist in ``crew`` count, as they do behind the view's left join.
    """
    open_events = open_crew_events(events)
    totals = _disruption_totals(open_events, ("flight_id",))
    known_crew = _distinct_crew(open_events, ("flight_id",)).join(crew.select("crew_id"), "crew_id", "left_semi")
    crew_counts = _crew_counts(known_crew, ("flight_id",))
    flight_side = flights.select(
        "flight_id",
        "flight_number",
        "origin",
        "destination",
        "aircraft_type",
        F.col("status").alias("flight_status"),
        "passenger_count",
    )
    per_flight = totals.join(crew_counts, "flight_id", "left").join(flight_side, "flight_id")
    return per_flight.withColumn("affected_crew_count", F.coalesce("affected_crew_count", F.lit(0))).drop("flight_id")


def classify(totals: DataFrame) -> DataFrame:
    """Add ``risk_flag`` and ``risk_reason``."""
    critical, high, medium = F.col("critical_count"), F.col("high_count"), F.col("medium_count")
    delay, crew = F.col("total_delay_mins"), F.col("affected_crew_count")
    return totals.withColumns(
        {
            "risk_flag": risk_flag(critical, high, medium, delay, crew),
            "risk_reason": risk_reason(critical, high, delay, crew),
        }
    )


def stamp(classified: DataFrame, as_of: dt.date, run_ts: dt.datetime) -> DataFrame:
    """Add the load's date and time and bring the columns into the target's order."""
    return classified.withColumns(
        {"summary_date": date_lit(as_of), "processed_at": timestamp_lit(run_ts)}
    ).select(*SUMMARY_COLUMNS)


def disruption_summary(
    events: DataFrame, flights: DataFrame, crew: DataFrame, as_of: dt.date, run_ts: dt.datetime
) -> DataFrame:
    """The source rows of one summary load."""
    return stamp(classify(summarize_events(events, flights, crew)), as_of, run_ts)


def summary_report(summary: DataFrame) -> DataFrame:
    return summary.select(*REPORT_COLUMNS)
