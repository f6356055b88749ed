import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tarmac import schemas
from tarmac.operators import summary, views, workload
from tests import fixtures as fx


def rows(df, order="flight_number"):
    return [tuple(r) for r in df.orderBy(order).collect()]


@pytest.fixture(scope="module")
def tables(spark):
    return fx.events(spark), fx.flights(spark), fx.crew(spark)


def detail(tables):
    events, flights, crew = tables
    return views.crew_disruption_detail(views.flight_disruptions(events, flights), crew)


def test_views(spark, tables):
    first = views.flight_disruptions(tables[0], tables[1])
    assert len(first.columns) == 23 and first.count() == 7
    hours = {r["flight_number"]: r["flight_duration_hrs"] for r in first.collect()}
    assert hours == fx.EXPECTED_HOURS
    both = detail(tables)
    assert len(both.columns) == 35 and both.count() == 7
    crew_columns = [c for c in both.columns if c.startswith("crew_") or c in ("employee_id", "hours_on_duty", "max_duty_hours")]
    assert len(crew_columns) == 13
    without = both.filter("disruption_id IN (6, 7)").select(crew_columns).collect()
    assert [set(r) for r in without] == [{None}, {None}]  # unknown, not false
    sick = both.filter("disruption_id = 1").first()
    assert sick["crew_is_unavailable"] and not sick["crew_based_at_origin"] and sick["crew_hours_remaining"] == Decimal("12.0")
    assert sick["crew_qualifications"] == ["B777", "B737"]
    ranks = {r["severity"]: r["severity_rank"] for r in both.collect()}
    assert ranks == {"CRITICAL": 1, "HIGH": 2, "MEDIUM": 3, "LOW": 4}


def test_views_in_sql(spark, tables):
    views.register_views(spark, *tables)
    assert spark.sql("SELECT * FROM vw_crew_disruption_detail WHERE crew_id = 5").count() == 2


def test_staging(tables):
    staged = summary.staging(detail(tables))
    assert len(staged.columns) == 11
    assert sorted(r[0] for r in staged.select("disruption_id").collect()) == [1, 2, 3, 4, 5]


def expected_summary():
    lines = [line.split(maxsplit=11) for line in fx.EXPECTED_SUMMARY.strip().splitlines()]
    return [(n, *map(int, f[:7]), Decimal(f[7]), int(f[8]), f[9], f[10]) for n, *f in lines]


def test_summary_golden(tables):
    loaded = summary.disruption_summary(*tables, fx.AS_OF, fx.RUN_TS)
    assert loaded.columns == list(summary.SUMMARY_COLUMNS) and len(loaded.columns) == 18
    shown = loaded.select(
        "flight_number", "passenger_count", "total_crew_disruptions", "critical_count", "high_count", "medium_count",
        "low_count", "total_delay_mins", "total_cost_estimate", "affected_crew_count", "risk_flag", "risk_reason",
    )
    assert rows(shown) == expected_summary()
    assert {(r["summary_date"], r["processed_at"]) for r in loaded.collect()} == {(fx.AS_OF, fx.RUN_TS)}


def test_workload_golden(tables):
    events, _, crew = tables
    report = workload.workload_report(workload.crew_workload(crew, events, fx.RUN_TS))
    assert report.columns == schemas.CREW_WORKLOAD_SUMMARY.names
    got = [
        (r["crew_id"], r["hours_remaining"], r["disruption_count"], r["critical_disruptions"], r["total_delay_mins"],
         r["total_cost_estimate"], r["last_disruption_at"].strftime("%H:%M"))
        for r in report.collect()
    ]
    want = [line.split() for line in fx.EXPECTED_WORKLOAD.strip().splitlines()]
    assert got == [(int(c), Decimal(h), int(n), int(k), int(d), Decimal(m), t) for c, h, n, k, d, m, t in want]


def test_report_columns():
    assert len(summary.REPORT_COLUMNS) == 17
    assert set(schemas.DISRUPTION_SUMMARY.names) - set(summary.REPORT_COLUMNS) == {"risk_flag", "risk_reason"}


# -- edges ----------------------------------------------------------------------------------------

EVENT_DDL = (
    "disruption_id int, flight_id int, crew_id int, disruption_type string, severity string, description string, "
    "estimated_delay_mins int, cost_estimate decimal(10,2), reported_at timestamp_ntz, resolved_at timestamp_ntz"
)


def make_events(spark, rows_):
    at = dt.datetime(2026, 4, 12, 4, 0)
    full = [(i, f, c, k, s, None, d, Decimal("10.00"), at, None) for i, f, c, k, s, d in rows_]
    return spark.createDataFrame(full, EVENT_DDL)


def literal_summary(events, flights, crew):
    """The same totals written with plain distinct counts over the joined rows."""
    staged = summary.staging(views.crew_disruption_detail(views.flight_disruptions(events, flights), crew))
    per_severity = [
        F.count_distinct(F.when(F.col("severity") == s, F.col("disruption_id"))).alias(f"{s.lower()}_count")
        for s in ("CRITICAL", "HIGH", "MEDIUM", "LOW")
    ]
    return staged.groupBy(*summary.FLIGHT_KEYS).agg(
        F.max("passenger_count").alias("passenger_count"),
        F.count_distinct("disruption_id").alias("total_crew_disruptions"),
        *per_severity,
        F.coalesce(F.sum("estimated_delay_mins"), F.lit(0)).alias("total_delay_mins"),
        F.coalesce(F.sum("cost_estimate"), F.lit(0)).cast("decimal(20,2)").alias("total_cost_estimate"),
        F.count_distinct("crew_id").alias("affected_crew_count"),
    )


def all_three(events, flights, crew):
    literal = literal_summary(events, flights, crew)
    staged = summary.summarize(
        summary.staging(views.crew_disruption_detail(views.flight_disruptions(events, flights), crew))
    )
    early = summary.summarize_events(events, flights, crew)
    results = [rows(df.select(literal.columns)) for df in (literal, staged, early)]
    assert results[0] == results[1] == results[2]
    return summary.classify(early).orderBy("flight_number").collect()


@pytest.mark.parametrize(
    ("events", "flag", "reason"),
    [
        ([(1, 1, 1, "CREW_SICK", "LOW", 59)], "NORMAL", "Within acceptable disruption thresholds"),
        ([(1, 1, 1, "CREW_SICK", "LOW", 60)], "MEDIUM", "Cumulative delay exceeds 1 hour"),
        ([(1, 1, 1, "CREW_SICK", "LOW", 239)], "MEDIUM", "Cumulative delay exceeds 1 hour"),
        ([(1, 1, 1, "CREW_SICK", "LOW", 240)], "HIGH", "Cumulative delay exceeds 4 hours"),
        ([(1, 1, 1, "CREW_SICK", "MEDIUM", 10)], "MEDIUM", "Within acceptable disruption thresholds"),
        ([(1, 1, 1, "CREW_SICK", "critical", 10)], "NORMAL", "Within acceptable disruption thresholds"),
        ([(1, 1, None, "CREW_SICK", "HIGH", 250)], "HIGH", "Cumulative delay exceeds 4 hours"),
        (
            [(1, 1, 1, "CREW_SICK", "LOW", 1), (2, 1, 2, "CREW_TIMEOUT", "LOW", 1)],
            "HIGH",
            "Multiple crew members disrupted on same flight",
        ),
        (
            [(1, 1, 1, "CREW_SICK", "LOW", 1), (2, 1, 1, "CREW_TIMEOUT", "CRITICAL", 1)],
            "CRITICAL",
            "CRITICAL severity crew disruption on flight",
        ),
    ],
)
def test_risk_limits(spark, tables, events, flag, reason):
    (row,) = all_three(make_events(spark, events), tables[1], tables[2])
    assert (row["risk_flag"], row["risk_reason"]) == (flag, reason)


def test_repeated_events_change_sums_not_counts(spark, tables):
    events, flights, crew = tables
    once = {r["flight_number"]: r for r in summary.summarize_events(events, flights, crew).collect()}
    twice = {r["flight_number"]: r for r in summary.summarize_events(events.union(events), flights, crew).collect()}
    assert once.keys() == twice.keys()
    for key, row in once.items():
        counts = [c for c in row.asDict() if c.endswith("_count") or c == "total_crew_disruptions"]
        assert [row[c] for c in counts] == [twice[key][c] for c in counts]
        assert twice[key]["total_delay_mins"] == 2 * row["total_delay_mins"]


def test_odd_events(spark, tables):
    """Unknown severity, no crew, crew that is not in the roster, one id under two severities and crews."""
    events = make_events(
        spark,
        [
            (1, 1, None, "CREW_SICK", "SEVERE", 10),
            (2, 1, 77, "CREW_SICK", "LOW", 10),
            (3, 1, 1, "CREW_SICK", "LOW", 10),
            (3, 1, 2, "CREW_SICK", "HIGH", 10),
            (4, 2, 1, "WEATHER", "CRITICAL", 10),
            (5, 99, 1, "CREW_SICK", "CRITICAL", 10),
        ],
    )
    (row,) = all_three(events, tables[1], tables[2])
    assert row["total_crew_disruptions"] == 3 and row["affected_crew_count"] == 2
    assert (row["low_count"], row["high_count"], row["critical_count"]) == (2, 1, 0)


def test_one_flight_with_a_third_of_all_events(spark, tables):
    _, _, crew = tables
    flights = spark.range(1, 2001).select(
        F.col("id").alias("flight_id"), F.concat(F.lit("F"), "id").alias("flight_number"), F.lit("ORD").alias("origin"),
        F.lit("LAX").alias("destination"), F.lit("B737").alias("aircraft_type"), F.lit("DELAYED").alias("status"),
        F.lit(100).alias("passenger_count"), F.lit(None).cast("timestamp_ntz").alias("scheduled_dep"),
        F.lit(None).cast("timestamp_ntz").alias("scheduled_arr"),
    )
    severity = F.element_at(F.array(*map(F.lit, ("CRITICAL", "HIGH", "MEDIUM", "LOW"))), (F.col("id") % 4 + 1).cast("int"))
    events = spark.range(60000).select(
        (F.col("id") % 50000).alias("disruption_id"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 2000 + 1).alias("flight_id"),
        F.when(F.col("id") % 7 != 0, F.col("id") % 12 + 1).alias("crew_id"),
        F.lit("CREW_SICK").alias("disruption_type"), severity.alias("severity"), F.lit(None).cast("string").alias("description"),
        (F.col("id") % 100).cast("int").alias("estimated_delay_mins"), F.lit(1).cast("decimal(10,2)").alias("cost_estimate"),
        F.lit(None).cast("timestamp_ntz").alias("reported_at"), F.lit(None).cast("timestamp_ntz").alias("resolved_at"),
    )
    got = all_three(events, flights, crew)
    assert len(got) == 2000 and max(r["total_crew_disruptions"] for r in got) > 15000
