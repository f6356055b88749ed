"""Small tables with known results, and lineage event documents of the same shape as real ones."""

from __future__ import annotations

import datetime as dt

from tarmac import schemas
from tarmac.sources.tables import literal_rows

DAY = "2026-04-12"
AS_OF = dt.date(2026, 4, 12)
RUN_TS = dt.datetime(2026, 4, 12, 10, 0, 0)

# The rows of the three operational tables and the results they must give.
FLIGHT_ROWS = """
UA101 ORD LAX 06:00 08:30 B737 DELAYED   189
UA202 LAX JFK 09:00 17:30 A321 SCHEDULED 200
UA303 JFK SFO 10:30 14:00 B777 CANCELLED 315
UA404 SFO ORD 12:00 18:00 B787 DELAYED   248
UA505 ORD JFK 14:00 17:30 B737 SCHEDULED 175
UA606 JFK LAX 15:30 19:00 A320 SCHEDULED 180
UA707 LAX SFO 07:00 08:15 A320 DELAYED   150
UA808 SFO LAX 11:00 12:15 B737 SCHEDULED 162
"""
EVENT_ROWS = """
1 5    CREW_SICK    HIGH     120 45000.00 04:00 NULL
1 2    CREW_TIMEOUT MEDIUM    90 22000.00 04:30 NULL
3 5    CREW_SICK    CRITICAL 999 98000.00 05:00 NULL
4 9    CREW_TIMEOUT HIGH     180 55000.00 06:00 NULL
7 3    CREW_TIMEOUT MEDIUM    60 18000.00 06:30 NULL
2 NULL WEATHER      LOW       45  8000.00 07:00 07:30
5 NULL ATC_DELAY    LOW       30  5000.00 08:00 09:00
"""
CREW_ROWS = """
ORD AVAILABLE B737,B757 0.0 12.0 ok
ORD AVAILABLE B737      0.0 12.0 ok
LAX ON_DUTY   A320,A321 6.5 12.0 ok
LAX AVAILABLE A320      0.0 12.0 ok
JFK SICK      B777,B737 0.0 12.0 ok
JFK AVAILABLE B737,B777 0.0 14.0 ok
ORD AVAILABLE A320,B737 3.0 14.0 bad
SFO AVAILABLE B787,B777 0.0 12.0 ok
SFO GROUNDED  B787      0.0 12.0 NULL
LAX AVAILABLE A320,A321 0.0 14.0 ok
"""
EXPECTED_SUMMARY = """
UA101 189 2 0 1 1 0 210 67000.00 2 HIGH Multiple crew members disrupted on same flight
UA303 315 1 1 0 0 0 999 98000.00 1 CRITICAL CRITICAL severity crew disruption on flight
UA404 248 1 0 1 0 0 180 55000.00 1 HIGH HIGH severity crew disruption on flight
UA707 150 1 0 0 1 0 60 18000.00 1 MEDIUM Cumulative delay exceeds 1 hour
"""
EXPECTED_WORKLOAD = """
5 12.0 2 1 1119 143000.00 05:00
9 12.0 1 0 180 55000.00 06:00
2 12.0 1 0 90 22000.00 04:30
3 5.5 1 0 60 18000.00 06:30
"""
EXPECTED_HOURS = {"UA101": 2.5, "UA202": 8.5, "UA303": 3.5, "UA404": 6.0, "UA505": 3.5, "UA707": 1.25}


def _fields(text: str) -> list[list[str | None]]:
    return [[None if f == "NULL" else f for f in line.split()] for line in text.strip().splitlines()]


def _at(clock: str | None) -> str | None:
    return clock and f"{DAY} {clock}:00"


def flights(spark):
    columns = "flight_number origin destination scheduled_dep scheduled_arr aircraft_type status passenger_count".split()
    rows = [(n, o, d, _at(dep), _at(arr), a, s, p) for n, o, d, dep, arr, a, s, p in _fields(FLIGHT_ROWS)]
    return literal_rows(spark, schemas.FLIGHTS, columns, rows, RUN_TS, "flight_id")


def events(spark):
    columns = (
        "flight_id crew_id disruption_type severity estimated_delay_mins cost_estimate reported_at resolved_at".split()
    )
    rows = [(*row[:6], _at(row[6]), _at(row[7])) for row in _fields(EVENT_ROWS)]
    return literal_rows(spark, schemas.DISRUPTION_EVENTS, columns, rows, RUN_TS, "disruption_id")


def crew(spark):
    columns = (
        "employee_id full_name email role base_airport status qualifications hours_on_duty max_duty_hours".split()
    )
    rows = []
    for i, (base, status, ratings, used, limit, email) in enumerate(_fields(CREW_ROWS), start=1):
        address = {"ok": f"crew.{i}@airline.example.com", "bad": f"crew.{i}airline.example.com", None: None}[email]
        rows.append((f"EMP{i:03d}", f"Crew {i}", address, "CAPTAIN", base, status, ratings.split(","), used, limit))
    return literal_rows(spark, schemas.CREW_MEMBERS, columns, rows, RUN_TS, "crew_id")


def customer_rows(count: int = 102):
    """Customers by rule; numbers 2 and 57 have the malformed e-mails the check must find."""
    rows = []
    for i in range(1, count + 1):
        first, last = f"First{i}", f"Last{i}"
        email = f"{first}.{last}@Example.com"
        if i in (2, 57):
            first, last = {2: ("Milo", "Thorne"), 57: ("Vera", "Quill")}[i]
            email = f"{first}.{last}example.com".lower()
        born = dt.date(1960, 1, 1) + dt.timedelta(days=i * 163)
        rows.append((i, first, last, f"900-00-{i:04d}", born, email, f"555-{i:04d}", f"{i} Main Street",
                     None if i % 2 else "Suite 1", "Town", "TX", f"{70000 + i}"))
    return rows


def customers(spark, rows=None):
    return literal_rows(spark, schemas.MARKETING_CUSTOMER, schemas.MARKETING_CUSTOMER.names, rows or customer_rows(), RUN_TS)


# -- lineage documents -----------------------------------------------------------------------------

HOST_A, HOST_B = "postgres://warehouse-a:5432", "postgres://warehouse-b:5432"
ALIASES = {(HOST_A, "defaultdb"): "warehouse", (HOST_B, "postgres"): "warehouse"}
VIEW, TARGET = "defaultdb.public.vw_crew_disruption_detail", "defaultdb.public.disruption_summary"
REPORT_SOURCE = "postgres.public.disruption_summary"
FACET_OF = {"int": "int4", "string": "varchar", "timestamp_ntz": "timestamp", "date": "date", "boolean": "bool",
            "decimal": "numeric", "double": "numeric", "array<string>": "_text"}
HELPED = ("crew_id", "disruption_id", "estimated_delay_mins", "severity")
STAGED = ("cost_estimate",) + HELPED


def _schema(names_types):
    return {"schema": {"fields": [{"name": n, "type": FACET_OF[t.split("(")[0]]} for n, t in names_types]}}


def _source(host, dataset, *fields):
    return {"inputFields": [{"namespace": host, "name": dataset, "field": f} for f in fields]}


def scheduler_events(view_columns, run="run-1", parent="parent-1"):
    """START and COMPLETE of the job that reads the view and writes the summary table."""
    target = [(c.name, c.type) for c in schemas.DISRUPTION_SUMMARY.columns]
    lineage = {n: _source(HOST_A, "defaultdb.public.with_risk", n) for n, _ in target
               if n not in ("summary_id", "processed_at", "risk_flag", "risk_reason")}
    lineage |= {n: _source(HOST_A, "defaultdb.public.tmp_disruption_staging", *HELPED) for n in ("risk_flag", "risk_reason")}
    lineage |= {n: _source(HOST_A, VIEW, n) for n in STAGED}
    trigger = "2025-03-04T05:06:08.250000+00:00"
    nominal = "2025-03-04T05:06:07+00:00"

    def event(kind, time, end):
        parent_ref = {"run": {"runId": parent}, "job": {"name": "dag", "namespace": "scheduler"}}
        return {
            "eventTime": time,
            "eventType": kind,
            "producer": "https://scheduler.example.com",
            "job": {"namespace": "scheduler", "name": "dag.load"},
            "run": {
                "runId": run,
                "facets": {
                    "nominalTime": {"nominalStartTime": nominal, "nominalEndTime": end},
                    "parent": {**parent_ref, "root": parent_ref},
                    "airflow": {
                        "taskUuid": "task-1",
                        "dagRun": {
                            "run_id": f"manual__{trigger}", "run_after": trigger, "start_date": trigger,
                            "logical_date": nominal, "data_interval_start": nominal, "data_interval_end": nominal,
                        },
                        "taskInstance": {
                            "log_url": "http://scheduler.example.com/dags/dag/runs/manual__old/tasks/load?try_number=1",
                            "try_number": 1,
                        },
                    },
                },
            },
            "inputs": [{"namespace": HOST_A, "name": VIEW, "facets": _schema(view_columns)}],
            "outputs": [
                {"namespace": HOST_A, "name": TARGET, "facets": {**_schema(target), "columnLineage": {"fields": lineage}}}
            ],
        }

    return [
        event("START", "2025-03-04T05:06:07.250000+00:00", nominal),
        event("COMPLETE", "2025-03-04T05:06:10.671000+00:00", "2025-03-04T05:06:10+00:00"),
    ]


def report_events(run="run-2"):
    """START and COMPLETE of a report that reads the summary table under its other address."""
    columns = [(c.name, c.type) for c in schemas.DISRUPTION_SUMMARY.columns if not c.name.startswith("risk_")]

    def event(kind, time, end, lineage):
        facets = _schema(columns)
        if lineage:
            facets["columnLineage"] = {"fields": {n: _source(HOST_B, REPORT_SOURCE, n) for n, _ in columns}}
        return {
            "eventTime": time,
            "eventType": kind,
            "job": {"namespace": "reports", "name": "reports.summary"},
            "run": {"runId": run, "facets": {"nominalTime": {"nominalStartTime": end, "nominalEndTime": end}}},
            "inputs": [{"namespace": HOST_B, "name": REPORT_SOURCE, "facets": _schema(columns)}],
            "outputs": [{"namespace": "reports", "name": "reports.summary", "facets": facets}],
        }

    return [
        event("START", "2025-05-06T07:08:09.000000+00:00", "2025-05-06T07:08:09+00:00", False),
        event("COMPLETE", "2025-05-06T07:08:12.421000+00:00", "2025-05-06T07:08:12+00:00", True),
    ]
