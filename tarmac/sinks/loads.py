"""The four loads, each from source tables to its target."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from tarmac import schemas
from tarmac.operators.marketing import invalid_email, marketing_leads
from tarmac.operators.merge import SUMMARY_UPDATES
from tarmac.operators.summary import disruption_summary
from tarmac.operators.workload import crew_workload
from tarmac.schemas import Table
from tarmac.sinks.tables import append, ensure_table, full_refresh, upsert


def load_disruption_summary(
    events: DataFrame,
    flights: DataFrame,
    crew: DataFrame,
    location: str,
    as_of: dt.date,
    run_ts: dt.datetime,
    name: str = "disruption_summary",
    table: Table = schemas.DISRUPTION_SUMMARY,
) -> None:
    """Merge the open disruptions of ``as_of`` into the summary table."""
    source = disruption_summary(events, flights, crew, as_of, run_ts)
    upsert(source, table, name, location, ["summary_date", "flight_number"], SUMMARY_UPDATES, "summary_id")


def load_crew_workload(
    crew: DataFrame,
    events: DataFrame,
    location: str,
    run_ts: dt.datetime,
    name: str = "crew_workload_summary",
    table: Table = schemas.CREW_WORKLOAD_SUMMARY,
) -> None:
    full_refresh(crew_workload(crew, events, run_ts), table, name, location)


def load_marketing_leads(
    customers: DataFrame,
    location: str,
    as_of: dt.date,
    run_ts: dt.datetime,
    name: str = "marketing_leads",
    table: Table = schemas.MARKETING_LEADS,
) -> None:
    full_refresh(marketing_leads(customers, as_of, run_ts), table, name, location)


def load_invalid_email(
    customers: DataFrame, location: str, name: str = "invalid_email", table: Table = schemas.INVALID_EMAIL
) -> None:
    """Append the malformed e-mails; meant to run once per delivery of customers."""
    ensure_table(customers.sparkSession, table, name, location)
    append(invalid_email(customers), table, name)
