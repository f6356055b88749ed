"""Declared shape of every source and target table.

A ``Table`` keeps what a database would keep in its catalog: column types, NOT NULL, widths, defaults,
unique keys and references. Operators use it for casting (``operators.conform``) and for the
constraint jobs (``operators.constraints``).
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import types as T

NOW = object()  # default that stands for the run's timestamp


def sql_literal(value: object) -> str:
    """A text literal of Spark SQL."""
    escaped = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


@dataclass(frozen=True)
class Column:
    name: str
    type: str
    required: bool = False
    width: int | None = None
    default: Any = None

    @property
    def default_clause(self) -> str:
        """`` DEFAULT …`` for a constant default, else nothing."""
        if self.default is None or self.default is NOW:
            return ""
        return f" DEFAULT CAST({sql_literal(self.default)} AS {self.type})"


@dataclass(frozen=True)
class Table:
    name: str
    columns: tuple[Column, ...]
    unique: tuple[tuple[str, ...], ...] = ()
    references: tuple[tuple[str, str, str], ...] = ()  # (column, other table, other column)
    partition_by: tuple[str, ...] = ()
    bucket_by: tuple[str, ...] = ()  # rows of a partition lie in this many files by these columns
    buckets: int = 0

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(c.name, T._parse_datatype_string(c.type), not c.required) for c in self.columns]
        )

    @property
    def required(self) -> list[str]:
        return [c.name for c in self.columns if c.required]

    @property
    def widths(self) -> dict[str, int]:
        return {c.name: c.width for c in self.columns if c.width is not None}

    @property
    def defaults(self) -> dict[str, Any]:
        return {c.name: c.default for c in self.columns if c.default is not None}

    def __getitem__(self, name: str) -> Column:
        return next(c for c in self.columns if c.name == name)

    def ddl(self) -> str:
        """Column list for CREATE TABLE, with constant defaults."""
        return ", ".join(f"`{c.name}` {c.type}{c.default_clause}" for c in self.columns)

    def widened(self) -> "Table":
        """Same table with 64-bit integers and 20-digit sums, for inputs whose totals outgrow 32 bits."""
        wider = {"int": "bigint", "decimal(12,2)": "decimal(20,2)", "decimal(10,2)": "decimal(20,2)"}
        return Table(
            self.name,
            tuple(Column(c.name, wider.get(c.type, c.type), c.required, None, c.default) for c in self.columns),
            self.unique,
            self.references,
            self.partition_by,
            self.bucket_by,
            self.buckets,
        )


def _text(name: str, width: int | None = None, required: bool = False, default: str | None = None) -> Column:
    return Column(name, "string", required, width, default)


def _need(name: str, type_: str, default: Any = None) -> Column:
    return Column(name, type_, True, None, default)


# Names, types, widths and defaults of the tables.
FLIGHTS = Table(
    "flights",
    (
        _need("flight_id", "int"),
        _text("flight_number", 10, True),
        _text("origin", 3, True),
        _text("destination", 3, True),
        _need("scheduled_dep", "timestamp_ntz"),
        _need("scheduled_arr", "timestamp_ntz"),
        _text("aircraft_type", 10, True),
        _text("status", 20, True, "SCHEDULED"),
        _need("passenger_count", "int", 0),
        _need("created_at", "timestamp_ntz", NOW),
    ),
    unique=(("flight_id",), ("flight_number",)),
)

DISRUPTION_EVENTS = Table(
    "disruption_events",
    (
        _need("disruption_id", "int"),
        _need("flight_id", "int"),
        Column("crew_id", "int"),
        _text("disruption_type", 30, True),
        _text("severity", 10, True),
        _text("description"),
        _need("estimated_delay_mins", "int", 0),
        _need("cost_estimate", "decimal(10,2)", 0),
        _need("reported_at", "timestamp_ntz", NOW),
        Column("resolved_at", "timestamp_ntz"),
        _need("created_at", "timestamp_ntz", NOW),
    ),
    unique=(("disruption_id",),),
    references=(("flight_id", "flights", "flight_id"), ("crew_id", "crew_members", "crew_id")),
)

CREW_MEMBERS = Table(
    "crew_members",
    (
        _need("crew_id", "int"),
        _text("employee_id", 10, True),
        _text("full_name", 100, True),
        _text("email", 100),
        _text("role", 30, True),
        _text("base_airport", 3, True),
        _text("status", 20, True, "AVAILABLE"),
        Column("qualifications", "array<string>"),
        _need("hours_on_duty", "decimal(4,1)", 0.0),
        _need("max_duty_hours", "decimal(4,1)", 12.0),
        _need("created_at", "timestamp_ntz", NOW),
    ),
    unique=(("crew_id",), ("employee_id",)),
)

# The contact source holds personal data; its name differs from the TPC-H style ``customer`` table.
MARKETING_CUSTOMER = Table(
    "marketing_customer",
    (
        Column("customer_id", "int"),
        _text("first_name", 50),
        _text("last_name", 50),
        _text("ssn", 11),
        Column("date_of_birth", "date"),
        _text("email", 100),
        _text("phone_number", 20),
        _text("address_line1", 100),
        _text("address_line2", 100),
        _text("city", 50),
        _text("state", 2),
        _text("zip_code", 10),
    ),
)

DISRUPTION_SUMMARY = Table(
    "disruption_summary",
    (
        _need("summary_id", "int"),
        _need("summary_date", "date"),
        _text("flight_number", 10, True),
        _text("origin", 3, True),
        _text("destination", 3, True),
        _text("aircraft_type", 10, True),
        _text("flight_status", 20, True),
        _need("passenger_count", "int", 0),
        _need("total_crew_disruptions", "int", 0),
        _need("critical_count", "int", 0),
        _need("high_count", "int", 0),
        _need("medium_count", "int", 0),
        _need("low_count", "int", 0),
        _need("total_delay_mins", "int", 0),
        _need("total_cost_estimate", "decimal(12,2)", 0),
        _need("affected_crew_count", "int", 0),
        _need("processed_at", "timestamp_ntz", NOW),
        _text("risk_flag", 10, default="NORMAL"),
        _text("risk_reason"),
    ),
    unique=(("summary_id",), ("summary_date", "flight_number")),
    partition_by=("summary_date",),
    bucket_by=("flight_number",),
    buckets=8,
)

CREW_WORKLOAD_SUMMARY = Table(
    "crew_workload_summary",
    (
        _need("crew_id", "int"),
        _text("employee_id", 20, True),
        _text("crew_name", 100, True),
        _text("crew_role", 50, True),
        _text("base_airport", 3),
        Column("hours_on_duty", "decimal(5,1)"),
        Column("max_duty_hours", "decimal(5,1)"),
        Column("hours_remaining", "decimal(5,1)"),
        _need("disruption_count", "int"),
        _need("critical_disruptions", "int"),
        _need("total_delay_mins", "int"),
        _need("total_cost_estimate", "decimal(12,2)"),
        Column("last_disruption_at", "timestamp_ntz"),
        _need("refreshed_at", "timestamp_ntz", NOW),
    ),
    unique=(("crew_id",),),
)

INVALID_EMAIL = Table(
    "invalid_email",
    (_text("email", 100), Column("customer_id", "int"), _text("last_name", 50), _text("first_name", 50)),
)

MARKETING_LEADS = Table(
    "marketing_leads",
    (
        _need("customer_id", "int"),
        _text("full_name", 201),
        _text("email"),
        _text("city"),
        _text("state"),
        Column("age", "int"),
        _text("age_band", 10),
        Column("email_is_valid", "boolean"),
        Column("loaded_at", "timestamp_ntz", default=NOW),
    ),
    unique=(("customer_id",),),
)

TABLES = {
    t.name: t
    for t in (
        FLIGHTS,
        DISRUPTION_EVENTS,
        CREW_MEMBERS,
        MARKETING_CUSTOMER,
        DISRUPTION_SUMMARY,
        CREW_WORKLOAD_SUMMARY,
        INVALID_EMAIL,
        MARKETING_LEADS,
    )
}

# Columns of the contact source that must never reach a contact list.
PERSONAL_COLUMNS = ("ssn", "date_of_birth", "phone_number", "address_line1", "address_line2", "zip_code")
