"""SQL that must give the same rows as each registered query, for a second engine over the same tables.

Written against the plain tables, without sharing code with the queries.
"""

from __future__ import annotations

FLIGHTS = """flights AS (
  SELECT o_orderkey AS flight_id, 'FL' || o_orderkey AS flight_number, n_name AS origin, r_name AS destination,
         o_orderdate AS scheduled_dep, o_orderdate + to_hours(CAST(o_orderkey % 24 + 1 AS INTEGER)) AS scheduled_arr,
         c_mktsegment AS aircraft_type,
         CASE o_orderstatus WHEN 'F' THEN 'DELAYED' WHEN 'P' THEN 'CANCELLED' ELSE 'SCHEDULED' END AS status,
         CAST(floor(o_totalprice / 1000) AS INTEGER) AS passenger_count,
         TIMESTAMP '1995-01-01 00:00:00' AS created_at
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

EVENTS = """disruptions AS (
  SELECT l_orderkey * 100 + l_linenumber AS disruption_id, l_orderkey AS flight_id,
         CASE WHEN l_returnflag <> 'N' THEN l_suppkey END AS crew_id,
         CASE l_returnflag WHEN 'R' THEN 'CREW_SICK' WHEN 'A' THEN 'CREW_TIMEOUT' ELSE 'WEATHER' END AS disruption_type,
         CASE WHEN l_quantity > 47 THEN 'CRITICAL' WHEN l_quantity > 38 THEN 'HIGH'
              WHEN l_quantity > 15 THEN 'MEDIUM' ELSE 'LOW' END AS severity,
         'part ' || l_partkey AS description,
         CAST(floor(l_quantity * 3) AS INTEGER) AS estimated_delay_mins,
         CAST(l_extendedprice AS DECIMAL(10, 2)) AS cost_estimate,
         l_shipdate AS reported_at, CASE WHEN l_linestatus = 'F' THEN l_shipdate END AS resolved_at,
         TIMESTAMP '1995-01-01 00:00:00' AS created_at
  FROM lineitem
)"""

CREW = """crew AS (
  SELECT s_suppkey AS crew_id, 'EMP' || s_suppkey AS employee_id, s_name AS full_name,
         CASE WHEN s_suppkey % 20 = 7 THEN replace(lower(replace(s_name, '#', '.')) || '@crew.example.com', '@', '')
              WHEN s_suppkey % 20 = 9 THEN NULL
              ELSE lower(replace(s_name, '#', '.')) || '@crew.example.com' END AS email,
         list_extract(['CAPTAIN', 'FIRST_OFFICER', 'FLIGHT_ATTENDANT'], s_suppkey % 3 + 1) AS role,
         n_name AS base_airport,
         list_extract(['AVAILABLE', 'ON_DUTY', 'OFF_DUTY', 'SICK', 'GROUNDED'], s_suppkey % 5 + 1) AS status,
         list_extract(['B737', 'B757', 'A320', 'A321', 'B777', 'B787'], s_suppkey % 6 + 1) AS rating_1,
         list_extract(['B737', 'B757', 'A320', 'A321', 'B777', 'B787'], (s_suppkey + 1) % 6 + 1) AS rating_2,
         CAST(s_suppkey % 13 AS DECIMAL(4, 1)) AS hours_on_duty, CAST(12 AS DECIMAL(4, 1)) AS max_duty_hours,
         TIMESTAMP '1995-01-01 00:00:00' AS created_at
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
)"""

CUSTOMERS = """contacts AS (
  SELECT o_orderkey AS customer_id, CASE WHEN o_orderkey % 53 <> 0 THEN c_mktsegment END AS first_name,
         c_name AS last_name, '900-00-' || o_orderkey AS ssn,
         CASE WHEN o_orderkey % 97 <> 0
              THEN CAST(CAST(o_orderdate AS DATE) - to_years(CAST(o_custkey % 50 AS INTEGER)) AS DATE) END AS date_of_birth,
         CASE WHEN o_custkey % 40 = 0 THEN NULL
              WHEN o_custkey % 51 = 2 THEN 'customer.' || o_custkey || 'Example.com'
              ELSE 'Customer.' || o_custkey || '@Example.com' END AS email,
         '555-' || o_orderkey AS phone_number, o_orderkey || ' Main Street' AS address_line1,
         CASE WHEN o_orderkey % 2 = 0 THEN 'Suite 1' END AS address_line2,
         n_name AS city, substr(n_name, 8, 2) AS state, CAST(o_custkey % 90000 + 10000 AS VARCHAR) AS zip_code
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
)"""

VIEW_1 = """view_1 AS (
  SELECT e.disruption_id, e.crew_id, e.disruption_type, e.severity, e.description AS disruption_description,
         e.estimated_delay_mins, e.cost_estimate, e.reported_at, e.resolved_at,
         e.resolved_at IS NULL AS is_unresolved,
         CASE e.severity WHEN 'CRITICAL' THEN 1 WHEN 'HIGH' THEN 2 WHEN 'MEDIUM' THEN 3 ELSE 4 END AS severity_rank,
         e.disruption_type IN ('CREW_SICK', 'CREW_TIMEOUT') AS is_crew_disruption,
         f.flight_id, f.flight_number, f.origin, f.destination, f.scheduled_dep, f.scheduled_arr, f.aircraft_type,
         f.status AS flight_status, f.passenger_count,
         (epoch_us(f.scheduled_arr) - epoch_us(f.scheduled_dep)) / 3600000000.0::DOUBLE AS flight_duration_hrs,
         f.status IN ('DELAYED', 'CANCELLED') AS is_impacted_flight
  FROM disruptions e JOIN flights f ON e.flight_id = f.flight_id
)"""

VIEW_2 = """view_2 AS (
  SELECT v.* EXCLUDE (crew_id), c.crew_id, c.employee_id, c.full_name AS crew_name, c.email AS crew_email,
         c.role AS crew_role, c.base_airport AS crew_base_airport, c.status AS crew_status,
         c.rating_1 || '|' || c.rating_2 AS crew_qualifications, c.hours_on_duty, c.max_duty_hours,
         c.max_duty_hours - c.hours_on_duty AS crew_hours_remaining,
         c.status IN ('SICK', 'GROUNDED') AS crew_is_unavailable, c.base_airport = v.origin AS crew_based_at_origin
  FROM view_1 v LEFT JOIN crew c ON v.crew_id = c.crew_id
)"""


def _totals(name: str, events: str, flights: str) -> str:
    """Summary per flight from the named event and flight relations."""
    return f"""{name} AS (
  SELECT f.flight_number, f.origin, f.destination, f.aircraft_type, f.status AS flight_status,
         max(f.passenger_count) AS passenger_count,
         count(DISTINCT e.disruption_id) AS total_crew_disruptions,
         count(DISTINCT CASE WHEN e.severity = 'CRITICAL' THEN e.disruption_id END) AS critical_count,
         count(DISTINCT CASE WHEN e.severity = 'HIGH' THEN e.disruption_id END) AS high_count,
         count(DISTINCT CASE WHEN e.severity = 'MEDIUM' THEN e.disruption_id END) AS medium_count,
         count(DISTINCT CASE WHEN e.severity = 'LOW' THEN e.disruption_id END) AS low_count,
         CAST(coalesce(sum(e.estimated_delay_mins), 0) AS BIGINT) AS total_delay_mins,
         CAST(CAST(coalesce(sum(e.cost_estimate), 0) AS DECIMAL(20, 2)) AS DOUBLE) AS total_cost_estimate,
         count(DISTINCT c.crew_id) AS affected_crew_count
  FROM {events} e JOIN {flights} f ON e.flight_id = f.flight_id LEFT JOIN crew c ON e.crew_id = c.crew_id
  WHERE e.resolved_at IS NULL AND e.disruption_type IN ('CREW_SICK', 'CREW_TIMEOUT')
  GROUP BY ALL
)"""


def _risk(name: str, totals: str, run_ts: str) -> str:
    return f"""{name} AS (
  SELECT '2020-06-15' AS summary_date, t.*,
         CASE WHEN critical_count > 0 THEN 'CRITICAL'
              WHEN high_count > 0 OR total_delay_mins >= 240 OR affected_crew_count > 1 THEN 'HIGH'
              WHEN medium_count > 0 OR total_delay_mins >= 60 THEN 'MEDIUM' ELSE 'NORMAL' END AS risk_flag,
         CASE WHEN critical_count > 0 THEN 'CRITICAL severity crew disruption on flight'
              WHEN affected_crew_count > 1 THEN 'Multiple crew members disrupted on same flight'
              WHEN total_delay_mins >= 240 THEN 'Cumulative delay exceeds 4 hours'
              WHEN high_count > 0 THEN 'HIGH severity crew disruption on flight'
              WHEN total_delay_mins >= 60 THEN 'Cumulative delay exceeds 1 hour'
              ELSE 'Within acceptable disruption thresholds' END AS risk_reason,
         TIMESTAMP '{run_ts}' AS processed_at
  FROM {totals} t
)"""


SUMMARY = ",\n".join(
    [FLIGHTS, EVENTS, CREW, _totals("totals", "disruptions", "flights"), _risk("summary", "totals", "2020-06-15 12:00:00")]
)

_BY_DIGEST = "row_number() OVER (ORDER BY substr(md5('2020-06-15|' || flight_number), 1, 3), flight_number)"

LATER_FLIGHTS = """later_flights AS (
  SELECT * REPLACE (passenger_count + 10 AS passenger_count,
                    CASE status WHEN 'SCHEDULED' THEN 'DEPARTED' ELSE status END AS status)
  FROM flights
)"""

EARLY_EVENTS = """early_events AS (
  SELECT * REPLACE (CAST(NULL AS TIMESTAMP) AS resolved_at) FROM disruptions
  WHERE reported_at < TIMESTAMP '1998-07-01 00:00:00'
)"""

WORKLOAD = f"""{EVENTS},
{CREW},
workload AS (
  SELECT c.crew_id, c.employee_id, c.full_name AS crew_name, c.role AS crew_role, c.base_airport,
         CAST(c.hours_on_duty AS DOUBLE) AS hours_on_duty, CAST(c.max_duty_hours AS DOUBLE) AS max_duty_hours,
         CAST(c.max_duty_hours - c.hours_on_duty AS DOUBLE) AS hours_remaining,
         count(e.disruption_id) AS disruption_count,
         CAST(sum(CASE WHEN e.severity = 'CRITICAL' THEN 1 ELSE 0 END) AS BIGINT) AS critical_disruptions,
         CAST(coalesce(sum(e.estimated_delay_mins), 0) AS BIGINT) AS total_delay_mins,
         CAST(CAST(coalesce(sum(e.cost_estimate), 0) AS DECIMAL(20, 2)) AS DOUBLE) AS total_cost_estimate,
         max(e.reported_at) AS last_disruption_at, TIMESTAMP '2020-06-15 12:00:00' AS refreshed_at
  FROM crew c JOIN disruptions e ON e.crew_id = c.crew_id
  GROUP BY ALL
)"""

_EMAIL_OK = "regexp_matches({}, '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{{2,}}$')"

# Age as whole months plus days, the days borrowed from the month of birth.
LEADS = f"""{CUSTOMERS},
aged AS (
  SELECT *, (2020 - year(date_of_birth)) * 12 + 6 - month(date_of_birth)
            - CASE WHEN 15 < day(date_of_birth) THEN 1 ELSE 0 END AS months,
         15 - day(date_of_birth)
            + CASE WHEN 15 < day(date_of_birth) THEN day(last_day(date_of_birth)) ELSE 0 END AS days
  FROM contacts
)"""

# -- lineage ---------------------------------------------------------------------------------------

DOCS = """docs AS (
  SELECT event_id, event_id // 2 AS run_no, 'run-' || (event_id // 2) AS run_id, ts, event_type AS kind,
         CASE WHEN event_id % 2 = 0 THEN 'START' WHEN event_type = 'error' THEN 'FAIL' ELSE 'COMPLETE' END AS state,
         event_id % 2 = 0 AS is_start, 'job_' || ((event_id // 2) % 100) AS job,
         CASE WHEN event_type IN ('click', 'view') THEN 'postgres://warehouse-a:5432'
              ELSE 'postgres://warehouse-b:5432' END AS host,
         CASE WHEN event_type IN ('click', 'view') THEN 'defaultdb' ELSE 'postgres' END AS db,
         CASE WHEN event_type = 'signup' THEN 'run-' || (event_id // 2) ELSE 'dag-' || (event_id // 20) END AS parent_run_id,
         user_id AS in_1, CAST(regexp_extract(props, '(\\d+)', 1) AS BIGINT) AS in_2, user_id // 2 AS outp,
         (event_id // 2) % 5 <> 0 AS scheduled
  FROM events
)"""

EDGES = f"""{DOCS},
edges AS (
  SELECT src, dst, kind, count(DISTINCT event_id) AS n_events FROM (
    SELECT event_id, 'warehouse/public.t_' || in_1 AS src, 'job:scheduler/' || job AS dst, 'read' AS kind FROM docs
    UNION ALL SELECT event_id, 'warehouse/public.t_' || in_2, 'job:scheduler/' || job, 'read' FROM docs
    UNION ALL SELECT event_id, 'job:scheduler/' || job, 'warehouse/public.t_' || outp, 'write' FROM docs
  ) GROUP BY ALL
)"""

# (output column, source table, source column) of the column lineage; n is NULL for helper datasets
LINEAGE = """lineage AS (
  SELECT run_no, host, db, outp, 'c_1' AS col, 't_' || in_1 AS src, 'c_1' AS field FROM docs WHERE NOT is_start
  UNION ALL SELECT run_no, host, db, outp, 'c_2', 't_' || in_1, 'c_2' FROM docs WHERE NOT is_start
  UNION ALL SELECT run_no, host, db, outp, 'c_2', 't_' || in_2, 'c_0' FROM docs WHERE NOT is_start
  UNION ALL SELECT run_no, host, db, outp, 'risk', 'tmp_staging', 'c_1' FROM docs WHERE NOT is_start
  UNION ALL SELECT run_no, host, db, outp, 'risk', 'tmp_staging', 'c_9' FROM docs WHERE NOT is_start
  UNION ALL SELECT run_no, host, db, outp, 'x_extra', 'with_risk', 'x_extra' FROM docs WHERE NOT is_start
  UNION ALL SELECT run_no, host, db, outp, 'c_0', 'tmp_staging', 'stage_a' FROM docs WHERE NOT is_start
  UNION ALL SELECT run_no, host, db, outp, 'stage_a', 't_' || in_1, 'c_0' FROM docs WHERE NOT is_start
  UNION ALL SELECT run_no, host, db, outp, 'stage_a', 'with_risk', 'stage_b' FROM docs WHERE NOT is_start
  UNION ALL SELECT run_no, host, db, outp, 'stage_b', 't_' || in_2, 'c_2' FROM docs WHERE NOT is_start
  UNION ALL SELECT run_no, host, db, outp, 'stage_b', 'with_risk', 'gone' FROM docs WHERE NOT is_start
)"""

_FACETS = "['int4', 'varchar', 'bpchar', 'text', 'numeric', 'timestamp', 'bool', 'date', '_text']"
_SPARK = "['int', 'string', 'string', 'string', 'decimal', 'timestamp_ntz', 'boolean', 'date', 'array<string>']"

SCHEMAS = f"""positions AS (SELECT unnest([0, 1, 2, 3, 4, 5]) AS j),
columns_seen AS (
  SELECT 'reader' AS role, n, 'c_' || j AS col, list_extract({_SPARK}, (j + n) % 9 + 1) AS type
  FROM (SELECT in_1 AS n FROM docs UNION ALL SELECT in_2 FROM docs) JOIN positions ON j <= n % 4 + 2
  UNION ALL
  SELECT 'writer', n, 'c_' || j,
         CASE WHEN j = 1 AND n % 5 = 0 THEN 'string' ELSE list_extract({_SPARK}, (j + n) % 9 + 1) END
  FROM (SELECT outp AS n FROM docs) JOIN positions ON j <= n % 4 + 2
  UNION ALL SELECT 'writer', outp, 'c_new', 'string' FROM docs WHERE outp % 3 = 0
)"""


def _null_counts(table: str, label: str, columns: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{label}' AS table_name, '{c}' AS column_name, count(*) AS n_rows, "
        f"count(*) - count({c}) AS n_nulls FROM {table}"
        for c in columns.split()
    )


def _over_length(table: str, label: str, widths: dict[str, int]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{label}' AS table_name, '{c}' AS column_name, CAST({w} AS INTEGER) AS width, "
        f"CAST(max(length({c})) AS INTEGER) AS max_length, count(CASE WHEN length({c}) > {w} THEN 1 END) AS n_over FROM {table}"
        for c, w in widths.items()
    )


def _duplicates(table: str, key: str, label: str) -> str:
    return (
        f"SELECT '{label}' AS check_name, CAST({key} AS VARCHAR) AS key_value, count(*) AS n_rows FROM {table} "
        f"WHERE {key} IS NOT NULL GROUP BY {key} HAVING count(*) > 1"
    )


def _orphans(key: str, parent: str, label: str) -> str:
    return (
        f"SELECT '{label}' AS check_name, CAST(e.{key} AS VARCHAR) AS key_value, count(*) AS n_rows FROM disruptions e "
        f"WHERE e.{key} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = e.{key}) GROUP BY e.{key}"
    )


def _score(table: str, label: str, checks: list[str]) -> str:
    passed = " + ".join(f"count(CASE WHEN {c} THEN 1 END)" for c in checks)
    made = f"count(*) * {len(checks)}"
    return (
        f"SELECT '{label}' AS table_name, count(*) AS n_rows, {made} AS n_checks, {made} - ({passed}) AS n_failed, "
        f"CAST({passed} AS DOUBLE) / CAST({made} AS DOUBLE) AS score, "
        f"CAST({passed} AS DOUBLE) / CAST({made} AS DOUBLE) >= 0.99 AS meets_sla FROM {table}"
    )


def _profile(columns: str) -> str:
    return " UNION ALL ".join(
        f"SELECT 'marketing_customer' AS table_name, '{c}' AS column_name, count(*) AS n_rows, "
        f"count(*) - count({c}) AS n_nulls, count(DISTINCT {c}) AS n_distinct, "
        f"CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value FROM sampled"
        for c in columns.split()
    )


def _uuid(kind: str, value: str) -> str:
    digest = f"sha256('rebase/{kind}|' || {value})"
    return (
        f"substr({digest}, 1, 8) || '-' || substr({digest}, 9, 4) || '-' || substr({digest}, 13, 4) || '-' || "
        f"substr({digest}, 17, 4) || '-' || substr({digest}, 21, 12)"
    )


def _tree(steps: str, seeds: str) -> str:
    return f"""WITH RECURSIVE links AS (SELECT p_partkey // 2 AS src, p_partkey AS dst FROM part WHERE p_partkey <> 0),
reached(node, hops) AS (
  SELECT node, 0 FROM ({seeds})
  UNION
  SELECT {steps}
)
SELECT node, min(hops) AS hops FROM reached GROUP BY node"""


_REBASED = "'2026-03-01T10:20:3"

ORACLE: dict[str, str] = {
    "scan_project": f"WITH {CREW} SELECT crew_id, full_name AS crew_name, status AS crew_status, base_airport FROM crew",
    "scan_sources": f"WITH {FLIGHTS},\n{EVENTS},\n{CREW},\n{CUSTOMERS}\n"
    "SELECT 'flights' AS source, flight_id AS key, destination AS label, CAST(scheduled_arr AS TIMESTAMP) AS at FROM flights\n"
    "UNION ALL SELECT 'disruption_events', disruption_id, severity, CAST(resolved_at AS TIMESTAMP) FROM disruptions\n"
    "UNION ALL SELECT 'crew_members', crew_id, base_airport, TIMESTAMP '1995-01-01 00:00:00' FROM crew\n"
    "UNION ALL SELECT 'marketing_customer', customer_id, state, CAST(date_of_birth AS TIMESTAMP) FROM contacts",
    "flight_disruptions": f"WITH {FLIGHTS},\n{EVENTS},\n{VIEW_1}\n"
    "SELECT * REPLACE (CAST(cost_estimate AS DOUBLE) AS cost_estimate) FROM view_1",
    "crew_disruption_detail": f"WITH {FLIGHTS},\n{EVENTS},\n{CREW},\n{VIEW_1},\n{VIEW_2}\n"
    "SELECT * REPLACE (CAST(cost_estimate AS DOUBLE) AS cost_estimate, CAST(hours_on_duty AS DOUBLE) AS hours_on_duty, "
    "CAST(max_duty_hours AS DOUBLE) AS max_duty_hours, CAST(crew_hours_remaining AS DOUBLE) AS crew_hours_remaining) "
    "FROM view_2",
    "staging_filter": f"WITH {FLIGHTS},\n{EVENTS},\n{CREW},\n{VIEW_1},\n{VIEW_2}\n"
    "SELECT flight_number, origin, destination, aircraft_type, flight_status, passenger_count, disruption_id, severity, "
    "estimated_delay_mins, CAST(cost_estimate AS DOUBLE) AS cost_estimate, crew_id "
    "FROM view_2 WHERE is_unresolved = TRUE AND is_crew_disruption = TRUE",
    "disruption_summary": f"WITH {SUMMARY}\nSELECT * FROM summary",
    "summary_report": f"WITH {SUMMARY}\n"
    f"SELECT {_BY_DIGEST} AS summary_id, CAST(passenger_count AS BIGINT) AS passenger_count, "
    "* EXCLUDE (risk_flag, risk_reason, passenger_count) FROM summary",
    "crew_qualifications": f"WITH {CREW} SELECT crew_id, rating_1 AS aircraft_type FROM crew "
    "UNION ALL SELECT crew_id, rating_2 FROM crew",
    "crew_workload": f"WITH {WORKLOAD}\nSELECT * FROM workload",
    "crew_workload_report": f"WITH {WORKLOAD}\nSELECT * FROM workload ORDER BY total_cost_estimate DESC, crew_id",
    "marketing_leads": f"""WITH {LEADS}
SELECT customer_id, first_name || ' ' || last_name AS full_name, lower(email) AS email, city, state,
       CAST(months // 12 AS INTEGER) AS age,
       CASE WHEN date_of_birth IS NULL THEN 'unknown'
            WHEN months * 30 + days < 25 * 360 THEN '18-24' WHEN months * 30 + days < 35 * 360 THEN '25-34'
            WHEN months * 30 + days < 45 * 360 THEN '35-44' WHEN months * 30 + days < 55 * 360 THEN '45-54'
            ELSE '55+' END AS age_band,
       coalesce({_EMAIL_OK.format("email")}, FALSE) AS email_is_valid,
       TIMESTAMP '2020-06-15 12:00:00' AS loaded_at
FROM aged""",
    "invalid_email": f"WITH {CUSTOMERS} SELECT email, customer_id, last_name, first_name FROM contacts "
    f"WHERE email IS NOT NULL AND NOT {_EMAIL_OK.format('email')}",
    "email_validity": f"""WITH tokens AS (
  SELECT doc_id, unnest(regexp_split_to_array(text, '[ \\t\\r\\n]+')) AS token FROM documents
)
SELECT doc_id, token, {_EMAIL_OK.format("token")} AS is_valid FROM tokens WHERE contains(token, '@')""",
    "ensure_columns": f"WITH {SUMMARY}\n"
    "SELECT flight_number, flight_status, total_delay_mins, 'NORMAL' AS risk_flag, CAST(NULL AS VARCHAR) AS risk_reason "
    "FROM summary",
    "summary_upsert": f"""WITH {FLIGHTS},
{EVENTS},
{CREW},
{LATER_FLIGHTS},
{EARLY_EVENTS},
{_totals("early_totals", "early_events", "flights")},
{_risk("early", "early_totals", "2020-06-15 12:00:00")},
{_totals("later_totals", "disruptions", "later_flights")},
{_risk("later", "later_totals", "2020-06-15 18:00:00")},
target AS (SELECT *, {_BY_DIGEST} AS summary_id FROM early),
added AS (
  SELECT *, (SELECT max(summary_id) FROM target) + {_BY_DIGEST} AS summary_id
  FROM later WHERE flight_number NOT IN (SELECT flight_number FROM target)
),
updated AS (
  SELECT t.* REPLACE (
    l.flight_status AS flight_status, l.total_crew_disruptions AS total_crew_disruptions,
    l.critical_count AS critical_count, l.high_count AS high_count, l.medium_count AS medium_count,
    l.low_count AS low_count, l.total_delay_mins AS total_delay_mins, l.total_cost_estimate AS total_cost_estimate,
    l.affected_crew_count AS affected_crew_count, l.risk_flag AS risk_flag, l.risk_reason AS risk_reason,
    l.processed_at AS processed_at)
  FROM target t JOIN later l ON t.flight_number = l.flight_number
)
SELECT * FROM updated
UNION ALL BY NAME SELECT * FROM added
UNION ALL BY NAME SELECT * FROM target WHERE flight_number NOT IN (SELECT flight_number FROM later)""",
    "check_unique": f"WITH {FLIGHTS},\n{EVENTS},\n{CREW}\n"
    + "\nUNION ALL ".join(
        [
            _duplicates("disruptions", "disruption_id", "disruption_events.disruption_id"),
            _duplicates("flights", "flight_id", "flights.flight_id"),
            _duplicates("flights", "flight_number", "flights.flight_number"),
            _duplicates("crew", "crew_id", "crew_members.crew_id"),
            _duplicates("crew", "employee_id", "crew_members.employee_id"),
        ]
    ),
    "check_not_null": f"WITH {FLIGHTS},\n{EVENTS},\n{CREW}\n"
    + "\nUNION ALL ".join(
        [
            _null_counts(
                "disruptions",
                "disruption_events",
                "disruption_id flight_id disruption_type severity estimated_delay_mins cost_estimate reported_at "
                "created_at crew_id resolved_at",
            ),
            _null_counts(
                "flights",
                "flights",
                "flight_id flight_number origin destination scheduled_dep scheduled_arr aircraft_type status "
                "passenger_count created_at",
            ),
            _null_counts(
                "crew",
                "crew_members",
                "crew_id employee_id full_name role base_airport status hours_on_duty max_duty_hours created_at email",
            ),
        ]
    ),
    "check_fk": f"WITH {FLIGHTS},\n{EVENTS},\n{CREW},\nin_service AS (SELECT * FROM crew WHERE status <> 'GROUNDED')\n"
    + "\nUNION ALL ".join(
        [
            _orphans("flight_id", "flights", "flight known"),
            _orphans("crew_id", "crew", "crew known"),
            _orphans("crew_id", "in_service", "crew in service"),
        ]
    ),
    "check_length": f"WITH {FLIGHTS},\n{EVENTS},\n{CREW},\n{CUSTOMERS}\n"
    + "\nUNION ALL ".join(
        [
            _over_length(
                "flights", "flights", {"flight_number": 10, "origin": 3, "destination": 3, "aircraft_type": 10, "status": 20}
            ),
            _over_length("disruptions", "disruption_events", {"disruption_type": 30, "severity": 10}),
            _over_length(
                "crew",
                "crew_members",
                {"employee_id": 10, "full_name": 100, "email": 100, "role": 30, "base_airport": 3, "status": 20},
            ),
            _over_length(
                "contacts",
                "marketing_customer",
                {
                    "first_name": 50,
                    "last_name": 50,
                    "ssn": 11,
                    "email": 100,
                    "phone_number": 20,
                    "address_line1": 100,
                    "address_line2": 100,
                    "city": 50,
                    "state": 2,
                    "zip_code": 10,
                },
            ),
        ]
    ),
    "dq_sla": f"WITH {FLIGHTS},\n{EVENTS},\n{CREW}\n"
    + "\nUNION ALL ".join(
        [
            _score(
                "crew",
                "crew_members",
                ["full_name IS NOT NULL", "email IS NOT NULL", _EMAIL_OK.format("email"), "hours_on_duty <= max_duty_hours"],
            ),
            _score(
                "disruptions",
                "disruption_events",
                [
                    "flight_id IS NOT NULL",
                    "crew_id IS NOT NULL OR disruption_type = 'WEATHER'",
                    "severity IN ('CRITICAL', 'HIGH', 'MEDIUM', 'LOW')",
                    "cost_estimate >= 0",
                ],
            ),
            _score(
                "flights",
                "flights",
                ["flight_number IS NOT NULL", "scheduled_arr > scheduled_dep", "length(destination) <= 4"],
            ),
        ]
    ),
    "column_profile": f"""WITH {CUSTOMERS},
sampled AS (
  SELECT * FROM contacts
  WHERE CAST('0x' || substr(md5('sample|' || customer_id), 1, 8) AS BIGINT) * 100 < CAST(20 AS BIGINT) * 4294967296
)
{_profile("customer_id first_name last_name date_of_birth email address_line2 city state")}""",
    "lineage_events": f"""WITH {DOCS}
SELECT run_id, state AS event_type, ts AS event_time, 'scheduler' AS job_namespace, job AS job_name, parent_run_id,
       date_trunc('second', ts) AS nominal_start, date_trunc('second', ts) AS nominal_end,
       CAST(2 AS INTEGER) AS n_inputs, CAST(1 AS INTEGER) AS n_outputs, 'https://scheduler.example.com' AS producer
FROM docs""",
    "run_pairing": f"""WITH {DOCS},
paired AS (
  SELECT run_id, min(CASE WHEN state = 'START' THEN ts END) AS start_time,
         max(CASE WHEN state = 'COMPLETE' THEN ts END) AS complete_time
  FROM docs GROUP BY run_id
)
SELECT *, (epoch_us(complete_time) - epoch_us(start_time)) / 1000000.0::DOUBLE AS duration_secs,
       CASE WHEN start_time IS NULL AND complete_time IS NULL THEN 'BOTH' WHEN start_time IS NULL THEN 'START'
            WHEN complete_time IS NULL THEN 'COMPLETE' END AS missing_half
FROM paired""",
    "event_consistency": f"""WITH {DOCS},
per_run AS (
  SELECT run_id, count(CASE WHEN state = 'START' THEN 1 END) AS n_start,
         count(CASE WHEN state = 'COMPLETE' THEN 1 END) AS n_complete,
         count(DISTINCT parent_run_id) <= 1 AND count(parent_run_id) IN (0, count(*)) AS same_parent, bool_and(parent_run_id <> run_id) AS parent_is_other,
         min(CASE WHEN state = 'START' THEN ts END) AS s, max(CASE WHEN state = 'COMPLETE' THEN ts END) AS c,
         max(CASE WHEN scheduled THEN ts + INTERVAL 1 SECOND END) AS run_after
  FROM docs GROUP BY run_id
)
SELECT run_id, n_start, n_complete, same_parent, parent_is_other, coalesce(s <= c, TRUE) AS in_order,
       coalesce(run_after > s, FALSE) AS triggered_after_start,
       n_start > 0 AND n_complete > 0 AND same_parent AND parent_is_other AND coalesce(s <= c, TRUE) AS is_consistent
FROM per_run""",
    "rebase_events": f"""WITH {DOCS}
SELECT run_id AS old_run_id, state AS event_type,
       CASE WHEN scheduled AND is_start THEN {_REBASED}0.123456+00:00' WHEN scheduled THEN {_REBASED}3.544456+00:00'
            WHEN is_start THEN {_REBASED}0.000000+00:00' ELSE {_REBASED}3.421000+00:00' END AS event_time,
       {_uuid("run", "run_id")} AS run_id, {_uuid("parent", "parent_run_id")} AS parent_run_id,
       {_uuid("parent", "parent_run_id")} AS root_run_id,
       {_REBASED}0+00:00' AS nominal_start,
       CASE WHEN is_start THEN {_REBASED}0+00:00' ELSE {_REBASED}3+00:00' END AS nominal_end,
       CASE WHEN scheduled THEN {_uuid("task", "'task-' || run_no")} END AS task_id,
       CASE WHEN scheduled THEN 'manual__2026-03-01T10:20:31.123456+00:00' END AS run_name,
       CASE WHEN scheduled THEN {_REBASED}1.123456+00:00' END AS run_after,
       CASE WHEN scheduled THEN {_REBASED}1.398456+00:00' END AS start_date,
       CASE WHEN scheduled THEN {_REBASED}0+00:00' END AS logical_date,
       CASE WHEN scheduled THEN 'http://scheduler.example.com/dags/' || job
         || '/runs/manual__2026-03-01T10%3A20%3A31.123456%2B00%3A00/tasks/load?try_number=1' END AS log_url
FROM docs""",
    # objects come out with their fields sorted
    "json_rebase": f"""WITH {DOCS}
SELECT CASE WHEN scheduled AND is_start THEN {_REBASED}0.123456+00:00' WHEN scheduled THEN {_REBASED}3.544456+00:00'
            WHEN is_start THEN {_REBASED}0.000000+00:00' ELSE {_REBASED}3.421000+00:00' END AS event_time,
       state AS event_type, 'application/json' AS content_type, {_uuid("run", "run_id")} AS run_id,
       {_uuid("parent", "parent_run_id")} AS root_run_id, 'parent' AS parent_job,
       CASE WHEN is_start THEN {_REBASED}0+00:00' ELSE {_REBASED}3+00:00' END AS nominal_end,
       CASE WHEN scheduled THEN 'http://scheduler.example.com/dags/' || job
         || '/runs/manual__2026-03-01T10%3A20%3A31.123456%2B00%3A00/tasks/load?try_number=1' END AS log_url,
       CASE WHEN scheduled THEN '1' END AS try_number,
       '{{"_producer":"https://example.com/' || kind || '","deep":{{"col1":[{{"at":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')
         || '+00:00"}}]}},"kept":true,"props":{{"k":' || in_2 || '}},"tags":[' || in_1 || ',' || in_2 || ']}}' AS custom,
       event_id % 1000 AS row_count, db || '.public.t_' || in_1 AS first_input,
       CASE WHEN NOT is_start THEN '{{"inputFields":[{{"field":"c_2","name":"' || db || '.public.t_' || in_1 || '","namespace":"' || host
         || '"}},{{"field":"c_0","name":"' || db || '.public.t_' || in_2 || '","namespace":"' || host || '"}}]}}' END AS c_2_lineage
FROM docs""",
    "endpoint_alignment": f"""WITH {DOCS},
{LINEAGE}
SELECT 'postgres://warehouse-a:5432/' || db || '.public.t_' || outp AS dataset,
       'postgres://warehouse-a:5432/' || db || '.public.' || src AS src_dataset, count(*) AS n_events
FROM lineage GROUP BY ALL""",
    "lineage_edges": f"WITH {EDGES}\nSELECT * FROM edges",
    "lineage_gap": f"""WITH {EDGES}
SELECT src AS dataset, CAST(sum(n_events) AS BIGINT) AS n_reads FROM edges
WHERE kind = 'read' AND src NOT IN (SELECT dst FROM edges WHERE kind = 'write') GROUP BY src""",
    # time cut at every point of a dataset; a piece counts if some read and no write covers its start
    "lineage_gaps_over_time": f"""WITH {DOCS},
uses AS (
  SELECT 'warehouse/public.t_' || n AS dataset, 1 AS reads, 0 AS writes, ts AS a, ts + INTERVAL 6 HOUR AS z
  FROM (SELECT in_1 AS n, ts FROM docs WHERE state = 'START' UNION ALL SELECT in_2, ts FROM docs WHERE state = 'START')
  UNION ALL SELECT 'warehouse/public.t_' || outp, 0, 1, ts, ts + INTERVAL 1 DAY FROM docs WHERE state = 'COMPLETE'
),
points AS (SELECT DISTINCT dataset, t FROM (SELECT dataset, a AS t FROM uses UNION ALL SELECT dataset, z FROM uses)),
pieces AS (SELECT dataset, t, lead(t) OVER (PARTITION BY dataset ORDER BY t) AS until FROM points),
judged AS (
  SELECT p.dataset, p.t, p.until, coalesce(max(u.reads), 0) > 0 AND coalesce(max(u.writes), 0) = 0 AS lacking
  FROM pieces p LEFT JOIN uses u ON u.dataset = p.dataset AND u.a <= p.t AND p.t < u.z GROUP BY ALL
),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY t) - row_number() OVER (PARTITION BY dataset, lacking ORDER BY t) AS island
  FROM judged
)
SELECT dataset, min(t) AS gap_from, max(until) AS gap_to FROM numbered WHERE lacking GROUP BY dataset, island""",
    "lineage_class_edges": f"""WITH RECURSIVE {DOCS},
numbers AS (SELECT DISTINCT unnest([in_1, in_2, outp]) AS n FROM docs),
named AS (
  SELECT n, 'postgres://warehouse-a:5432/defaultdb.public.t_' || n AS a, 'postgres://warehouse-b:5432/postgres.public.t_' || n AS b,
         'postgres://warehouse-a:5432/defaultdb.public.t_' || (n + 1) AS following FROM numbers
),
pairs AS (
  SELECT a AS x, b AS y FROM named UNION SELECT b, a FROM named
  UNION SELECT a, following FROM named WHERE n % 4 <> 3 UNION SELECT following, a FROM named WHERE n % 4 <> 3
),
reach(x, y) AS (SELECT x, x FROM pairs UNION SELECT r.x, p.y FROM reach r JOIN pairs p ON p.x = r.y),
classes AS (SELECT x, min(y) AS class FROM reach GROUP BY x),
edges AS (
  SELECT src, dst, kind, count(DISTINCT event_id) AS n_events FROM (
    SELECT event_id, host || '/' || db || '.public.t_' || in_1 AS src, 'job:scheduler/' || job AS dst, 'read' AS kind FROM docs
    UNION ALL SELECT event_id, host || '/' || db || '.public.t_' || in_2, 'job:scheduler/' || job, 'read' FROM docs
    UNION ALL SELECT event_id, 'job:scheduler/' || job, host || '/' || db || '.public.t_' || outp, 'write' FROM docs
  ) GROUP BY ALL
)
SELECT coalesce(s.class, src) AS src, coalesce(d.class, dst) AS dst, kind, CAST(sum(n_events) AS BIGINT) AS n_events
FROM edges LEFT JOIN classes s ON s.x = src LEFT JOIN classes d ON d.x = dst GROUP BY ALL""",
    "lineage_column_edges": f"""WITH {DOCS},
{LINEAGE}
SELECT 'warehouse/public.t_' || outp AS dataset, col AS column_name, 'warehouse/public.' || src AS src_dataset,
       field AS src_column, count(*) AS n_events
FROM lineage GROUP BY ALL""",
    # every output has the columns c_0 to c_2, so entries of that name do not describe helpers
    "lineage_collapse": f"""WITH RECURSIVE {DOCS},
{LINEAGE},
helper AS (SELECT * FROM lineage WHERE col NOT IN ('c_0', 'c_1', 'c_2')),
reached(run_no, outp, col, src, field, is_first) AS (
  SELECT run_no, outp, col, src, field, TRUE FROM lineage
  UNION
  SELECT r.run_no, r.outp, r.col, h.src, h.field, FALSE
  FROM reached r JOIN helper h ON h.run_no = r.run_no AND h.col = r.field WHERE NOT starts_with(r.src, 't_')
),
ended AS (
  SELECT r.run_no, r.outp, r.col, r.src, r.field,
         CASE WHEN NOT starts_with(r.src, 't_') THEN 'unresolved' WHEN is_first THEN 'direct' ELSE 'collapsed' END AS status
  FROM reached r LEFT JOIN (SELECT DISTINCT run_no, col FROM helper) h ON h.run_no = r.run_no AND h.col = r.field
  WHERE starts_with(r.src, 't_') OR h.col IS NULL
),
all_ends AS (
  SELECT * FROM ended
  UNION
  SELECT l.run_no, l.outp, l.col, l.src, l.field, 'unresolved'
  FROM lineage l LEFT JOIN (SELECT DISTINCT run_no, col FROM ended) e ON e.run_no = l.run_no AND e.col = l.col
  WHERE e.col IS NULL
)
SELECT 'warehouse/public.t_' || outp AS dataset, col AS column_name, 'warehouse/public.' || src AS src_dataset,
       field AS src_column, status, count(*) AS n_events
FROM all_ends GROUP BY ALL""",
    # the columns of collapsed entries, as above; a group is what reaches each other
    "lineage_column_origins": f"""WITH RECURSIVE {DOCS},
links AS (
  SELECT DISTINCT 'warehouse/public.t_' || n || '/' || field AS src, 'warehouse/public.t_' || outp || '/' || col AS dst FROM (
    SELECT in_1 AS n, outp, field, col FROM docs, (VALUES ('c_1', 'c_1'), ('c_2', 'c_2'), ('c_0', 'c_0'), ('c_0', 'stage_a')) v(field, col)
    WHERE NOT is_start
    UNION ALL
    SELECT in_2, outp, field, col FROM docs, (VALUES ('c_0', 'c_2'), ('c_2', 'c_0'), ('c_2', 'stage_a'), ('c_2', 'stage_b')) v(field, col)
    WHERE NOT is_start
  )
),
nodes AS (SELECT src AS node FROM links UNION SELECT dst FROM links),
reach(x, y) AS (SELECT src, dst FROM links UNION SELECT r.x, l.dst FROM reach r JOIN links l ON l.src = r.y),
grouped AS (
  SELECT node, coalesce(min(least(node, a.y)), node) AS grp, bool_or(a.y = node) AS in_cycle
  FROM nodes LEFT JOIN (SELECT f.x, f.y FROM reach f JOIN reach t ON t.x = f.y AND t.y = f.x) a ON a.x = node GROUP BY node
),
entered AS (
  SELECT DISTINCT d.grp FROM links JOIN grouped s ON s.node = src JOIN grouped d ON d.node = dst WHERE s.grp <> d.grp
),
sources AS (SELECT node, grp FROM grouped WHERE grp NOT IN (SELECT grp FROM entered)),
walked(node, hops) AS (
  SELECT node, 0 FROM sources UNION SELECT dst, hops + 1 FROM walked JOIN links ON src = node WHERE hops < 60
),
near AS (SELECT node, min(hops) AS hops FROM walked GROUP BY node),
came(node, origin) AS (
  SELECT node, grp FROM sources
  UNION
  SELECT l.dst, c.origin FROM came c JOIN near n ON n.node = c.node JOIN links l ON l.src = c.node
  JOIN near m ON m.node = l.dst AND m.hops = n.hops + 1
)
SELECT near.node AS "column", min(origin) AS origin_column, CAST(near.hops AS INTEGER) AS hops, coalesce(any_value(in_cycle), FALSE) AS in_cycle
FROM near JOIN came ON came.node = near.node JOIN grouped ON grouped.node = near.node GROUP BY near.node, near.hops""",
    "lineage_schema_check": f"""WITH {DOCS},
{SCHEMAS},
ends AS (SELECT outp AS n, count(*) AS n_events FROM docs WHERE NOT is_start GROUP BY outp),
written AS (SELECT DISTINCT n, col FROM columns_seen WHERE role = 'writer'),
named AS (SELECT unnest(['c_0', 'c_1', 'c_2', 'risk', 'stage_a', 'stage_b', 'x_extra']) AS col)
SELECT 'warehouse/public.t_' || n AS dataset, col AS column_name, 'not in schema' AS problem, n_events
FROM ends CROSS JOIN named WHERE NOT EXISTS (SELECT 1 FROM written w WHERE w.n = ends.n AND w.col = named.col)
UNION ALL
SELECT 'warehouse/public.t_' || n, col, 'no lineage', n_events
FROM ends JOIN written USING (n) WHERE col NOT IN (SELECT col FROM named)""",
    "schema_drift": f"""WITH {DOCS},
{SCHEMAS},
r AS (SELECT n, col, min(type) AS reader_type FROM columns_seen WHERE role = 'reader' GROUP BY n, col),
w AS (SELECT n, col, min(type) AS writer_type FROM columns_seen WHERE role = 'writer' GROUP BY n, col)
SELECT 'warehouse/public.t_' || n AS dataset, col AS column_name, reader_type, writer_type,
       CASE WHEN reader_type IS NULL THEN 'only writer' WHEN writer_type IS NULL THEN 'only reader'
            ELSE 'other type' END AS status
FROM r FULL OUTER JOIN w USING (n, col)
WHERE n IN (SELECT n FROM r) AND n IN (SELECT n FROM w) AND reader_type IS DISTINCT FROM writer_type""",
    "lineage_upstream": _tree(
        "l.src, r.hops + 1 FROM reached r JOIN links l ON l.dst = r.node",
        "SELECT dst AS node FROM links WHERE dst NOT IN (SELECT src FROM links)",
    ),
    "lineage_downstream": _tree(
        "l.dst, r.hops + 1 FROM reached r JOIN links l ON l.src = r.node",
        "SELECT DISTINCT src AS node FROM links WHERE src NOT IN (SELECT dst FROM links)",
    ),
    "streaming_run_pairing": f"""WITH {DOCS}
SELECT s.run_id, s.ts AS start_time, c.ts AS complete_time,
       (epoch_us(c.ts) - epoch_us(s.ts)) / 1000000.0::DOUBLE AS duration_secs
FROM docs s JOIN docs c ON s.run_id = c.run_id
WHERE s.state = 'START' AND c.state = 'COMPLETE' AND c.ts >= s.ts AND c.ts <= s.ts + INTERVAL 5 MINUTE""",
    # an event is ignored if two files earlier the stream's clock had already passed it
    "streaming_run_states": f"""WITH {DOCS},
sliced AS (SELECT *, event_id * 6 // (SELECT count(*) FROM docs) AS slice FROM docs WHERE state <> 'FAIL'),
sent AS (
  SELECT *, CASE WHEN kind = 'purchase' AND event_id % 2 = 1 AND slice < 4 THEN slice + 2 ELSE slice END AS delivery FROM sliced
),
clock AS (
  SELECT d.n, least(max(CASE WHEN is_start THEN ts END), max(CASE WHEN NOT is_start THEN ts END)) AS seen
  FROM (SELECT unnest(range(6)) AS n) d JOIN sent s ON s.delivery <= d.n GROUP BY d.n
),
heard AS (
  SELECT s.* FROM sent s LEFT JOIN clock c ON c.n = s.delivery - 2
  WHERE c.seen IS NULL OR s.ts > date_trunc('millisecond', c.seen) - INTERVAL 2 HOUR
),
runs AS (
  SELECT run_id, min(CASE WHEN is_start THEN ts END) AS start_time, max(CASE WHEN NOT is_start THEN ts END) AS complete_time
  FROM heard GROUP BY run_id
)
SELECT *, (epoch_us(complete_time) - epoch_us(start_time)) / 1000000.0::DOUBLE AS duration_secs,
       CASE WHEN complete_time IS NULL THEN 'never completed' WHEN start_time IS NULL THEN 'no start'
            WHEN complete_time >= start_time AND complete_time <= start_time + INTERVAL 5 MINUTE THEN 'paired'
            ELSE 'late' END AS state
FROM runs""",
}

_BROKEN = """broken AS (
  SELECT customer_id, first_name IS NULL AS a, date_of_birth IS NULL AS b, length(email) > 23 AS c, email IS NULL AS d,
         length(address_line1) > 17 AS e, CAST(zip_code AS INTEGER) > 32767 AS f
  FROM contacts
),
problems AS (
  SELECT customer_id, concat_ws(', ', CASE WHEN a THEN 'first_name must not be NULL' END, CASE WHEN b THEN 'date_of_birth must not be NULL' END,
         CASE WHEN c THEN 'email is longer than 23' END, CASE WHEN d THEN 'email must not be NULL' END,
         CASE WHEN e THEN 'address_line1 is longer than 17' END, CASE WHEN f THEN 'zip_code does not fit smallint' END) AS problem
  FROM broken
)"""

_COUNTED = [
    *[(f"{c} does not fit {t}", "count_if(FALSE)") for c, t in (("customer_id", "bigint"), ("first_name", "string"), ("date_of_birth", "date"), ("email", "string"), ("address_line1", "string"))],
    ("customer_id must not be NULL", "count_if(FALSE)"), ("first_name is longer than 50", "count_if(FALSE)"), ("rows", "count(*)"), ("broken", "count_if(a OR b OR c OR d OR e OR f)"),
    ("first_name must not be NULL", "count_if(a)"), ("date_of_birth must not be NULL", "count_if(b)"), ("email is longer than 23", "count_if(c)"),
    ("email must not be NULL", "count_if(d)"), ("address_line1 is longer than 17", "count_if(e)"), ("zip_code does not fit smallint", "count_if(f)"),
]


def _sketched(name: str, distinct: str, median: str) -> str:
    return (
        f"SELECT '{name}' AS column_name, count(*) AS n_rows, count(*) - count({name}) AS n_nulls, CAST(min({name}) AS VARCHAR) AS min_value, "
        f"CAST(max({name}) AS VARCHAR) AS max_value, {distinct} AS distinct_in_bounds, {median} AS median_in_bounds FROM disruptions"
    )


ORACLE |= {
    "load_new_flights": f"""WITH {FLIGHTS}
SELECT * REPLACE ('SCHEDULED' AS status, CAST(0 AS BIGINT) AS passenger_count, TIMESTAMP '2020-06-15 12:00:00' AS created_at) FROM flights""",
    "load_checked_contacts": f"WITH {CUSTOMERS},\n{_BROKEN}\n"
    "SELECT 'target' AS place, 'false' AS problem, count(*) AS n_rows FROM problems WHERE problem = ''\n"
    "UNION ALL SELECT 'quarantine', problem, count(*) FROM problems WHERE problem <> '' GROUP BY problem\n"
    + "\n".join(f"UNION ALL SELECT 'count', '{text}', CAST({count} AS BIGINT) FROM broken" for text, count in _COUNTED),
    "load_retention": f"""WITH {EVENTS},
{EARLY_EVENTS},
{CREW}
SELECT count(DISTINCT c.crew_id) AS n_rows, count(*) AS n_disruptions FROM early_events e JOIN crew c ON c.crew_id = e.crew_id""",
    "distinct_by_month": f"""WITH {EVENTS}
SELECT severity, 'flight_id' AS value_name, count(DISTINCT flight_id) AS n_distinct FROM disruptions GROUP BY severity
UNION ALL SELECT severity, 'crew_id', count(DISTINCT crew_id) FROM disruptions GROUP BY severity""",
    "column_profile_sketches": f"WITH {EVENTS}\n"
    + "\nUNION ALL ".join(
        _sketched(name, "TRUE" if name in ("flight_id", "crew_id", "severity", "estimated_delay_mins") else "NULL", median)
        for name, median in {
            "disruption_id": "TRUE", "flight_id": "TRUE", "crew_id": "TRUE", "disruption_type": "NULL", "severity": "NULL", "description": "NULL",
            "estimated_delay_mins": "TRUE", "cost_estimate": "TRUE", "reported_at": "NULL", "resolved_at": "NULL", "created_at": "NULL",
        }.items()
    ),
}

# loads end in what their queries give for the same rows, documents in JSON in what the documents themselves give
ORACLE |= {
    "load_crew_workload": f"WITH {WORKLOAD}\nSELECT * REPLACE (TIMESTAMP '2020-06-15 18:00:00' AS refreshed_at) FROM workload",
    "load_marketing_leads": f"SELECT * REPLACE (TIMESTAMP '2020-06-15 18:00:00' AS loaded_at) FROM ({ORACLE['marketing_leads']})",
    "load_invalid_email": f"WITH once AS ({ORACLE['invalid_email']}) SELECT * FROM once UNION ALL SELECT * FROM once",
    "load_disruption_summary": f"""WITH day_1 AS ({ORACLE["summary_upsert"]}),
{FLIGHTS},
{EVENTS},
{CREW},
{LATER_FLIGHTS},
{_totals("later_totals", "disruptions", "later_flights")},
{_risk("later", "later_totals", "2020-06-15 18:00:00")},
day_2 AS (
  SELECT * REPLACE ('2020-06-16' AS summary_date), (SELECT max(summary_id) FROM day_1)
         + {_BY_DIGEST.replace("2020-06-15", "2020-06-16")} AS summary_id
  FROM later
)
SELECT * FROM day_1 UNION ALL BY NAME SELECT * FROM day_2""",
    "staging_by_view": ORACLE["staging_filter"],
    "json_lineage_edges": ORACLE["lineage_edges"],
    "json_run_pairing": ORACLE["run_pairing"],
    "json_schema_drift": ORACLE["schema_drift"],
}
