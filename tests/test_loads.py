import datetime as dt
import tempfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tarmac import schemas, session
from tarmac.operators import merge
from tarmac.operators.conform import apply_defaults, conform, ensure_columns
from tarmac.operators.constraints import ConstraintError
from tarmac.operators.merge import SUMMARY_UPDATES, assign_ids, merge_rows
from tarmac.operators.summary import summary_report
from tarmac.sinks import loads, tables
from tarmac.sinks.tables import full_refresh, reset
from tests import fixtures as fx

LATER = dt.datetime(2026, 4, 12, 18, 0)


@pytest.fixture
def place(spark):
    yield tempfile.mkdtemp(prefix="tarmac-load-")
    reset(
        spark,
        ["vw_crew_disruption_detail", "vw_flight_disruptions"],
        ["marketing_leads", "invalid_email", "disruption_summary", "crew_workload_summary"],
    )


def stored(spark, name="disruption_summary"):
    return {r["flight_number"]: r.asDict() for r in spark.table(name).collect()}


def test_summary_load_twice_and_after_changes(spark, place):
    events, flights, crew = fx.events(spark), fx.flights(spark), fx.crew(spark)
    loads.load_disruption_summary(events, flights, crew, place, fx.AS_OF, fx.RUN_TS)
    first = stored(spark)
    assert spark.table("disruption_summary").count() == 4
    assert sorted(r["summary_id"] for r in first.values()) == [1, 2, 3, 4]
    assert len(summary_report(spark.table("disruption_summary")).columns) == 17

    loads.load_disruption_summary(events, flights, crew, place, fx.AS_OF, LATER)
    again = stored(spark)
    assert {k: v | {"processed_at": None} for k, v in again.items()} == {
        k: v | {"processed_at": None} for k, v in first.items()
    }
    assert {r["processed_at"] for r in again.values()} == {LATER}

    # UA707 is resolved, UA202 gets a crew event, UA101 changes its passengers, route and status
    changed_events = events.withColumns(
        {
            "resolved_at": F.when(F.col("flight_id") == 7, F.lit(LATER).cast("timestamp_ntz")).when(
                F.col("flight_id") != 2, F.col("resolved_at")
            ),
            "disruption_type": F.when(F.col("flight_id") == 2, F.lit("CREW_SICK")).otherwise(F.col("disruption_type")),
        }
    )
    changed_flights = flights.withColumns(
        {
            "passenger_count": F.col("passenger_count") + 1,
            "origin": F.lit("XXX"),
            "status": F.lit("DEPARTED"),
        }
    )
    end = dt.datetime(2026, 4, 12, 20, 0)
    loads.load_disruption_summary(changed_events, changed_flights, crew, place, fx.AS_OF, end)
    final = stored(spark)
    assert final["UA707"] == again["UA707"]  # stays as it was
    assert final["UA101"]["flight_status"] == "DEPARTED" and final["UA101"]["processed_at"] == end
    for kept in ("origin", "destination", "aircraft_type", "passenger_count", "summary_id"):
        assert final["UA101"][kept] == first["UA101"][kept]
    assert final["UA202"]["summary_id"] == 5 and final["UA202"]["origin"] == "XXX"
    assert final["UA202"]["risk_flag"] == "NORMAL" and final["UA202"]["affected_crew_count"] == 0

    # another day leaves this one alone
    tomorrow = fx.AS_OF + dt.timedelta(days=1)
    loads.load_disruption_summary(events, flights, crew, place, tomorrow, end)
    both = spark.table("disruption_summary")
    assert both.filter(F.col("summary_date") == F.lit(fx.AS_OF)).count() == 5 and both.count() == 9
    assert sorted(r[0] for r in both.select("summary_id").collect()) == list(range(1, 10))


def test_older_summary_table_gets_the_risk_columns(spark, place):
    old = [c for c in schemas.DISRUPTION_SUMMARY.columns if not c.name.startswith("risk_")]
    spark.sql(
        f"CREATE TABLE disruption_summary ({', '.join(f'{c.name} {c.type}' for c in old)}) "
        f"USING parquet PARTITIONED BY (summary_date) LOCATION '{place}/old'"
    )
    row = spark.sql(
        "SELECT 7 summary_id, 'UA101' flight_number, 'AAA' origin, 'BBB' destination, 'B737' aircraft_type, "
        "'DELAYED' flight_status, 1 passenger_count, 1 total_crew_disruptions, 0 critical_count, 0 high_count, "
        "0 medium_count, 1 low_count, 5 total_delay_mins, CAST(1 AS DECIMAL(12,2)) total_cost_estimate, "
        "1 affected_crew_count, TIMESTAMP_NTZ'2026-04-01 00:00:00' processed_at, DATE'2026-04-01' summary_date"
    )
    row.write.insertInto("disruption_summary")
    events, flights, crew = fx.events(spark), fx.flights(spark), fx.crew(spark)
    loads.load_disruption_summary(events, flights, crew, place, fx.AS_OF, fx.RUN_TS)
    shown = {r["summary_id"]: (r["flight_number"], r["risk_flag"], r["risk_reason"]) for r in spark.table("disruption_summary").collect()}
    assert shown[7] == ("UA101", "NORMAL", None)
    assert sorted(shown) == [7, 8, 9, 10, 11] and len(spark.table("disruption_summary").columns) == 19


def test_summary_load_refuses_a_key_twice(spark, place):
    events, flights, crew = fx.events(spark), fx.flights(spark), fx.crew(spark)
    loads.load_disruption_summary(events, flights, crew, place, fx.AS_OF, fx.RUN_TS)
    doubled = flights.withColumn("flight_number", F.lit("UA1"))
    with pytest.raises(ConstraintError, match="UA1 occurs 4 times"):
        loads.load_disruption_summary(events, doubled, crew, place, fx.AS_OF, LATER)
    assert stored(spark).keys() == {"UA101", "UA303", "UA404", "UA707"}


def test_summary_load_stores_and_shuffles_its_rows_once(spark, place, monkeypatch):
    kept, plans = [], []
    write = tables._write_partitions
    monkeypatch.setattr(merge, "stored", lambda df, label: kept.append(set(df.columns)) or session.stored(df, label))

    def planned(rows, *args):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        write(rows, *args)

    monkeypatch.setattr(tables, "_write_partitions", planned)
    # as for large rows, and other partitions than buckets
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "5"}
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        for run_ts in (fx.RUN_TS, LATER):
            loads.load_disruption_summary(fx.events(spark), fx.flights(spark), fx.crew(spark), place, fx.AS_OF, run_ts)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    # beside the staged source only keys and ids are stored; target and source stay in their buckets, ids are dealt like them
    assert kept and all(columns <= {"summary_date", "flight_number", "summary_id"} for columns in kept)
    for plan in plans:
        dealt = [x for x in plan.splitlines() if "Exchange hashpartitioning(" in x and "id_bucket" not in x]
        assert len(dealt) == 1 and "hashpartitioning(flight_number#" in dealt[0] and ", 8), ENSURE" in dealt[0]
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("disruption_summary")] == ["disruption_summary"]


def test_full_refresh_replaces_and_survives_a_failed_load(spark, place):
    events, crew = fx.events(spark), fx.crew(spark)
    loads.load_crew_workload(crew, events, place, fx.RUN_TS)
    assert sorted(r[0] for r in spark.table("crew_workload_summary").select("crew_id").collect()) == [2, 3, 5, 9]
    loads.load_crew_workload(crew, events.filter("crew_id <> 9"), place, LATER)
    assert sorted(r[0] for r in spark.table("crew_workload_summary").select("crew_id").collect()) == [2, 3, 5]
    with pytest.raises(ConstraintError):
        loads.load_crew_workload(crew.union(crew), events, place, LATER)
    too_much = events.withColumn("estimated_delay_mins", F.lit(2_000_000_000).cast("bigint"))
    with pytest.raises(Exception, match="total_delay_mins does not fit int"):
        loads.load_crew_workload(crew, too_much, place, LATER)
    assert spark.table("crew_workload_summary").count() == 3


def test_contact_loads(spark, place):
    customers = fx.customers(spark)
    for _ in range(2):
        loads.load_marketing_leads(customers, place, fx.AS_OF, fx.RUN_TS)
    assert spark.table("marketing_leads").count() == 102
    loads.load_invalid_email(customers, place)
    assert [tuple(r)[1:] for r in spark.table("invalid_email").orderBy("customer_id").collect()] == [
        (2, "Thorne", "Milo"),
        (57, "Quill", "Vera"),
    ]
    loads.load_invalid_email(customers, place)
    assert spark.table("invalid_email").count() == 4  # an append, not a refresh


def test_reset_is_repeatable(spark):
    for _ in range(2):
        reset(spark, ["no_view"], ["no_table"])


def test_merge_takes_nulls_and_keeps_other_columns(spark):
    ddl = "k int, a string, b string, only_target int"
    target = spark.createDataFrame([(1, "a1", "b1", 10), (2, "a2", "b2", 20), (4, "a4", "b4", 40)], ddl)
    source = spark.createDataFrame([(1, "A1", None), (3, "A3", "B3")], "k int, a string, b string")
    got = sorted(tuple(r) for r in merge_rows(target, source, ["k"], ["b"]).collect())
    assert got == [(1, "a1", None, 10), (2, "a2", "b2", 20), (3, "A3", "B3", None), (4, "a4", "b4", 40)]


def test_ids_are_dense_unique_and_repeatable(spark):
    rows = spark.range(20000).select(F.concat(F.lit("F"), "id").alias("k"))
    got = {r["k"]: r["id"] for r in assign_ids(rows, ["k"], "id", 100).collect()}
    assert sorted(got.values()) == list(range(101, 20101))
    assert {r["k"]: r["id"] for r in assign_ids(rows.repartition(3), ["k"], "id", 100).collect()} == got


def test_columns_and_defaults(spark):
    old = spark.createDataFrame([("UA1", None)], "flight_number string, risk_reason string")
    added = ensure_columns(old, {"risk_flag": ("string", "NORMAL"), "risk_reason": ("string", "?")})
    assert added.first().asDict() == {"flight_number": "UA1", "risk_reason": None, "risk_flag": "NORMAL"}
    assert ensure_columns(added, {"risk_flag": ("string", "X")}).first()["risk_flag"] == "NORMAL"

    flight = spark.createDataFrame([("UA1", None)], "flight_number string, status string")
    filled = apply_defaults(flight, schemas.FLIGHTS, fx.RUN_TS).first()
    assert (filled["status"], filled["passenger_count"], filled["created_at"]) == (None, 0, fx.RUN_TS)
    crew = apply_defaults(spark.createDataFrame([(1,)], "crew_id int"), schemas.CREW_MEMBERS, fx.RUN_TS).first()
    assert (crew["max_duty_hours"], crew["status"], crew["email"]) == (Decimal("12.0"), "AVAILABLE", None)


@pytest.mark.parametrize(
    ("column", "value", "problem"),
    [
        ("flight_number", "'UA123456789'", "longer than 10"),
        ("passenger_count", "3000000000", "does not fit int"),
        ("origin", "CAST(NULL AS STRING)", "must not be NULL"),
    ],
)
def test_conform_ends_the_job(spark, column, value, problem):
    bad = fx.flights(spark).withColumn(column, F.expr(value))
    with pytest.raises(Exception, match=problem):
        conform(bad, schemas.FLIGHTS).collect()


def test_table_shapes(spark):
    assert [len(t.columns) for t in (schemas.DISRUPTION_SUMMARY, schemas.CREW_WORKLOAD_SUMMARY)] == [19, 14]
    assert [len(t.columns) for t in (schemas.MARKETING_LEADS, schemas.INVALID_EMAIL)] == [9, 4]
    for table in schemas.TABLES.values():
        assert table.schema.names == table.names
    wide = schemas.DISRUPTION_SUMMARY.widened()
    assert wide["total_delay_mins"].type == "bigint" and wide["total_cost_estimate"].type == "decimal(20,2)"


def test_refresh_of_an_empty_result(spark, place):
    nobody = fx.customers(spark).limit(0)
    full_refresh(nobody.select("email", "customer_id", "last_name", "first_name"), schemas.INVALID_EMAIL, "invalid_email", place)
    assert spark.table("invalid_email").count() == 0
