"""Every operator as a query over the given tables: name -> function of (session, folder)."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac import schemas
from tarmac.functions.text import email_matches
from tarmac.operators import (
    constraints,
    dataset_classes,
    distinct_rollup,
    lineage_cycles,
    lineage_data,
    lineage_documents,
    lineage_graph,
    lineage_runs,
    lineage_times,
    marketing,
    merge,
    quality,
    summary,
    views,
    workload,
)
from tarmac.operators.conform import apply_defaults, conform, ensure_columns
from tarmac.session import scratch_path, stored
from tarmac.sinks import loads
from tarmac.sinks.checked import checked_refresh
from tarmac.sinks.documents import write_documents
from tarmac.sinks.retention import unused_folders
from tarmac.sinks.tables import append, ensure_table, reset
from tarmac.sources import bindings as b
from tarmac.sources.lineage_events import SCHEDULER_FACET, read_documents, read_events
from tarmac.sources.tables import read_table
from tarmac.streaming.run_pairing import pair_or_release, pair_runs, run_states, write_available

Query = Callable[[SparkSession, str], DataFrame]

SECOND_RUN_TS = dt.datetime(2020, 6, 15, 18, 0, 0)
REBASE_NOW = dt.datetime(2026, 3, 1, 10, 20, 30, 123456)
REBASE_SEED = "rebase"
#: Documents repeat their names and addresses: written plain they are many times their events. Compressed files do not
#: split, and a task reads as many as fit into its bytes and the cost of opening each, so they are kept small. The third
#: level makes them 1.3 times as large as the usual sixth in half of its time.
JSON_FILES = {"compression": "gzip", "maxRecordsPerFile": "5000", "zlib.compress.level": "THREE"}
PROFILE_PERCENT = 20
PROFILE_COLUMNS = ["customer_id", "first_name", "last_name", "date_of_birth", "email", "address_line2", "city", "state"]


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles, dates and arrays as text, so that other engines print the same values."""

    def plain(field: T.StructField) -> F.Column:
        if isinstance(field.dataType, T.DecimalType):
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return F.col(field.name).cast("string").alias(field.name)
        if isinstance(field.dataType, T.ArrayType):
            return F.array_join(field.name, "|").alias(field.name)
        return F.col(field.name)

    return df.select(*[plain(f) for f in df.schema.fields])


def _detail(spark: SparkSession, folder: str, **only: bool) -> DataFrame:
    disruptions = views.flight_disruptions(b.disruption_events(spark, folder, **only), b.flights(spark, folder))
    return views.crew_disruption_detail(disruptions, b.crew_members(spark, folder))


def _summary(spark: SparkSession, folder: str) -> DataFrame:
    events = b.disruption_events(spark, folder, open_crew_only=True)
    return summary.disruption_summary(
        events, b.flights(spark, folder), b.crew_members(spark, folder), b.AS_OF, b.RUN_TS
    )


# -- views, summary, workload ---------------------------------------------------------------------


def scan_project(spark: SparkSession, folder: str) -> DataFrame:
    return b.crew_members(spark, folder).select(
        "crew_id", F.col("full_name").alias("crew_name"), F.col("status").alias("crew_status"), "base_airport"
    )


def scan_sources(spark: SparkSession, folder: str) -> DataFrame:
    """The four source tables, stored in their declared shape and scanned with their declared schemas."""
    sources = [
        (schemas.FLIGHTS, b.flights(spark, folder), "flight_id", "destination", "scheduled_arr"),
        (schemas.DISRUPTION_EVENTS, b.disruption_events(spark, folder), "disruption_id", "severity", "resolved_at"),
        (schemas.CREW_MEMBERS, b.crew_members(spark, folder), "crew_id", "base_airport", "created_at"),
        (schemas.MARKETING_CUSTOMER, b.marketing_customer(spark, folder), "customer_id", "state", "date_of_birth"),
    ]
    parts = []
    for table, rows, key, label, at in sources:
        place, wide = scratch_path(spark, table.name), table.widened()
        conform(apply_defaults(rows, wide, b.RUN_TS), wide).write.parquet(place)
        found = read_table(spark, wide, place)
        parts.append(found.select(F.lit(table.name).alias("source"), F.col(key).alias("key"), F.col(label).alias("label"), F.col(at).cast("timestamp_ntz").alias("at")))
    return reduce(DataFrame.unionByName, parts)


def flight_disruptions(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(views.flight_disruptions(b.disruption_events(spark, folder), b.flights(spark, folder)))


def crew_disruption_detail(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(_detail(spark, folder))


def staging_filter(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(summary.staging(_detail(spark, folder, open_crew_only=True)))


def disruption_summary(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(_summary(spark, folder))


def summary_report(spark: SparkSession, folder: str) -> DataFrame:
    source = stored(_summary(spark, folder), "summary")
    numbered = merge.assign_ids(source, ["summary_date", "flight_number"], "summary_id")
    return comparable(summary.summary_report(conform(numbered, schemas.DISRUPTION_SUMMARY.widened())))


def crew_qualifications(spark: SparkSession, folder: str) -> DataFrame:
    return views.crew_qualifications(b.crew_members(spark, folder))


def _workload(spark: SparkSession, folder: str) -> DataFrame:
    loaded = workload.crew_workload(b.crew_members(spark, folder), b.disruption_events(spark, folder), b.RUN_TS)
    keys_64_bit = schemas.CREW_WORKLOAD_SUMMARY.widened()
    return conform(loaded, keys_64_bit)


def crew_workload(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(_workload(spark, folder))


def crew_workload_report(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(workload.workload_report(_workload(spark, folder)))


# -- contacts ------------------------------------------------------------------------------------


def marketing_leads(spark: SparkSession, folder: str) -> DataFrame:
    return marketing.marketing_leads(b.marketing_customer(spark, folder), b.AS_OF, b.RUN_TS)


def invalid_email(spark: SparkSession, folder: str) -> DataFrame:
    return marketing.invalid_email(b.marketing_customer(spark, folder))


def email_validity(spark: SparkSession, folder: str) -> DataFrame:
    return marketing.email_validity(b.star_table(spark, folder, "documents"), "doc_id", "text")


# -- sinks ---------------------------------------------------------------------------------------


def ensured_columns(spark: SparkSession, folder: str) -> DataFrame:
    events = b.disruption_events(spark, folder, open_crew_only=True)
    old = summary.summarize_events(events, b.flights(spark, folder), b.crew_members(spark, folder)).select("flight_number", "flight_status", "total_delay_mins")
    return ensure_columns(
        old, {"risk_flag": ("string", "NORMAL"), "risk_reason": ("string", None), "flight_status": ("string", "?")}
    )


def summary_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """A first load of the day, then a second one that sees all events, some resolved, and later flights."""
    flights, crew = b.flights(spark, folder), b.crew_members(spark, folder)
    events = b.disruption_events(spark, folder)
    keys = ["summary_date", "flight_number"]
    first = summary.disruption_summary(b.first_load_events(events), flights, crew, b.AS_OF, b.RUN_TS)
    target = stored(merge.assign_ids(stored(first, "first"), keys, "summary_id"), "target")
    open_events = b.disruption_events(spark, folder, open_crew_only=True)
    second = summary.disruption_summary(open_events, b.second_load_flights(flights), crew, b.AS_OF, SECOND_RUN_TS)
    last_id = target.agg(F.max("summary_id")).scalar()
    merged = merge.upsert_rows(target, stored(second, "second"), keys, list(merge.SUMMARY_UPDATES), "summary_id", last_id)
    return comparable(merged)


def _loaded(spark: SparkSession, load: Callable[[str, str], None]) -> DataFrame:
    """What a new catalog table holds after the load of (table name, folder); the table is dropped again."""
    name = f"load_{uuid.uuid4().hex}"
    load(name, scratch_path(spark, "load"))
    rows = stored(spark.table(name), "loaded")
    reset(spark, [], [name])
    return comparable(rows)


def load_disruption_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Two loads of a day, the second with resolved events and later flights, and one of the next day."""
    flights, crew = b.flights(spark, folder), b.crew_members(spark, folder)
    open_events = b.disruption_events(spark, folder, open_crew_only=True)
    first = b.first_load_events(b.disruption_events(spark, folder))
    later, table = b.second_load_flights(flights), schemas.DISRUPTION_SUMMARY.widened()
    next_day = b.AS_OF + dt.timedelta(days=1)

    def load(name: str, place: str) -> None:
        loads.load_disruption_summary(first, flights, crew, place, b.AS_OF, b.RUN_TS, name, table)
        loads.load_disruption_summary(open_events, later, crew, place, b.AS_OF, SECOND_RUN_TS, name, table)
        loads.load_disruption_summary(open_events, later, crew, place, next_day, SECOND_RUN_TS, name, table)

    return _loaded(spark, load)


def load_crew_workload(spark: SparkSession, folder: str) -> DataFrame:
    """A full refresh from some of the events, then one from all."""
    crew, events = b.crew_members(spark, folder), b.disruption_events(spark, folder)
    table = schemas.CREW_WORKLOAD_SUMMARY.widened()

    def load(name: str, place: str) -> None:
        loads.load_crew_workload(crew, b.first_load_events(events), place, b.RUN_TS, name, table)
        loads.load_crew_workload(crew, events, place, SECOND_RUN_TS, name, table)

    return _loaded(spark, load)


def load_invalid_email(spark: SparkSession, folder: str) -> DataFrame:
    """Two deliveries of the customers, both appended."""
    customers, table = b.marketing_customer(spark, folder), schemas.INVALID_EMAIL.widened()

    def load(name: str, place: str) -> None:
        for _ in range(2):
            loads.load_invalid_email(customers, place, name, table)

    return _loaded(spark, load)


def load_marketing_leads(spark: SparkSession, folder: str) -> DataFrame:
    """A refresh of the leads, then one at a later time that replaces all rows."""
    customers, table = b.marketing_customer(spark, folder), schemas.MARKETING_LEADS.widened()

    def load(name: str, place: str) -> None:
        for run_ts in (b.RUN_TS, SECOND_RUN_TS):
            loads.load_marketing_leads(customers, place, b.AS_OF, run_ts, name, table)

    return _loaded(spark, load)


def load_new_flights(spark: SparkSession, folder: str) -> DataFrame:
    """Flights inserted without status, passengers and time of creation, which take their defaults."""
    table = schemas.FLIGHTS.widened()
    given = b.flights(spark, folder).drop("status", "passenger_count", "created_at")

    def load(name: str, place: str) -> None:
        ensure_table(spark, table, name, place)
        append(apply_defaults(given, table, b.RUN_TS), table, name)

    return _loaded(spark, load)


#: Contacts that somebody can be written to: rules that many rows of the source break.
REACHABLE = schemas.Table(
    "reachable",
    (
        schemas.Column("customer_id", "bigint", True),
        schemas.Column("first_name", "string", True, 50),
        schemas.Column("date_of_birth", "date", True),
        schemas.Column("email", "string", True, 23),
        schemas.Column("address_line1", "string", False, 17),
        schemas.Column("zip_code", "smallint"),
    ),
)


def load_checked_contacts(spark: SparkSession, folder: str) -> DataFrame:
    """What a load that sets broken rows apart leaves in the table, in the quarantine, and in the counts of its one pass."""
    name, place = f"load_{uuid.uuid4().hex}", scratch_path(spark, "load")
    counts = checked_refresh(b.marketing_customer(spark, folder), REACHABLE, name, f"{name}_broken", place)
    problem, n_rows = F.array_join("problems", ", ").alias("problem"), F.count(F.lit(1)).alias("n_rows")
    target = spark.table(name).select(F.lit("target").alias("place"), F.col("date_of_birth").isNull().cast("string").alias("problem"))
    broken = spark.table(f"{name}_broken").select(F.lit("quarantine").alias("place"), problem)
    found = stored(target.unionByName(broken).groupBy("place", "problem").agg(n_rows), "loaded")
    reset(spark, [], [name, f"{name}_broken"])
    counted = spark.createDataFrame([("count", text, n) for text, n in counts.items()], found.schema)
    return found.unionByName(counted)


def load_retention(spark: SparkSession, folder: str) -> DataFrame:
    """Rows in the folders that two refreshes leave without a table pointing at them."""
    crew, events = b.crew_members(spark, folder), b.disruption_events(spark, folder)
    name, place, table = f"load_{uuid.uuid4().hex}", scratch_path(spark, "load"), schemas.CREW_WORKLOAD_SUMMARY.widened()
    for seen in (b.first_load_events(events), events):
        loads.load_crew_workload(crew, seen, place, b.RUN_TS, name, table)
    unused = unused_folders(spark, [name], place, dt.datetime(9999, 1, 1), dt.timedelta(days=1))
    # one row per load
    folders = [r.folder for r in unused.collect()]
    rows = spark.read.schema(table.schema).option("recursiveFileLookup", True).parquet(*folders)
    counted = stored(rows.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("disruption_count").cast("bigint").alias("n_disruptions")), "unused")
    reset(spark, [], [name])
    return counted


def staging_by_view(spark: SparkSession, folder: str) -> DataFrame:
    """The staging rows through the registered views, read by name."""
    events = b.disruption_events(spark, folder, open_crew_only=True)
    prefix = f"vw_{uuid.uuid4().hex}_"
    name = views.register_views(spark, events, b.flights(spark, folder), b.crew_members(spark, folder), prefix)
    rows = spark.table(name)
    reset(spark, [name, f"{prefix}flight_disruptions"], [])
    return comparable(summary.staging(rows))


# -- constraints and quality -----------------------------------------------------------------------


def check_unique(spark: SparkSession, folder: str) -> DataFrame:
    checked = [
        (b.disruption_events(spark, folder), "disruption_events", ["disruption_id"]),
        (b.flights(spark, folder), "flights", ["flight_id", "flight_number"]),
        (b.crew_members(spark, folder), "crew_members", ["crew_id", "employee_id"]),
    ]
    return reduce(
        DataFrame.unionByName,
        [constraints.duplicate_keys_in(df, {f"{name}.{key}": [key] for key in keys}) for df, name, keys in checked],
    )


def check_not_null(spark: SparkSession, folder: str) -> DataFrame:
    sources = [
        (b.disruption_events(spark, folder), schemas.DISRUPTION_EVENTS, ["crew_id", "resolved_at"]),
        (b.flights(spark, folder), schemas.FLIGHTS, []),
        (b.crew_members(spark, folder), schemas.CREW_MEMBERS, ["email"]),
    ]
    return reduce(
        DataFrame.unionByName,
        [constraints.null_counts(df, table.required + optional, table.name) for df, table, optional in sources],
    )


def check_fk(spark: SparkSession, folder: str) -> DataFrame:
    """References of events, and events whose crew member is no longer in service."""
    crew = b.crew_members(spark, folder)
    references = [
        ("flight known", "flight_id", b.flights(spark, folder), "flight_id"),
        ("crew known", "crew_id", crew, "crew_id"),
        ("crew in service", "crew_id", crew.filter("status <> 'GROUNDED'"), "crew_id"),
    ]
    return constraints.orphans_in(b.disruption_events(spark, folder), references)


def check_length(spark: SparkSession, folder: str) -> DataFrame:
    sources = [
        (b.flights(spark, folder), schemas.FLIGHTS),
        (b.disruption_events(spark, folder), schemas.DISRUPTION_EVENTS),
        (b.crew_members(spark, folder), schemas.CREW_MEMBERS),
        (b.marketing_customer(spark, folder), schemas.MARKETING_CUSTOMER),
    ]
    return reduce(
        DataFrame.unionByName, [constraints.over_length(df, table.widths, table.name) for df, table in sources]
    )


def dq_sla(spark: SparkSession, folder: str) -> DataFrame:
    filled = F.isnotnull
    scored = [
        quality.quality_score(
            b.crew_members(spark, folder),
            {
                "name_filled": filled("full_name"),
                "email_filled": filled("email"),
                "email_valid": email_matches(F.col("email")),
                "hours_in_limit": F.col("hours_on_duty") <= F.col("max_duty_hours"),
            },
            "crew_members",
        ),
        quality.quality_score(
            b.disruption_events(spark, folder),
            {
                "flight_filled": filled("flight_id"),
                "crew_filled": filled("crew_id") | (F.col("disruption_type") == "WEATHER"),
                "severity_known": F.col("severity").isin("CRITICAL", "HIGH", "MEDIUM", "LOW"),
                "cost_positive": F.col("cost_estimate") >= 0,
            },
            "disruption_events",
        ),
        quality.quality_score(
            b.flights(spark, folder),
            {
                "number_filled": filled("flight_number"),
                "arrives_later": F.col("scheduled_arr") > F.col("scheduled_dep"),
                "code_width": F.length("destination") <= 4,
            },
            "flights",
        ),
    ]
    return reduce(DataFrame.unionByName, scored)


def column_profile(spark: SparkSession, folder: str) -> DataFrame:
    sample = quality.sample_rows(b.marketing_customer(spark, folder), ["customer_id"], PROFILE_PERCENT)
    return quality.column_profile(sample, PROFILE_COLUMNS, "marketing_customer")


def column_profile_sketches(spark: SparkSession, folder: str) -> DataFrame:
    """Profile of all columns of the events from stored sketches of each month; estimates against exact values."""
    events = b.disruption_events(spark, folder)
    month = F.date_format("reported_at", "yyyy-MM")
    sketches = stored(quality.profile_sketches(events, month), "sketches")
    profile = stored(quality.merged_profile(sketches, events.schema), "profile")
    # one row per column
    found = {r.column_name: r for r in profile.select("column_name", "n_distinct", "median").collect()}
    exact = ["flight_id", "crew_id", "severity", "estimated_delay_mins"]
    medians = [c for c, r in found.items() if r.median is not None]
    below = [F.avg((F.col(c) < found[c].median).cast("int")).alias(f"below_{c}") for c in medians]
    up_to = [F.avg((F.col(c) <= found[c].median).cast("int")).alias(f"up_to_{c}") for c in medians]
    checked = events.agg(*[F.count_distinct(c).alias(f"n_{c}") for c in exact], *below, *up_to)
    distinct = F.array(*[F.struct(F.lit(c).alias("column_name"), (F.abs(F.col(f"n_{c}") - found[c].n_distinct) <= 0.07 * F.col(f"n_{c}")).alias("distinct_in_bounds")) for c in exact])
    median = F.array(*[F.struct(F.lit(c).alias("column_name"), ((F.col(f"below_{c}") <= 0.53) & (F.col(f"up_to_{c}") >= 0.47)).alias("median_in_bounds")) for c in medians])
    both = stored(checked.select(distinct.alias("d"), median.alias("m")), "checked")
    shown = profile.drop("n_distinct", "median")
    return shown.join(both.select(F.inline("d")), "column_name", "left").join(both.select(F.inline("m")), "column_name", "left")


def distinct_by_month(spark: SparkSession, folder: str) -> DataFrame:
    """Different flights and crew members per severity, from bitmaps that were stored for each month."""
    events = b.disruption_events(spark, folder).withColumn("month", F.date_format("reported_at", "yyyy-MM"))
    bitmaps = stored(distinct_rollup.value_bitmaps(events, ["month", "severity"], ["flight_id", "crew_id"]), "bitmaps")
    return distinct_rollup.united_counts(bitmaps, ["severity"])


# -- lineage ---------------------------------------------------------------------------------------


def lineage_events(spark: SparkSession, folder: str) -> DataFrame:
    return lineage_runs.flatten_events(b.lineage_events(spark, folder))


def run_pairing(spark: SparkSession, folder: str) -> DataFrame:
    return lineage_runs.run_pairing(b.lineage_events(spark, folder))


def event_consistency(spark: SparkSession, folder: str) -> DataFrame:
    return lineage_runs.event_consistency(b.lineage_events(spark, folder))


def rebase_events(spark: SparkSession, folder: str) -> DataFrame:
    old = b.lineage_events(spark, folder).withColumn("old_run_id", F.col("run.runId"))
    moved = lineage_runs.rebase_events(old, REBASE_SEED, REBASE_NOW)
    scheduler = lineage_runs.SCHEDULER
    return moved.select(
        "old_run_id",
        F.col("eventType").alias("event_type"),
        F.col("eventTime").alias("event_time"),
        F.col("run.runId").alias("run_id"),
        F.col("run.facets.parent.run.runId").alias("parent_run_id"),
        F.col("run.facets.parent.root.run.runId").alias("root_run_id"),
        F.col("run.facets.nominalTime.nominalStartTime").alias("nominal_start"),
        F.col("run.facets.nominalTime.nominalEndTime").alias("nominal_end"),
        F.col(f"{scheduler}.taskUuid").alias("task_id"),
        F.col(f"{scheduler}.dagRun.run_id").alias("run_name"),
        F.col(f"{scheduler}.dagRun.run_after").alias("run_after"),
        F.col(f"{scheduler}.dagRun.start_date").alias("start_date"),
        F.col(f"{scheduler}.dagRun.logical_date").alias("logical_date"),
        F.col(f"{scheduler}.taskInstance.log_url").alias("log_url"),
    )


def json_rebase(spark: SparkSession, folder: str) -> DataFrame:
    """Whole documents read as JSON, one a line, moved to a new time, written back and read again: what was
    changed, and fields that were not, declared or unknown."""
    old, new = scratch_path(spark, "documents"), scratch_path(spark, "documents")
    b.full_documents(spark, folder).write.options(**JSON_FILES).json(old)
    documents = read_documents(spark, old, document_per_file=False)
    write_documents(lineage_documents.rebase_documents(documents, REBASE_SEED, REBASE_NOW), new, **JSON_FILES)
    document = F.col("document")

    def text(path: str) -> F.Column:
        return F.try_variant_get(document, f"$.{path}", "string")

    def part(path: str) -> F.Column:
        return F.to_json(F.try_variant_get(document, f"$.{path}", "variant"))

    return read_documents(spark, new, document_per_file=False).select(
        text("eventTime").alias("event_time"),
        text("eventType").alias("event_type"),
        text("contentType").alias("content_type"),
        text("run.runId").alias("run_id"),
        text("run.facets.parent.root.run.runId").alias("root_run_id"),
        text("run.facets.parent.job.name").alias("parent_job"),
        text("run.facets.nominalTime.nominalEndTime").alias("nominal_end"),
        text(f"run.facets.{SCHEDULER_FACET}.taskInstance.log_url").alias("log_url"),
        text(f"run.facets.{SCHEDULER_FACET}.taskInstance.try_number").alias("try_number"),
        part("run.facets.custom").alias("custom"),
        text("inputs[1].facets.statistics.rowCount").cast("bigint").alias("row_count"),
        text("inputs[0].name").alias("first_input"),
        part("outputs[0].facets.columnLineage.fields.c_2").alias("c_2_lineage"),
    )


def endpoint_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Datasets per address after the second address was replaced by the first."""
    endpoints = {"postgres://warehouse-b:5432": "postgres://warehouse-a:5432"}
    edges = lineage_data.column_edges(b.lineage_events(spark, folder), {}, endpoints)
    return edges.groupBy("dataset", "src_dataset").agg(F.sum("n_events").alias("n_events"))


def lineage_edges(spark: SparkSession, folder: str) -> DataFrame:
    return lineage_data.dataset_edges(b.lineage_events(spark, folder), b.ALIASES)


def _json_events(spark: SparkSession, folder: str) -> DataFrame:
    """The events written as JSON, one document per line, and read from there."""
    place = scratch_path(spark, "documents")
    b.lineage_events(spark, folder).write.options(**JSON_FILES).json(place)
    return read_events(spark, place, document_per_file=False)


def json_lineage_edges(spark: SparkSession, folder: str) -> DataFrame:
    return lineage_data.dataset_edges(_json_events(spark, folder), b.ALIASES)


def json_run_pairing(spark: SparkSession, folder: str) -> DataFrame:
    return lineage_runs.run_pairing(_json_events(spark, folder))


def json_schema_drift(spark: SparkSession, folder: str) -> DataFrame:
    return lineage_data.schema_drift(lineage_data.schema_columns(_json_events(spark, folder), b.ALIASES))


def lineage_gap(spark: SparkSession, folder: str) -> DataFrame:
    return lineage_data.lineage_gap(lineage_edges(spark, folder))


def lineage_gaps_over_time(spark: SparkSession, folder: str) -> DataFrame:
    """When a table was wanted, six hours from each START on, and not valid, a day from each COMPLETE on."""

    def name(namespace: F.Column, table: F.Column) -> F.Column:
        return lineage_data.dataset_id(namespace, table, b.ALIASES)

    return lineage_times.gaps_over_time(lineage_times.dataset_uses(b.lineage_events(spark, folder), name, "6 HOURS", "1 DAY"))


def lineage_class_edges(spark: SparkSession, folder: str) -> DataFrame:
    """Edges between classes of datasets that pairs of names, in chains, declare to be the same."""
    edges = lineage_data.dataset_edges(b.lineage_events(spark, folder), {})
    classes = dataset_classes.alias_classes(b.dataset_aliases(spark, folder))
    return dataset_classes.in_classes(edges, ["src", "dst"], classes).groupBy("src", "dst", "kind").agg(F.sum("n_events").alias("n_events"))


def lineage_column_edges(spark: SparkSession, folder: str) -> DataFrame:
    return lineage_data.column_edges(b.lineage_events(spark, folder), b.ALIASES)


def lineage_collapse(spark: SparkSession, folder: str) -> DataFrame:
    return lineage_data.collapse_intermediates(b.lineage_events(spark, folder), b.ALIASES)


def lineage_column_origins(spark: SparkSession, folder: str) -> DataFrame:
    """Where the columns of all tables come from in the end, over the events of all runs, through cycles."""
    found = lineage_data.collapse_intermediates(b.lineage_events(spark, folder), b.ALIASES).filter("status <> 'unresolved'")
    edges = found.select(F.concat_ws("/", "src_dataset", "src_column").alias("src"), F.concat_ws("/", "dataset", "column_name").alias("dst"))
    paths = lineage_cycles.origins(stored(edges, "column-edges"))
    return paths.select(F.col("node").alias("column"), F.col("origin").alias("origin_column"), "hops", "in_cycle")


def lineage_schema_check(spark: SparkSession, folder: str) -> DataFrame:
    return lineage_data.lineage_schema_check(b.lineage_events(spark, folder), b.ALIASES)


def schema_drift(spark: SparkSession, folder: str) -> DataFrame:
    return lineage_data.schema_drift(lineage_data.schema_columns(b.lineage_events(spark, folder), b.ALIASES))


def lineage_upstream(spark: SparkSession, folder: str) -> DataFrame:
    edges = b.part_edges(spark, folder)
    return lineage_graph.reachable(edges, lineage_graph.end_points(edges))


def lineage_downstream(spark: SparkSession, folder: str) -> DataFrame:
    edges = b.part_edges(spark, folder)
    return lineage_graph.reachable(edges, lineage_graph.end_points(edges, upstream=False), upstream=False)


def streaming_run_pairing(spark: SparkSession, folder: str) -> DataFrame:
    """The pairing as a stream over the event files; its output is read back from where it was written."""
    flat = lineage_runs.flatten_events(b.lineage_event_stream(spark, folder))
    place = scratch_path(spark, "run-pairing")
    pairs = pair_runs(flat, within="5 minutes", lateness="1 day")
    write_available(pairs, f"{place}/pairs", f"{place}/state")
    return spark.read.schema(pairs.schema).parquet(f"{place}/pairs")


def streaming_run_states(spark: SparkSession, folder: str) -> DataFrame:
    """Every run with what became of it, from a stream that gets its deliveries one after another."""
    place = scratch_path(spark, "run-states")
    files = b.delivered_events(spark, folder, f"{place}/delivered")
    flat = lineage_runs.flatten_events(b.delivered_event_stream(spark, f"{place}/delivered", files))
    released = pair_or_release(flat, within="5 minutes", lateness="2 hours")
    write_available(released, f"{place}/released", f"{place}/state")
    return run_states(spark.read.schema(released.schema).parquet(f"{place}/released")).filter(F.col("run_id") != b.CLOSING_RUN)


QUERIES: dict[str, Query] = {
    "scan_project": scan_project,
    "scan_sources": scan_sources,
    "flight_disruptions": flight_disruptions,
    "crew_disruption_detail": crew_disruption_detail,
    "staging_filter": staging_filter,
    "disruption_summary": disruption_summary,
    "summary_report": summary_report,
    "crew_qualifications": crew_qualifications,
    "crew_workload": crew_workload,
    "crew_workload_report": crew_workload_report,
    "marketing_leads": marketing_leads,
    "invalid_email": invalid_email,
    "email_validity": email_validity,
    "ensure_columns": ensured_columns,
    "summary_upsert": summary_upsert,
    "load_disruption_summary": load_disruption_summary,
    "load_crew_workload": load_crew_workload,
    "load_invalid_email": load_invalid_email,
    "load_marketing_leads": load_marketing_leads,
    "load_new_flights": load_new_flights,
    "load_checked_contacts": load_checked_contacts,
    "load_retention": load_retention,
    "staging_by_view": staging_by_view,
    "check_unique": check_unique,
    "check_not_null": check_not_null,
    "check_fk": check_fk,
    "check_length": check_length,
    "dq_sla": dq_sla,
    "column_profile": column_profile,
    "column_profile_sketches": column_profile_sketches,
    "distinct_by_month": distinct_by_month,
    "lineage_events": lineage_events,
    "run_pairing": run_pairing,
    "event_consistency": event_consistency,
    "rebase_events": rebase_events,
    "json_rebase": json_rebase,
    "endpoint_alignment": endpoint_alignment,
    "lineage_edges": lineage_edges,
    "json_lineage_edges": json_lineage_edges,
    "json_run_pairing": json_run_pairing,
    "json_schema_drift": json_schema_drift,
    "lineage_gap": lineage_gap,
    "lineage_gaps_over_time": lineage_gaps_over_time,
    "lineage_class_edges": lineage_class_edges,
    "lineage_column_edges": lineage_column_edges,
    "lineage_collapse": lineage_collapse,
    "lineage_column_origins": lineage_column_origins,
    "lineage_schema_check": lineage_schema_check,
    "schema_drift": schema_drift,
    "lineage_upstream": lineage_upstream,
    "lineage_downstream": lineage_downstream,
    "streaming_run_pairing": streaming_run_pairing,
    "streaming_run_states": streaming_run_states,
}
