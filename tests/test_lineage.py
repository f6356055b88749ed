import datetime as dt
import json
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tarmac.operators import lineage_data as data
from tarmac.operators import lineage_graph as graph
from tarmac.operators import lineage_runs as runs
from tarmac.operators import views
from tarmac.sources.lineage_events import read_events
from tests import fixtures as fx

SUMMARY = "warehouse/public.disruption_summary"
VIEW = "warehouse/public.vw_crew_disruption_detail"


def write(documents, per_line=False):
    folder = Path(tempfile.mkdtemp(prefix="tarmac-events-"))
    if per_line:
        (folder / "events.json").write_text("\n".join(json.dumps(d) for d in documents))
    else:
        for i, document in enumerate(documents):
            (folder / f"event-{i}.json").write_text(json.dumps(document, indent=2))
    return str(folder)


@pytest.fixture(scope="module")
def documents(spark):
    detail = views.crew_disruption_detail(
        views.flight_disruptions(fx.events(spark), fx.flights(spark)), fx.crew(spark)
    ).drop("crew_email")
    columns = [(f.name, f.dataType.simpleString()) for f in detail.schema.fields]
    return fx.scheduler_events(columns), fx.report_events()


@pytest.fixture(scope="module")
def events(spark, documents):
    return read_events(spark, write(documents[0] + documents[1])).cache()


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_shapes(spark, documents, events):
    first_input, first_output = F.col("inputs")[0]["facets"], F.col("outputs")[0]["facets"]
    shape = events.select(
        "eventType",
        F.size(first_input["schema"]["fields"]),
        F.size(first_output["schema"]["fields"]),
        F.coalesce(F.size(first_output["columnLineage"]["fields"]), F.lit(0)),
    )
    assert sorted(tuple(r) for r in shape.collect()) == [
        ("COMPLETE", 17, 17, 17),
        ("COMPLETE", 34, 19, 22),
        ("START", 17, 17, 0),
        ("START", 34, 19, 22),
    ]
    per_line = read_events(spark, write(documents[0] + documents[1], per_line=True), document_per_file=False)
    assert per_line.count() == 4


def test_pairing(events):
    got = {r["run_id"]: r for r in runs.run_pairing(events).collect()}
    assert {k: (r["duration_secs"], r["missing_half"]) for k, r in got.items()} == {
        "run-1": (3.421, None),
        "run-2": (3.421, None),
    }
    alone = runs.run_pairing(events.filter("eventType = 'START'"))
    assert {(r["missing_half"], r["duration_secs"]) for r in alone.collect()} == {("COMPLETE", None)}


def test_consistency(spark, documents, events):
    got = {r["run_id"]: r for r in runs.event_consistency(events).collect()}
    assert got["run-1"]["is_consistent"] and got["run-2"]["is_consistent"]
    assert got["run-1"]["triggered_after_start"] and not got["run-2"]["triggered_after_start"]
    start, complete = json.loads(json.dumps(documents[0]))
    complete["run"]["facets"]["parent"]["run"]["runId"] = "other"
    start["eventTime"] = "2026-09-30T00:00:00+00:00"
    (row,) = runs.event_consistency(read_events(spark, write([start, complete]))).collect()
    assert not row["same_parent"] and not row["in_order"] and not row["is_consistent"]


def test_gap_before_and_after_the_load_reports(spark, documents):
    report = read_events(spark, write(documents[1]))
    both = read_events(spark, write(documents[0] + documents[1]))
    before = data.lineage_gap(data.dataset_edges(report, fx.ALIASES))
    after = data.lineage_gap(data.dataset_edges(both, fx.ALIASES))
    assert as_set(before) == {(SUMMARY, 2)}
    assert as_set(after) == {(VIEW, 2)}
    # without the alias the two addresses stay apart
    assert data.lineage_gap(data.dataset_edges(both, {})).count() == 2


def test_column_edges_and_helpers(events):
    complete = events.filter("eventType = 'COMPLETE'")
    load, report = (complete.filter(F.col("run.runId") == run) for run in ("run-1", "run-2"))
    edges = data.column_edges(load, fx.ALIASES)
    assert edges.count() == 28 and edges.select("column_name").distinct().count() == 22
    assert data.column_edges(report, fx.ALIASES).count() == 17

    collapsed = data.collapse_intermediates(load, fx.ALIASES)
    by_status = {r["status"]: r["count"] for r in collapsed.groupBy("status").count().collect()}
    assert by_status == {"direct": 5, "collapsed": 8, "unresolved": 15}
    reasons = collapsed.filter("column_name = 'risk_reason'").select("src_dataset", "src_column", "status")
    assert as_set(reasons) == {(VIEW, c, "collapsed") for c in fx.HELPED}
    assert collapsed.filter("status = 'unresolved'").select("src_dataset").distinct().first()[0].endswith("with_risk")


def test_schema_check(events):
    load = events.filter((F.col("run.runId") == "run-1") & (F.col("eventType") == "COMPLETE"))
    assert as_set(data.lineage_schema_check(load, fx.ALIASES)) == {
        *((SUMMARY, c, "not in schema", 1) for c in fx.STAGED),
        (SUMMARY, "summary_id", "no lineage", 1),
        (SUMMARY, "processed_at", "no lineage", 1),
    }
    clean = events.filter((F.col("run.runId") == "run-2"))
    assert data.lineage_schema_check(clean, fx.ALIASES).count() == 0


def test_drift(spark, events):
    got = data.schema_drift(data.schema_columns(events, fx.ALIASES))
    assert as_set(got) == {
        (SUMMARY, "risk_flag", None, "string", "only writer"),
        (SUMMARY, "risk_reason", None, "string", "only writer"),
    }
    columns = spark.createDataFrame(
        [("reader", "d", "a", "int"), ("writer", "d", "a", "string"), ("reader", "d", "b", "int"),
         ("writer", "d", "b", "int"), ("writer", "d", "b", "date"), ("reader", "d", "c", "int"), ("reader", "e", "x", "int")],
        "role string, dataset string, column_name string, type string",
    )
    assert {(r["column_name"], r["status"]) for r in data.schema_drift(columns).collect()} == {
        ("a", "other type"),
        ("b", "several types"),
        ("c", "only reader"),
    }


def test_type_names(spark):
    df = spark.createDataFrame([(t,) for t in (*data.FACET_TYPES, "uuid", None)], "t string")
    got = [r[0] for r in df.select(data.spark_type(F.col("t"))).collect()]
    assert got == [*data.FACET_TYPES.values(), "uuid", None]


def test_rebase(spark, documents, events):
    now = dt.datetime(2026, 3, 1, 10, 20, 30, 579000)
    moved = {(r["run"]["runId"], r["eventType"]): r for r in runs.rebase_events(events, "s", now).collect()}
    assert len(moved) == 4 and len({run for run, _ in moved}) == 2
    assert not {"run-1", "run-2"} & {run for run, _ in moved}
    load = {kind: r for (_, kind), r in moved.items() if r["run"]["facets"]["airflow"]}
    report = {kind: r for (_, kind), r in moved.items() if not r["run"]["facets"]["airflow"]}
    assert load["START"]["eventTime"] == "2026-03-01T10:20:30.579000+00:00"
    assert load["COMPLETE"]["eventTime"] == "2026-03-01T10:20:34+00:00"  # no fraction when it is zero
    assert report["START"]["eventTime"] == "2026-03-01T10:20:30.000000+00:00"
    assert report["COMPLETE"]["eventTime"] == "2026-03-01T10:20:33.421000+00:00"
    start, complete = load["START"]["run"]["facets"], load["COMPLETE"]["run"]["facets"]
    assert start["nominalTime"]["nominalEndTime"] == "2026-03-01T10:20:30+00:00"
    assert complete["nominalTime"]["nominalEndTime"] == "2026-03-01T10:20:33+00:00"
    assert start["parent"] == complete["parent"] and start["airflow"] == complete["airflow"]
    assert start["parent"]["run"]["runId"] == start["parent"]["root"]["run"]["runId"] != load["START"]["run"]["runId"]
    dag_run = start["airflow"]["dagRun"]
    assert dag_run["run_after"] == "2026-03-01T10:20:31.579000+00:00"
    assert dag_run["run_id"] == "manual__2026-03-01T10:20:31.579000+00:00"
    assert dag_run["start_date"] == "2026-03-01T10:20:31.854000+00:00"
    assert "/runs/manual__2026-03-01T10%3A20%3A31.579000%2B00%3A00/tasks/load?" in start["airflow"]["taskInstance"]["log_url"]
    assert report["START"]["run"]["facets"]["parent"] is None
    # everything else is untouched, and a second run gives the same documents
    assert load["START"]["inputs"] == events.filter("eventType = 'START' AND run.runId = 'run-1'").first()["inputs"]
    assert as_set(runs.rebase_events(events, "s", now).select(F.to_json(F.struct("*")))) == as_set(
        runs.rebase_events(events.repartition(3), "s", now).select(F.to_json(F.struct("*")))
    )
    checked = runs.event_consistency(runs.rebase_events(events, "s", now))
    assert checked.filter("is_consistent").count() == 2


def test_endpoints(events):
    aligned = runs.align_endpoints(events, {fx.HOST_B: fx.HOST_A})
    text = aligned.select(F.to_json(F.struct("inputs", "outputs")).alias("t"))
    assert text.filter(F.col("t").contains(fx.HOST_B)).count() == 0
    assert aligned.filter(F.col("run.runId") == "run-1").select("inputs", "outputs").collect() == events.filter(
        F.col("run.runId") == "run-1"
    ).select("inputs", "outputs").collect()


def nodes(df):
    return {r["node"]: r["hops"] for r in df.collect()}


def test_path_from_sources_to_report(spark, events):
    declared = spark.createDataFrame(
        [("flights", "view_1"), ("disruption_events", "view_1"), ("view_1", VIEW), ("crew_members", VIEW)],
        "src string, dst string",
    )
    edges = declared.unionByName(data.dataset_edges(events, fx.ALIASES).select("src", "dst"))
    report = spark.createDataFrame([("reports/reports.summary",)], "node string")
    up = nodes(graph.reachable(edges, report))
    assert up["flights"] == 6 and up["crew_members"] == 5 and up[SUMMARY] == 2
    flights = spark.createDataFrame([("flights",)], "node string")
    down = nodes(graph.reachable(edges, flights, upstream=False))
    assert down["reports/reports.summary"] == 6 and "crew_members" not in down
    assert as_set(graph.end_points(edges)) == {("reports/reports.summary",)}
    assert as_set(graph.end_points(edges, upstream=False)) == {("flights",), ("disruption_events",), ("crew_members",)}


def test_reach_against_plain_search(spark):
    """A graph with cycles, a self reference, a node with very many edges, and a long chain."""
    import random

    rng = random.Random(3)
    pairs = {(rng.randrange(300), rng.randrange(300)) for _ in range(250)}
    pairs |= {(i, 0) for i in range(300, 500)} | {(i, i + 1) for i in range(600, 623)} | {(7, 7), (0, 600), (623, 0)}
    edges = spark.createDataFrame(sorted(pairs), "src int, dst int")
    for upstream in (True, False):
        want, wave, hops = {623: 0}, {623}, 0
        while wave:
            hops += 1
            ahead = {(s if upstream else d) for s, d in pairs if (d if upstream else s) in wave}
            wave = ahead - want.keys()
            want |= {n: hops for n in wave}
        seeds = spark.createDataFrame([(623,)], "node int")
        assert nodes(graph.reachable(edges, seeds, upstream=upstream)) == want
