"""Tasks, memory and disk that must not grow with the tables."""

import re

import pytest
from pyspark.sql import functions as F

from tarmac.operators import lineage_data, views
from tarmac.plans.queries import QUERIES
from tarmac.sources import bindings as b
from tests import fixtures as fx
from tests.test_plans import FOLDER, plan_of


def test_more_events_make_more_tasks(spark):
    events = spark.range(0, 2_000_000, 1, 1)
    spread = b._spread(events)
    sizes = [r["n"] for r in spread.groupBy(F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(sizes) == 2_000_000 and max(sizes) <= 1.1 * b.EVENTS_PER_TASK
    assert b._spread(spark.range(0, 100, 1, 64)).rdd.getNumPartitions() == 64


def test_drift_does_not_sort_the_columns_of_all_events(spark):
    rows = [("t", "a", "reader", "int"), ("t", "a", "reader", "int"), ("t", "a", "writer", None), ("t", "a", "writer", "date"), ("t", None, "reader", "int")]
    columns = spark.createDataFrame(rows, "dataset string, column_name string, role string, type string")
    found = lineage_data.schema_drift(columns)
    assert {tuple(r) for r in found.collect()} == {("t", "a", "int", "date", "other type"), ("t", None, "int", None, "only reader")}
    # the grouping next to the rows is one by hash
    lowest = [line for line in plan_of(found, "simple").splitlines() if "Aggregate(" in line][-1]
    assert re.search(r"\bHashAggregate\(", lowest)


@pytest.mark.parametrize("name", ["json_rebase", "json_run_pairing", "json_schema_drift", "json_lineage_edges"])
def test_documents_are_stored_compressed(spark, name):
    files = QUERIES[name](spark, FOLDER).inputFiles()
    assert files and all(f.endswith(".gz") for f in files)


def test_small_crew_is_broadcast_and_gives_the_rows_of_the_shuffle(spark, monkeypatch):
    def detail():
        return views.crew_disruption_detail(views.flight_disruptions(fx.events(spark), fx.flights(spark)), fx.crew(spark))

    key, before = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(key, "-1")
    try:
        by_broadcast = detail()
        assert "BroadcastHashJoin" in plan_of(by_broadcast, "simple")
        rows = sorted(map(repr, by_broadcast.collect()))
        monkeypatch.setattr(views, "BROADCAST_ROWS", 1)
        by_shuffle = detail()
        assert "BroadcastHashJoin" not in plan_of(by_shuffle, "simple")
        assert rows and rows == sorted(map(repr, by_shuffle.collect()))
    finally:
        spark.conf.set(key, before)
