"""What the physical plans must and must not contain, and every query against the second engine."""

import os
import re
import tempfile

import pytest

import __spark_entry__ as entry_module
from tarmac import schemas
from tarmac.operators import summary, views
from tarmac.plans.oracle import ORACLE
from tarmac.plans.queries import QUERIES
from tests import fixtures as fx
from tests.compare import compare, connect

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
STATEFUL = {"lineage_upstream", "lineage_downstream", "streaming_run_pairing", "streaming_run_states"}


def plan_of(df, mode="formatted"):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    )


@pytest.fixture(scope="module")
def second_engine():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_against_sql(spark, second_engine, name):
    result = compare(QUERIES[name](spark, FOLDER), ORACLE[name], second_engine)
    assert not result["problems"] and result["rows"] > 0


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert entry_module.oracle_sql().keys() <= entry_module.queries().keys()


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STATEFUL))
def test_no_pair_joins_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|EvalPython|MapInPandas|FlatMapGroupsInPandas", plan)


def test_summary_filters_reach_the_reader(spark):
    """On tables in their declared shape, through both views and from the event table."""
    folder = tempfile.mkdtemp(prefix="tarmac-scan-")
    tables = []
    for table, df in ((schemas.DISRUPTION_EVENTS, fx.events(spark)), (schemas.FLIGHTS, fx.flights(spark)), (schemas.CREW_MEMBERS, fx.crew(spark))):
        df.write.parquet(f"{folder}/{table.name}")
        tables.append(spark.read.schema(table.schema).parquet(f"{folder}/{table.name}"))
    events, flights, crew = tables
    through_views = summary.staging(views.crew_disruption_detail(views.flight_disruptions(events, flights), crew))
    early = summary.disruption_summary(events, flights, crew, fx.AS_OF, fx.RUN_TS)
    for df in (through_views, early):
        pushed = " ".join(re.findall(r"PushedFilters: \[.*\]", plan_of(df)))
        assert "IsNull(resolved_at)" in pushed and "In(disruption_type, [CREW_SICK,CREW_TIMEOUT])" in pushed
    read = " ".join(re.findall(r"ReadSchema: .*", plan_of(early)))
    assert "description" not in read and "scheduled_dep" not in read and "qualifications" not in read


def test_summary_shuffles_aggregated_rows_only(spark):
    plan = plan_of(QUERIES["disruption_summary"](spark, FOLDER), "simple")
    assert "Expand" not in plan
    for line_no, line in enumerate(plan.splitlines()):
        if "Exchange hashpartitioning(flight_id" in line and "disruption_id" in line:
            assert "partial_max" in plan.splitlines()[line_no + 1]


def test_raw_filters_reach_the_given_tables(spark):
    plan = plan_of(QUERIES["disruption_summary"](spark, FOLDER))
    assert "In(l_returnflag, [A,R])" in plan or "In(l_returnflag, [R,A])" in plan
