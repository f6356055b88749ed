"""Loads that die half-way, rows set apart, folders nobody uses."""

import datetime as dt
import os
import tempfile
import uuid
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tarmac import schemas
from tarmac.sinks import tables
from tarmac.sinks.checked import checked_refresh
from tarmac.sinks.retention import remove_unused, unused_folders
from tarmac.sinks.tables import full_refresh, reset, upsert
from tests.test_plans import plan_of

COUNTS = schemas.Table(
    "counts",
    (schemas.Column("id", "bigint", True), schemas.Column("name", "string", True, 3), schemas.Column("n", "int"), schemas.Column("day", "date", True)),
    unique=(("day", "name"),),
    partition_by=("day",),
)


@pytest.fixture
def target(spark):
    name = f"counts_{uuid.uuid4().hex}"
    yield name, tempfile.mkdtemp(prefix="tarmac-sinks-")
    reset(spark, [], [name, f"{name}_broken"])


def source(spark, rows):
    return spark.createDataFrame(rows, "day string, name string, n int").withColumn("day", F.col("day").cast("date"))


def load(spark, target, rows):
    name, place = target
    upsert(source(spark, rows), COUNTS, name, place, ["day", "name"], ["n"], "id")


def shown(spark, target):
    return sorted((str(r.day), r.name, r.n) for r in spark.table(target[0]).select("day", "name", "n").collect())


def test_a_load_that_dies_between_two_partitions_is_finished_by_the_next(spark, target, monkeypatch):
    load(spark, target, [("2026-01-01", "a", 1), ("2026-01-02", "a", 1)])
    first = shown(spark, target)
    whole = tables._switch

    def dies(session, name, intent):
        whole(session, name, intent | {"values": intent["values"][:1]})
        raise RuntimeError("the driver is gone")

    monkeypatch.setattr(tables, "_switch", dies)
    with pytest.raises(RuntimeError, match="gone"):
        load(spark, target, [("2026-01-01", "a", 5), ("2026-01-02", "a", 5), ("2026-01-02", "b", 5)])
    monkeypatch.setattr(tables, "_switch", whole)
    half = shown(spark, target)
    assert half != first and half != [("2026-01-01", "a", 5), ("2026-01-02", "a", 5), ("2026-01-02", "b", 5)]

    load(spark, target, [("2026-01-03", "c", 7)])
    assert shown(spark, target) == [("2026-01-01", "a", 5), ("2026-01-02", "a", 5), ("2026-01-02", "b", 5), ("2026-01-03", "c", 7)]
    assert sorted(r.id for r in spark.table(target[0]).collect()) == [1, 2, 3, 4]
    assert not tables.finish_upsert(spark, *target)


def test_a_load_that_dies_before_its_intent_changes_nothing(spark, target, monkeypatch):
    load(spark, target, [("2026-01-01", "a", 1)])

    def dies(*_):
        raise RuntimeError("the driver is gone")

    monkeypatch.setattr(tables.Journal, "begin", dies)
    with pytest.raises(RuntimeError):
        load(spark, target, [("2026-01-01", "b", 1)])
    monkeypatch.undo()
    assert shown(spark, target) == [("2026-01-01", "a", 1)]
    load(spark, target, [("2026-01-01", "c", 1)])
    # the id of the load that died is given again
    assert {r.name: r.id for r in spark.table(target[0]).collect()} == {"a": 1, "c": 2}


def test_the_last_id_is_not_looked_up_in_the_table(spark, target, monkeypatch):
    load(spark, target, [("2026-01-01", "a", 1)])
    read = []
    monkeypatch.setattr(tables, "upsert_rows", lambda t, s, k, u, i, after: read.append(after) or s.withColumn("id", F.lit(9)))
    monkeypatch.setattr(spark, "table", lambda name, original=spark.table: read.append(name) or original(name))
    load(spark, target, [("2026-01-01", "b", 1)])
    assert read.count(1) == 1


def test_a_target_in_buckets_is_not_shuffled(spark, target, monkeypatch):
    name, place = target
    bucketed = replace(COUNTS, bucket_by=("name",), buckets=4)
    rows = [("2026-01-01", n, i) for i, n in enumerate("abcdefgh")]
    plans, write = [], tables._write_partitions
    monkeypatch.setattr(tables, "_write_partitions", lambda df, *more: plans.append(plan_of(df, "simple")) or write(df, *more))
    before = spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition")
    for extra in (0, 10, 20):
        changed = [(d, n, i + extra) for d, n, i in rows] + [("2026-01-02", f"x{extra}", 1)]
        upsert(source(spark, changed), bucketed, name, place, ["day", "name"], ["n"], "id")
    assert sorted((r.name, r.n) for r in spark.table(name).filter("day = '2026-01-01'").collect()) == [(n, i + 20) for i, n in enumerate("abcdefgh")]
    assert sorted(r.id for r in spark.table(name).collect()) == list(range(1, 12))
    join = plans[-1]
    assert "SortMergeJoin" in join and "Bucketed: true" in join and join.count("Exchange") == 1
    # a file for each bucket of a partition at most
    files = [f for f in spark.table(name).inputFiles()]
    assert len(files) <= 2 * 4
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == before
    assert not [t for t in spark.catalog.listTables() if t.name.startswith(f"{name}_")]


def test_rows_are_set_apart_in_one_pass(spark, target):
    name, place = target
    rows = [(1, "abc", "1", "2026-01-01"), (2, "abcd", "x", "2026-01-01"), (None, None, None, None), (4, "d", None, "2026-01-02")]
    df = spark.createDataFrame(rows, "id long, name string, n string, day string")
    flat = schemas.Table("counts", COUNTS.columns)
    counts = checked_refresh(df, flat, name, f"{name}_broken", place)
    assert {k: v for k, v in counts.items() if v} == {
        "rows": 4, "broken": 2, "n does not fit int": 1, "name is longer than 3": 1, "id must not be NULL": 1, "name must not be NULL": 1, "day must not be NULL": 1,
    }
    assert sorted((r.id, r.name, r.n) for r in spark.table(name).collect()) == [(1, "abc", 1), (4, "d", None)]
    broken = {r.source_row: r.problems for r in spark.table(f"{name}_broken").collect()}
    assert broken['{"id":2,"name":"abcd","n":"x","day":"2026-01-01"}'] == ["name is longer than 3", "n does not fit int"] and len(broken) == 2
    # again, with good rows only: both tables are replaced
    counts = checked_refresh(df.filter("id = 1"), flat, name, f"{name}_broken", place)
    assert counts["rows"] == 1 and counts["broken"] == 0
    assert spark.table(name).count() == 1 and spark.table(f"{name}_broken").count() == 0
    assert checked_refresh(df.limit(0), flat, name, f"{name}_broken", place)["rows"] == 0 and spark.table(name).count() == 0


def test_the_source_of_a_checked_load_is_read_once(spark, target, monkeypatch):
    name, place = target
    spark.range(100).selectExpr("id", "'a' AS name", "1 AS n", "DATE'2026-01-01' AS day").write.parquet(f"{place}/source")
    plans, write = [], type(spark.range(1)).write.fget
    monkeypatch.setattr(type(spark.range(1)), "write", property(lambda df: plans.append(plan_of(df)) or write(df)))
    checked_refresh(spark.read.parquet(f"{place}/source"), schemas.Table("counts", COUNTS.columns), name, f"{name}_broken", place)
    assert len(plans) == 1 and plans[0].count("Scan parquet") == 2 and "Exchange" not in plans[0]  # in the tree, and explained


def test_only_folders_out_of_use_go(spark, target):
    name, place = target
    flat = schemas.Table("counts", COUNTS.columns)
    rows = source(spark, [("2026-01-01", "a", 1)]).withColumn("id", F.lit(1))
    folders = [full_refresh(rows, flat, name, place) for _ in range(3)]
    partitioned = f"{name}_broken"
    for n in range(2):
        upsert(source(spark, [(f"2026-01-0{n + 1}", "a", 1), ("2026-01-05", "a", n)]), COUNTS, partitioned, place, ["day", "name"], ["n"], "id")
    later = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) + dt.timedelta(minutes=5)
    every = [name, partitioned]
    assert unused_folders(spark, every, place, later, dt.timedelta(days=1)).collect() == []
    gone = remove_unused(spark, every, place, later, dt.timedelta(minutes=1))
    assert set(folders[:2]) <= set(gone) and folders[2] not in gone and not any(os.path.exists(f) for f in gone)
    assert spark.table(name).count() == 1 and spark.table(partitioned).count() == 3
    assert any(tables.JOURNAL in f for f in os.listdir(place))
    # the table goes on
    full_refresh(rows, flat, name, place)
    upsert(source(spark, [("2026-01-05", "b", 1)]), COUNTS, partitioned, place, ["day", "name"], ["n"], "id")
    assert spark.table(partitioned).count() == 4
