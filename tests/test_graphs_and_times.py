"""Cycles, classes of names, gaps over time, mergeable counts, against plain versions on random data."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tarmac.operators import constraints, dataset_classes, distinct_rollup, lineage_cycles, lineage_times, quality
from tarmac.plans.queries import QUERIES
from tests.test_plans import FOLDER, plan_of


def closure(edges):
    """node -> nodes reached over one edge or more."""
    reach = {n: set() for e in edges for n in e}
    for a, b in edges:
        reach[a].add(b)
    changed = True
    while changed:
        changed = False
        for a in reach:
            more = set().union(*(reach[b] for b in reach[a])) - reach[a] if reach[a] else set()
            if more:
                reach[a] |= more
                changed = True
    return reach


def plain_origins(edges):
    reach = closure(edges)
    group = {n: min([m for m in reach[n] if n in reach[m]] + [n]) for n in reach}
    entered = {group[b] for a, b in edges if group[a] != group[b]}
    found = {n: (0, group[n]) for n in reach if group[n] not in entered}
    hops, fresh = 0, dict(found)
    while fresh:
        hops += 1
        step = {}
        for a, b in edges:
            if a in fresh and b not in found:
                step[b] = min(step.get(b, (hops, fresh[a][1])), (hops, fresh[a][1]))
        found |= step
        fresh = step
    return {n: (o, h, n in reach[n]) for n, (h, o) in found.items()}


@pytest.mark.parametrize("seed", range(3))
def test_origins_of_random_graphs(spark, seed):
    draw = random.Random(seed)
    names = [f"n{i:02d}" for i in range(24)]
    edges = {(draw.choice(names), draw.choice(names)) for _ in range([20, 30, 45][seed])}
    frame = spark.createDataFrame([*edges, *edges], "src string, dst string")
    got = lineage_cycles.origins(frame).collect()
    assert {r.node: (r.origin, r.hops, r.in_cycle) for r in got} == plain_origins(edges) and len(got) == len({n for e in edges for n in e})
    groups = {r.node: r.cycle for r in lineage_cycles.cycle_groups(frame).collect()}
    reach = closure(edges)
    assert groups == {n: min(m for m in reach[n] if n in reach[m]) for n in reach if any(n in reach[m] for m in reach[n] - {n})}


def test_origins_without_edges(spark):
    assert lineage_cycles.origins(spark.createDataFrame([], "src string, dst string")).collect() == []
    one = spark.createDataFrame([("a", "a"), (None, "b"), ("c", None)], "src string, dst string")
    assert {r.node: (r.origin, r.hops, r.in_cycle) for r in lineage_cycles.origins(one).collect()} == {"a": ("a", 0, True), "b": ("b", 0, False), "c": ("c", 0, False)}


@pytest.mark.parametrize("limit", [100_000, 1])
def test_classes_of_names(spark, monkeypatch, limit):
    monkeypatch.setattr(dataset_classes, "BROADCAST_ROWS", limit)
    chain = [(f"c{i:02d}", f"c{i + 1:02d}") for i in range(30)]
    random.Random(1).shuffle(chain)
    pairs = [*chain, ("x", "y"), ("y", "x"), ("x", "y"), ("z", "z"), (None, "q"), ("r", None), ("hub", "x"), *[("hub", f"h{i}") for i in range(40)]]
    classes = dataset_classes.alias_classes(spark.createDataFrame(pairs, "name string, alias string"))
    got = {r.dataset: r["class"] for r in classes.collect()}
    assert got == {f"c{i:02d}": "c00" for i in range(31)} | {n: "h0" for n in ("x", "y", "hub", *[f"h{i}" for i in range(40)])} | {"z": "z"}
    edges = spark.createDataFrame([("c07", "y", 1), ("other", None, 2)], "src string, dst string, n int")
    replaced = dataset_classes.in_classes(edges, ["src", "dst"], classes)
    assert sorted(replaced.collect(), key=str) == [("c00", "h0", 1), ("other", None, 2)]
    assert ("BroadcastHashJoin" in plan_of(replaced)) or limit == 1
    assert dataset_classes.alias_classes(spark.createDataFrame([], "name string, alias string")).collect() == []


USES = "dataset string, kind string, valid_from timestamp_ntz, valid_to timestamp_ntz"
START = dt.datetime(2026, 1, 1)


def hours(n):
    return START + dt.timedelta(hours=n)


@pytest.mark.parametrize("seed", range(3))
def test_gaps_over_time(spark, seed):
    draw = random.Random(seed)
    uses = []
    for _ in range(120):
        a = draw.randrange(200)
        uses.append((draw.choice("ab"), draw.choice(["read", "write"]), hours(a), hours(a + draw.choice([0, 1, 3, 30, 60]))))
    uses += [(None, "read", hours(0), hours(1)), ("c", "read", hours(5), hours(3)), ("d", "read", None, hours(1)), ("e", "read", hours(1), hours(90))]
    want = set()
    for name in "abe":
        lacking = [
            any(d == name and k == "read" and f <= hours(t) < z for d, k, f, z in uses if f) and not any(d == name and k == "write" and f <= hours(t) < z for d, k, f, z in uses if f)
            for t in range(300)
        ]
        edges = [t for t in range(300) if lacking[t] != (t > 0 and lacking[t - 1])]
        want |= {(name, hours(a), hours(z)) for a, z in zip(edges[::2], edges[1::2], strict=True)}
    assert {tuple(r) for r in lineage_times.gaps_over_time(spark.createDataFrame(uses, USES)).collect()} == want
    assert lineage_times.gaps_over_time(spark.createDataFrame([], USES)).collect() == []


def test_gaps_over_time_shuffle_points_once(spark):
    """The points of all uses are made once and dealt out once; other shuffles carry blocks or gaps."""
    adaptive = "spark.sql.adaptive.enabled"
    before = spark.conf.get(adaptive)
    spark.conf.set(adaptive, "false")
    try:
        uses = spark.createDataFrame([("a", "read", hours(0), hours(1))], USES).repartition(2)
        made = lineage_times.gaps_over_time(uses)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(adaptive, before)
    assert made.count("Generate inline") == 1, made


def test_distinct_counts_add_up(spark):
    draw = random.Random(4)
    rows = [(draw.choice(["a", "b", None]), draw.randrange(3), draw.choice([None, -5, 0, 7, 40_000, 70_000, 1 << 40, *range(100)])) for _ in range(500)]
    frame = spark.createDataFrame(rows, "g string, day int, v long")
    parts = distinct_rollup.value_bitmaps(frame.filter("day < 2"), ["g", "day"], ["v"]).unionByName(distinct_rollup.value_bitmaps(frame.filter("day >= 1"), ["g", "day"], ["v"]))
    got = {r.g: r.n_distinct for r in distinct_rollup.united_counts(parts, ["g"]).collect()}
    assert got == {g: len({v for h, _, v in rows if h == g and v is not None}) for g in ("a", "b", None)}
    assert distinct_rollup.united_counts(distinct_rollup.value_bitmaps(frame.limit(0), ["g"], ["v"]), ["g"]).collect() == []


def test_profiles_merge(spark):
    rows = [(i % 4, i % 700, f"t{i % 90}" if i % 3 else None, i / 10, None, i % 2 == 0) for i in range(20_000)]
    frame = spark.createDataFrame(rows, "part int, n int, t string, x double, nothing long, flag boolean")
    sketches = quality.profile_sketches(frame, F.col("part"))
    assert plan_of(sketches).count("Exchange hashpartitioning") <= 2 and "Expand" not in plan_of(sketches)  # in the tree, and explained
    got = {r.column_name: r for r in quality.merged_profile(sketches, frame.schema).collect()}
    assert {r.n_rows for r in got.values()} == {20_000} and got["t"].n_nulls == 6_667 and got["nothing"].n_nulls == 20_000
    assert abs(got["n"].n_distinct - 700) < 35 and abs(got["t"].n_distinct - 60) < 4 and abs(got["x"].n_distinct - 20_000) < 1_300 and got["nothing"].n_distinct == 0
    assert abs(got["x"].median - 1_000) < 60 and abs(got["n"].median - 350) < 21 and got["nothing"].median is None and got["t"].median is None
    assert (got["n"].min_value, got["n"].max_value, got["t"].min_value, got["flag"].max_value) == ("0", "699", "t1", "true")
    empty = {r.column_name: r for r in quality.merged_profile(quality.profile_sketches(frame.limit(0), F.col("part")), frame.schema).collect()}
    assert empty["n"].median is None and empty["n"].n_rows is None


def test_keys_and_references_in_one_scan(spark):
    rows = [(1, "a", "x"), (1, "b", "x"), (2, "b", None), (None, None, "y")]
    frame = spark.createDataFrame(rows, "k long, t string, u string")
    got = constraints.duplicate_keys_in(frame, {"k": ["k"], "t": ["t"], "both": ["k", "u"]})
    assert sorted(map(tuple, got.collect())) == [("both", "1|x", 2), ("k", "1", 2), ("t", "b", 2)]
    known, some = spark.createDataFrame([(1,)], "id long"), spark.createDataFrame([("x",)], "id string")
    lost = constraints.orphans_in(frame, [("k known", "k", known, "id"), ("u known", "u", some, "id"), ("u also", "u", some.limit(0), "id")])
    assert sorted(map(tuple, lost.collect())) == [("k known", "2", 1), ("u also", "x", 2), ("u also", "y", 1), ("u known", "y", 1)]
    plan = plan_of(QUERIES["check_fk"](spark, FOLDER), "simple")
    assert plan.count("lineitem.parquet") == 1
    plan = plan_of(QUERIES["check_unique"](spark, FOLDER), "simple")
    assert plan.count("lineitem.parquet") == 1 and plan.count("supplier.parquet") == 1 and plan.count("orders.parquet") == 1
