"""Small inputs on which operators once gave wrong answers."""

import json

import pytest
from pyspark.sql import functions as F

from tarmac.operators.lineage_data import collapse_intermediates, dataset_edges
from tarmac.operators.lineage_runs import event_consistency
from tarmac.operators.merge import upsert_rows
from tarmac.operators.quality import column_profile
from tarmac.schemas import Column, Table, sql_literal
from tarmac.sinks.tables import ensure_table, reset
from tarmac.sources.lineage_events import event_schema, read_events


def document(spark, tmp_path, name, *lines):
    path = tmp_path / name
    path.write_text("\n".join(lines))
    return read_events(spark, str(path), document_per_file=False)


def test_numbers_are_profiled_in_their_own_order(spark):
    frame = spark.createDataFrame([(9, "b"), (10, None), (100, "a")], "n int, t string")
    got = {r.column_name: (r.min_value, r.max_value, r.n_nulls, r.n_distinct) for r in column_profile(frame, ["n", "t"], "x").collect()}
    assert got == {"n": ("9", "100", 0, 3), "t": ("a", "b", 1, 2)}


def test_a_parent_in_one_event_only_is_inconsistent(spark, tmp_path):
    parent = '"facets":{"parent":{"run":{"runId":"p"}}}'
    run = lambda i, kind, facets="": f'{{"eventType":"{kind}","eventTime":"2026-01-01T00:00:00Z","run":{{"runId":"{i}"{facets}}}}}'
    events = document(
        spark, tmp_path, "e.json",
        run("r", "START", "," + parent), run("r", "COMPLETE"),
        run("s", "START", "," + parent), run("s", "COMPLETE", "," + parent),
        run("t", "START"), run("t", "COMPLETE"),
    )
    assert {r.run_id: r.same_parent for r in event_consistency(events).collect()} == {"r": False, "s": True, "t": True}


def test_an_event_counts_once_for_a_dataset(spark, tmp_path):
    side = '{"namespace":"n","name":"d.t"}'
    line = f'{{"job":{{"namespace":"j","name":"x"}},"inputs":[{side},{side}],"outputs":[]}}'
    assert [r.n_events for r in dataset_edges(document(spark, tmp_path, "e.json", line), {}).collect()] == [1]


def test_a_broken_document_ends_the_read(spark, tmp_path):
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        document(spark, tmp_path, "broken.json", '{"eventType":"START"}', '{"eventType":').select("eventType").collect()
    assert "eventType" in event_schema().names


def test_a_key_twice_ends_the_merge(spark):
    target = spark.createDataFrame([(1, "a", 5)], "k int, v string, id int")
    twice = spark.createDataFrame([(2, "x"), (2, "y")], "k int, v string")
    with pytest.raises(Exception, match="occurs 2 times"):
        upsert_rows(target, twice, ["k"], ["v"], "id", 5)
    got = upsert_rows(target, spark.createDataFrame([(1, "b"), (3, "c")], "k int, v string"), ["k"], ["v"], "id", F.lit(5))
    assert sorted((r.k, r.v, r.id) for r in got.collect()) == [(1, "b", 5), (3, "c", 6)]


def test_quotes_in_text_literals(spark):
    for text in ("it's", "a\\b", "''"):
        assert spark.sql(f"SELECT {sql_literal(text)}").first()[0] == text


def test_created_tables_have_their_defaults(spark, tmp_path):
    table = Table("t", (Column("k", "int"), Column("n", "int", default=0), Column("d", "decimal(4,1)", default=12.0), Column("t", "string", default="it's")))
    ensure_table(spark, table, "defaults_probe", str(tmp_path))
    try:
        spark.sql("INSERT INTO defaults_probe (k) VALUES (1)")
        assert tuple(spark.table("defaults_probe").first()) == (1, 0, 12, "it's")
    finally:
        reset(spark, [], ["defaults_probe"])


def test_helpers_are_followed_to_their_ends(spark, tmp_path):
    sources = {
        "price": ["in.price"],
        "other": ["cte.price"],
        "out1": ["h.mix"],
        "mix": ["in.a", "h2.z"],
        "out2": ["h1.lvl1"],
        "lvl1": ["h2.lvl2"],
        "lvl2": ["in.b"],
        "out3": ["h.loop"],
        "loop": ["h.pool"],
        "pool": ["h.loop"],
    }
    fields = {
        c: {"inputFields": [{"namespace": "n", "name": s.split(".")[0], "field": s.split(".")[1]} for s in named]}
        for c, named in sources.items()
    }
    schema = {"fields": [{"name": c, "type": "text"} for c in ("price", "other", "out1", "out2", "out3")]}
    output = {"namespace": "n", "name": "out", "facets": {"schema": schema, "columnLineage": {"fields": fields}}}
    line = json.dumps({"inputs": [{"namespace": "n", "name": "in"}], "outputs": [output]})
    rows = collapse_intermediates(document(spark, tmp_path, "e.json", line), {}).collect()
    got = {(r.column_name, f"{r.src_dataset[2:]}.{r.src_column}", r.status) for r in rows if r.column_name in ("price", "other", "out1", "out2", "out3")}
    assert got == {
        ("price", "in.price", "direct"),
        ("other", "cte.price", "unresolved"),
        ("out1", "in.a", "collapsed"),
        ("out1", "h2.z", "unresolved"),
        ("out2", "in.b", "collapsed"),
        ("out3", "h.loop", "unresolved"),
    }
