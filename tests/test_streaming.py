import datetime as dt
import os
import tempfile

import pytest

from tarmac.sources import bindings

from tarmac.streaming.run_pairing import pair_or_release, pair_runs, run_states, write_available

DDL = "run_id string, event_type string, event_time timestamp_ntz"


def batches(spark, folder, *groups):
    for rows in groups:
        df = spark.createDataFrame(rows, "run_id string, event_type string, event_time string")
        df.selectExpr("run_id", "event_type", "CAST(event_time AS TIMESTAMP_NTZ) AS event_time").coalesce(1).write.mode(
            "append"
        ).parquet(folder)


def source(spark, folder):
    return spark.readStream.schema(DDL).option("maxFilesPerTrigger", 1).parquet(folder)


@pytest.fixture
def place():
    return tempfile.mkdtemp(prefix="tarmac-stream-")


def test_pairs_repeats_and_late_events(spark, place):
    batches(
        spark,
        f"{place}/in",
        [("a", "START", "2026-01-01 10:00:00"), ("b", "START", "2026-01-01 10:00:10"), ("a", "START", "2026-01-01 10:00:00")],
        [("a", "COMPLETE", "2026-01-01 10:00:03.421"), ("a", "COMPLETE", "2026-01-01 10:00:03.421")],
    )
    pairs = pair_runs(source(spark, f"{place}/in"), within="1 hour", lateness="10 minutes")
    write_available(pairs, f"{place}/out", f"{place}/state")
    got = [tuple(r) for r in spark.read.parquet(f"{place}/out").select("run_id", "duration_secs").collect()]
    assert got == [("a", 3.421)]

    # a later start continues from the saved state: b completes, a's end is delivered again, c lies out of bound
    batches(
        spark,
        f"{place}/in",
        [("b", "COMPLETE", "2026-01-01 10:01:10"), ("a", "COMPLETE", "2026-01-01 10:00:03.421")],
        [("c", "START", "2026-01-01 10:00:20"), ("c", "COMPLETE", "2026-01-01 11:30:00")],
    )
    pairs = pair_runs(source(spark, f"{place}/in"), within="1 hour", lateness="10 minutes")
    write_available(pairs, f"{place}/out", f"{place}/state")
    got = sorted(tuple(r) for r in spark.read.parquet(f"{place}/out").select("run_id", "duration_secs").collect())
    assert got == [("a", 3.421), ("b", 60.0)]

    # the clock moves to 13:00, which counts one batch later; an event of 10:00 is then too late
    batches(
        spark,
        f"{place}/in",
        [("d", "START", "2026-01-01 13:00:00"), ("e", "COMPLETE", "2026-01-01 13:00:00")],
        [("g", "START", "2026-01-01 13:00:01"), ("h", "COMPLETE", "2026-01-01 13:00:01")],
        [("f", "START", "2026-01-01 10:00:00"), ("f", "COMPLETE", "2026-01-01 10:00:05")],
    )
    pairs = pair_runs(source(spark, f"{place}/in"), within="1 hour", lateness="10 minutes")
    write_available(pairs, f"{place}/out", f"{place}/state")
    assert spark.read.parquet(f"{place}/out").count() == 2


def test_runs_that_never_complete_are_released(spark, place):
    batches(
        spark,
        f"{place}/in",
        [("a", "START", "2026-01-01 10:00:00"), ("b", "START", "2026-01-01 10:00:10"), ("c", "START", "2026-01-01 10:00:20")],
        [("a", "COMPLETE", "2026-01-01 10:00:05"), ("d", "COMPLETE", "2026-01-01 10:00:30"), ("a", "COMPLETE", "2026-01-01 10:00:05")],
        [("c", "COMPLETE", "2026-01-01 11:30:00"), ("e", "START", "2026-01-01 11:40:00")],
    )

    def run():
        stream = pair_or_release(source(spark, f"{place}/in"), within="1 hour", lateness="10 minutes")
        query = write_available(stream, f"{place}/out", f"{place}/state")
        found = run_states(spark.read.schema(stream.schema).parquet(f"{place}/out")).collect()
        return query, {r.run_id: (r.state, r.duration_secs) for r in found}

    query, states = run()
    # the clock stands at 11:20: b and d can find no partner any more; e may still complete
    assert states["a"] == ("paired", 5.0) and states["b"] == ("never completed", None) and states["d"] == ("no start", None)
    assert "e" not in states
    assert any("rocksdb" in name for s in query.lastProgress["stateOperators"] for name in s["customMetrics"])

    # two more files: the first moves the clock, the second lets what is over be released
    batches(
        spark,
        f"{place}/in",
        [("x", "START", "2026-01-02 10:00:00"), ("x", "COMPLETE", "2026-01-02 10:00:00")],
        [("y", "START", "2026-01-03 10:00:00"), ("y", "COMPLETE", "2026-01-03 10:00:00")],
    )
    _, states = run()
    assert states["c"] == ("late", 5380.0) and states["e"] == ("never completed", None) and states["a"] == ("paired", 5.0)


def test_a_batch_writes_its_changes_only(spark, place):
    """Files of the whole state are not written again by every batch."""
    batches(spark, f"{place}/in", [("a", "START", "2026-01-01 10:00:00"), ("a", "COMPLETE", "2026-01-01 10:00:05")])
    keys = ["providerClass", "rocksdb.changelogCheckpointing.enabled", "rocksdb.trackTotalNumberOfRows"]
    before = [spark.conf.get(f"spark.sql.streaming.stateStore.{key}", None) for key in keys]
    write_available(pair_runs(source(spark, f"{place}/in")), f"{place}/out", f"{place}/state")
    written = [name for _, _, names in os.walk(f"{place}/state/state") for name in names]
    assert any(name.endswith(".changelog") for name in written)
    assert not any(name.endswith(".sst") for name in written)
    assert [spark.conf.get(f"spark.sql.streaming.stateStore.{key}", None) for key in keys] == before


@pytest.mark.parametrize("n", [0, 3, 1200])
def test_deliveries_are_written_in_several_files(spark, place, monkeypatch, n):
    """As many files for each delivery, in its order, with the rows that one file a delivery holds."""
    day, kinds = dt.datetime(2024, 1, 1), ["purchase", "click", "error"]
    rows = [(i, day + dt.timedelta(minutes=i), i % 7, kinds[i // 2 % 3], 1.0, "{}") for i in range(n)]
    spark.createDataFrame(rows, bindings.STAR_SCHEMAS["events"]).write.parquet(f"{place}/events.parquet")

    def delivered(per_file, to):
        monkeypatch.setattr(bindings, "EVENTS_PER_FILE", per_file)
        files = bindings.delivered_events(spark, place, to)
        found = sorted((f for f in os.listdir(to) if f.startswith("part-")), key=lambda f: os.stat(f"{to}/{f}").st_mtime_ns)
        assert len(found) == files * (8 if n else 6)
        parts = [[f"{to}/{f}" for f in found[i : i + files]] for i in range(0, len(found), files)]
        return files, [sorted(tuple(r) for r in spark.read.parquet(*part).collect()) for part in parts]

    one, want = delivered(200_000, f"{place}/one")
    several, got = delivered(50, f"{place}/several")
    assert (one, several) == (1, 4 if n == 1200 else 1) and got == want
    if n == 1200:
        batch = bindings.delivered_event_stream(spark, f"{place}/several", several)
        query = write_available(batch.select("eventTime"), f"{place}/out", f"{place}/state")
        assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [len(rows) for rows in want]
