"""State, versions and counts of the streaming jobs over several runs, each run a restart from the checkpoint."""

import datetime

import pytest
from pyspark.sql import functions as F

from telemill.session import new_folder
from telemill.sources import messages as M
from telemill.streaming import ingest as S
from telemill.streaming.counts import read_counts
from telemill.streaming.store import KeyedTable, Kind
from test_messages import FULL, T0, frame

HOUR = 3600


def source(spark):
    folder = new_folder(spark, "src")

    def put(rows):
        frame(spark, rows).coalesce(1).write.mode("append").parquet(folder)
    return folder, put, lambda: S.file_stream(spark, folder, "*.parquet")


def hours_of(df):
    return sorted((r["time"] - T0).total_seconds() / HOUR for r in df.collect())


def test_dedup_tells_first_repeated_and_late_points_across_restarts(spark):
    _, put, stream = source(spark)
    folder = new_folder(spark, "dedup")
    put([("fleet/a/telemetry", FULL, 0), ("fleet/a/telemetry", FULL, 0), ("fleet/b/telemetry", FULL, 50 * HOUR)])
    S.stream_dedup(stream(), folder, horizon="30 hours")
    assert hours_of(S.read_dedup(spark, folder)) == [0, 50]
    # the watermark is at hour 20: of these, 40 is new, 50 a resend within the horizon, 0 a resend and 5 a new one beyond it
    put([("fleet/a/telemetry", FULL, 40 * HOUR), ("fleet/b/telemetry", FULL, 50 * HOUR), ("fleet/a/telemetry", FULL, 0),
         ("fleet/a/telemetry", FULL, 5 * HOUR), ("fleet/a/telemetry", FULL, 5 * HOUR)])
    S.stream_dedup(stream(), folder, horizon="30 hours")
    put([("fleet/a/telemetry", FULL, 40 * HOUR), ("fleet/a/telemetry", FULL, 5000 * HOUR)])
    S.stream_dedup(stream(), folder, horizon="30 hours")
    assert hours_of(S.read_dedup(spark, folder)) == [0, 40, 50, 5000]
    assert hours_of(S.read_late(spark, folder)) == [0, 5, 5]
    assert {r["outcome"]: r["points"] for r in S.dedup_counts(spark, folder).collect()} == {"first": 4, "repeat": 3, "late": 3}
    assert hours_of(S.settled(spark, folder)) == [5]  # the one late point that nobody has seen
    put([("fleet/b/telemetry", FULL, 50 * HOUR)])  # a resend when its key has long expired
    S.stream_dedup(stream(), folder, horizon="30 hours")
    assert hours_of(S.read_dedup(spark, folder)) == [0, 40, 50, 5000]
    assert S.read_late(spark, folder).count() == 4
    left = spark.read.format("statestore").option("path", f"{folder}/_progress").option("stateVarName", "days").load()
    assert left.count() == 1  # only the day of the newest point is still held


def test_a_device_clock_that_runs_ahead_makes_nobody_late(spark):
    _, put, stream = source(spark)
    folder = new_folder(spark, "ahead")
    put([("fleet/a/telemetry", {**FULL, "timestamp": "2999-01-01T00:00:00Z"}, 0), ("fleet/b/telemetry", FULL, 0)])
    S.stream_dedup(stream(), folder, horizon="4000 days")
    put([("fleet/c/telemetry", FULL, HOUR)])
    S.stream_dedup(stream(), folder, horizon="4000 days")
    assert S.read_late(spark, folder).count() == 0 and S.read_dedup(spark, folder).count() == 3


def test_hours_close_once_and_late_messages_are_corrections(spark):
    _, put, stream = source(spark)
    folder = new_folder(spark, "hours")
    at = lambda h, cpu: ("fleet/a/telemetry", {**FULL, "cpu_percent": cpu}, int(h * HOUR))
    put([at(0.1, 25.4), at(0.2, 9.7), at(1, 10.0), at(5, 20.0)])
    S.stream_hourly(stream(), folder, delay="2 hours")

    def told():
        out = {}
        for r in S.hour_sums(spark, folder).groupBy("hour_start", "outcome").agg(F.sum("readings").alias("n")).collect():
            out[((r["hour_start"] - T0).total_seconds() / HOUR, r["outcome"])] = r["n"]
        return out
    assert told() == {(0, "closed"): 2, (1, "closed"): 1, (5, "open"): 1}
    first = S.read_hourly(spark, folder, closed_only=True).orderBy("hour_start").collect()
    assert first[0]["avg_cpu_pct"] == 17.5  # 25.4 and 9.7, added as doubles
    put([at(0.5, 99.0), at(4, 30.0), at(5, 40.0)])
    S.stream_hourly(stream(), folder, delay="2 hours")
    assert told() == {(0, "closed"): 2, (0, "correction"): 1, (1, "closed"): 1, (4, "open"): 1, (5, "open"): 2}
    assert S.read_hourly(spark, folder, closed_only=True).orderBy("hour_start").collect() == first
    put([at(30, 50.0)])
    S.stream_hourly(stream(), folder, delay="2 hours")
    got = [((r["hour_start"] - T0).total_seconds() / HOUR, r["reading_count"], r["avg_cpu_pct"], r["peak_cpu_pct"])
           for r in S.read_hourly(spark, folder).orderBy("hour_start").collect()]
    assert got == [(0, 3, 44.7, 99.0), (1, 1, 10.0, 10.0), (4, 1, 30.0, 30.0), (5, 2, 30.0, 40.0), (30, 1, 50.0, 50.0)]


def rows_of(spark, table, values, batch):
    """Values (key, day, x) as a batch of a small keyed table."""
    rows = [("r", f"d{d}", k, x, T0 + datetime.timedelta(days=d)) for k, d, x in values]
    df = spark.createDataFrame(rows, "kind string, part string, k string, x int, time timestamp")
    return table.commit(df.withColumn("batch_id", F.lit(batch).cast("long")), "s", batch)


KINDS = {"r": Kind(("k", "time"), ("x",), ("batch_id",))}


def content(table, **args):
    return sorted((r["k"], (r["time"] - T0).days, r["x"]) for r in table.read("r", **args).collect())


def test_table_replaces_keys_and_reads_stay_bounded(spark):
    table = KeyedTable(spark, new_folder(spark, "table"), KINDS, merge_every=3, keep=2)
    with pytest.raises(FileNotFoundError):
        table.read("r")
    want = {}
    for b in range(8):
        batch = [("a", 0, b), ("b", b % 2, 10 * b), ("c", b, b)]
        assert rows_of(spark, table, batch, b)
        want.update({(k, d): x for k, d, x in batch})
        assert content(table) == sorted((k, d, x) for (k, d), x in want.items())
        assert all(len(p["deltas"]) < 3 for p in table.manifest()["parts"])
    assert not rows_of(spark, table, [("z", 0, 1)], 7)  # a repeated batch
    assert content(table) == sorted((k, d, x) for (k, d), x in want.items())
    assert table.brought() == {"r": 24}
    table.compact()
    assert content(table) == sorted((k, d, x) for (k, d), x in want.items())
    assert len(table._versions()) == 2
    named = {f for p in table.manifest()["parts"] for f in p["base"]}
    assert len(named) == len(table.manifest()["parts"]) and all(not p["deltas"] for p in table.manifest()["parts"])


def test_a_crash_before_the_switch_loses_and_doubles_nothing(spark, monkeypatch):
    table = KeyedTable(spark, new_folder(spark, "crash"), KINDS, merge_every=2)
    rows_of(spark, table, [("a", 0, 1)], 0)
    before = content(table)
    with monkeypatch.context() as patch:
        def crash(self, manifest):
            raise OSError("lost")
        patch.setattr(KeyedTable, "_switch", crash)
        with pytest.raises(OSError):
            rows_of(spark, table, [("a", 0, 2), ("b", 0, 3)], 1)
    assert content(table) == before
    again = KeyedTable(spark, table.folder, KINDS, merge_every=2)  # the stream starts over with its batch
    reader = again.read("r")
    assert rows_of(spark, again, [("a", 0, 2), ("b", 0, 3)], 1)  # commits, then compacts
    assert content(again) == [("a", 0, 2), ("b", 0, 3)] and again.brought() == {"r": 3}
    assert [(r["k"], r["x"]) for r in reader.collect()] == [("a", 1)]  # a reader keeps the version it began with
    files = again.files
    with pytest.raises(FileExistsError):
        files.put(again._name(again.manifest()["version"]), "{}")


def test_ranges_open_only_the_parts_they_reach(spark):
    table = KeyedTable(spark, new_folder(spark, "zones"), KINDS, merge_every=2)
    for b in range(2):
        rows_of(spark, table, [(f"k{d}{b}", d, d) for d in range(6)], b)
    day = 86_400_000_000
    start = int(T0.replace(tzinfo=datetime.timezone.utc).timestamp() * 1_000_000)
    assert table.newest("r") == start + 5 * day
    some = table.read("r", since=start + 3 * day, until=start + 4 * day)
    assert sorted({r["time"].day for r in some.collect()}) == [4, 5] and some.count() == 4
    assert {f.split("_part=")[1].split("/")[0] for f in some.inputFiles()} == {"d3", "d4"}


def test_counts_of_batches_are_stored(spark):
    files, put, stream = source(spark)
    folder = new_folder(spark, "counted")
    put([("fleet/a/telemetry", FULL, 0), ("fleet/a/telemetry", "{", 1), ("other/x/telemetry", FULL, 1), ("fleet/a/firmware", {}, 2)])
    S.ingest(stream(), folder)
    put([("fleet/b/status", {}, 3), ("fleet/b/events", "nope", 3)])
    S.ingest(stream(), folder)
    counts = [tuple(r) for r in read_counts(spark, folder).filter("messages_received > 0").orderBy("batch_id").collect()]
    assert counts == [(0, 3, 1, 1, 1), (1, 2, 1, 1, 0)]
    whole = M.ingest_quality(M.classified(spark.read.parquet(files)))
    assert tuple(whole.first()) == (5, 2, 2, 1)
    assert S.read_points(spark, folder, "telemetry", hours=1).count() == 1


def test_latest_status_is_a_snapshot_and_a_short_log(spark):
    _, put, stream = source(spark)
    folder = new_folder(spark, "latest")
    for n in range(5):
        put([("fleet/a/status", {"queue_depth": n}, 10 * n), ("fleet/b/status", {"queue_depth": 9 - n}, 100 - n)])
        S.stream_latest_status(stream(), folder, merge_every=2)
        assert len(S.status_table(spark, folder).read("latest").inputFiles()) <= 2 * 2 * 2
    got = {r["device_id"]: r["queue_depth"] for r in S.read_latest_status(spark, folder).collect()}
    assert got == {"a": 4, "b": 9}
