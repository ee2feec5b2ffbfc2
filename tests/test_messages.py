import datetime
import json

from pyspark.sql import functions as F

from telemill.session import new_folder
from telemill.sources import csv_tables as C, messages as M, points as P
from telemill.streaming import ingest as S

T0 = datetime.datetime(2026, 1, 1, 10, 0)
FULL = {"device_type": "camera", "location": "lab", "cpu_percent": 50.5, "ram_percent": 20, "temperature_c": 40.25,
        "signal_dbm": -61, "uptime_s": 10, "publish_count": 3}


def frame(spark, rows):
    return spark.createDataFrame([(t, p if isinstance(p, str) else json.dumps(p), T0 + datetime.timedelta(seconds=s))
                                  for t, p, s in rows], "topic string, payload string, arrival_ts timestamp")


def outcomes(spark, rows):
    return [r["outcome"] for r in M.classified(frame(spark, rows).coalesce(1)).collect()]


def test_routing_and_dead_letters(spark):
    without = {k: v for k, v in FULL.items() if k != "signal_dbm"}
    assert outcomes(spark, [
        ("fleet/d1/telemetry", FULL, 0), ("other/d1/telemetry", FULL, 0), ("fleet/d1/telemetry/extra", FULL, 0),
        ("fleet/d1/firmware", FULL, 0), ("fleet/d1/firmware", "{", 0), ("fleet/d1/telemetry", '{"cpu_percent": 1', 0),
        ("fleet/d1/telemetry", without, 0), ("fleet/d1/telemetry", {**FULL, "cpu_percent": "high"}, 0),
        ("fleet/d1/status", {}, 0), ("fleet/d1/events", {}, 0), ("fleet/d1/status", "nope", 0),
        ("fleet/d1/status", {"queue_depth": "abc"}, 0), ("fleet/d1/telemetry", {**FULL, "publish_count": "xx"}, 0),
        ("fleet/d1/status", {"is_connected": "perhaps"}, 0),
    ]) == ["written", "not_subscribed", "ignored_topic", "ignored_kind", "parse_error", "parse_error", "parse_error",
           "parse_error", "written", "written", "parse_error", "parse_error", "parse_error", "parse_error"]


def test_defaults(spark):
    parsed = M.classified(frame(spark, [
        ("fleet/a/telemetry", {k: v for k, v in FULL.items() if k not in ("device_type", "location", "publish_count")}, 5),
        ("fleet/b/telemetry", {**FULL, "anomaly": True, "timestamp": "2026-01-01T09:00:00+00:00", "uptime_s": 10.9}, 5),
        ("fleet/a/status", {"is_connected": True, "queue_depth": 4}, 1), ("fleet/a/events", {"event": "boot"}, 2)]))
    a, b = M.telemetry_points(parsed).orderBy("device_id").collect()
    assert (a["device_type"], a["location"], a["anomaly"], a["publish_count"], a["time"]) == (
        "unknown", "unknown", "False", 0, T0 + datetime.timedelta(seconds=5))
    assert (b["anomaly"], b["time"], b["uptime_s"]) == ("True", datetime.datetime(2026, 1, 1, 9), 10)
    s = M.status_points(parsed).first()
    assert (s["is_connected"], s["queue_depth"], s["error_count"], s["device_type"]) == (1, 4, 0, "unknown")
    e = M.event_points(parsed).first()
    assert (e["event"], e["firmware_version"], e["event_count"]) == ("boot", "unknown", 1)
    assert tuple(M.ingest_quality(parsed).first()) == (4, 4, 0, 0)


def test_stream_ingest_replaces_repeated_keys_and_can_go_on(spark):
    source, folder = new_folder(spark, "src"), new_folder(spark, "out")
    frame(spark, [("fleet/a/telemetry", FULL, 0), ("fleet/a/telemetry", FULL, 0), ("fleet/a/telemetry", "{", 1)]).coalesce(1).write.parquet(source)
    S.ingest(S.file_stream(spark, source, "*.parquet"), folder)
    again = {**FULL, "cpu_percent": 60.0}
    frame(spark, [("fleet/a/telemetry", again, 0), ("fleet/b/telemetry", FULL, 2)]).coalesce(1).write.mode("append").parquet(source)
    query = S.ingest(S.file_stream(spark, source, "*.parquet"), folder)
    got = sorted((r["device_id"], r["cpu_percent"]) for r in S.read_points(spark, folder, "telemetry").collect())
    assert got == [("a", 60.0), ("b", 50.5)]
    assert S.read_dead_letters(spark, folder).count() == 1
    assert query.exception() is None


def test_stream_dedup_and_late_rows(spark):
    source, folder, hourly = (new_folder(spark, n) for n in ("src", "dedup", "hourly"))
    batches = [
        [("fleet/a/telemetry", FULL, 0), ("fleet/a/telemetry", FULL, 0), ("fleet/a/telemetry", FULL, 7200)],
        [("fleet/a/telemetry", FULL, 7200), ("fleet/a/telemetry", FULL, 3)],       # a resend, and a row two hours late
    ]
    for rows in batches:
        frame(spark, rows).coalesce(1).write.mode("append").parquet(source)
        S.stream_dedup(S.file_stream(spark, source, "*.parquet"), folder)
        S.stream_hourly(S.file_stream(spark, source, "*.parquet"), hourly)
    seconds = sorted((r["time"] - T0).total_seconds() for r in S.read_dedup(spark, folder).collect())
    assert seconds == [0.0, 3.0, 7200.0]  # the resend is dropped, the late reading is not
    hours = sorted((r["hour_start"], r["reading_count"]) for r in S.read_hourly(spark, hourly).collect())
    assert hours == [(T0, 3), (T0 + datetime.timedelta(hours=2), 2)]  # all readings, the last hour included


def test_stream_latest_status(spark):
    source, folder = new_folder(spark, "src"), new_folder(spark, "latest")
    for rows in ([("fleet/a/status", {"queue_depth": 1}, 0), ("fleet/b/status", {"queue_depth": 2}, 0)],
                 [("fleet/a/status", {"queue_depth": 5, "is_connected": True, "uptime_s": 5400}, 9)],
                 [("fleet/a/status", {"queue_depth": 4}, 3)]):
        frame(spark, rows).coalesce(1).write.mode("append").parquet(source)
        S.stream_latest_status(S.file_stream(spark, source, "*.parquet"), folder)
    got = {r["device_id"]: (r["queue_depth"], r["connection_status"], r["uptime_hours"]) for r in S.read_latest_status(spark, folder).collect()}
    assert got == {"a": (5, "Online", 1.5), "b": (2, "Offline", 0.0)}


def test_ranges_pivots_and_ids(spark):
    rows = [(T0 + datetime.timedelta(hours=h), f"d{h % 2}", float(h)) for h in range(10)]
    df = spark.createDataFrame(rows, "timestamp timestamp_ntz, device_id string, cpu double")
    assert P.range_scan(df, 6).count() == 7
    assert P.range_scan(df, 2, as_of=T0 + datetime.timedelta(hours=3)).count() == 9
    assert P.range_scan(df.filter("false"), 6).count() == 0
    ids = sorted((r["surrogate_id"], r["cpu"]) for r in P.surrogate_id(df, ["timestamp", "device_id"], rows=3).collect())
    assert ids == [(i + 1, float(i)) for i in range(10)]
    long = P.unpivot_fields(df, ["timestamp", "device_id"], ["cpu"])
    assert P.pivot_fields(long, ["timestamp", "device_id"], ["cpu"]).exceptAll(df).count() == 0


def test_csv_round_trip_with_display_names(spark):
    df = spark.createDataFrame([("a", "camera", "lab", 5, 0.5, 6, 1, 2, 3, "Online")],
                               ", ".join(f"{c} {t}" for c, t in C.STATUS_CSV))
    path = C.write_csv(df, new_folder(spark, "csv"), C.STATUS_NAMES)
    assert spark.read.option("header", True).csv(path).columns[:4] == ["Device ID", "Device Type", "Location", "Uptime (s)"]
    assert C.load_status_csv(spark, path).collect() == df.collect()
