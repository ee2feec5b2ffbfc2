import datetime

from pyspark.sql import functions as F

import published as P
from telemill.plans import fleet, report
from telemill.sources import bindings as B

STATUS_SCHEMA = ("device_id string, device_type string, location string, uptime_s bigint, uptime_hours double, "
                 "messages_published bigint, error_count bigint, queue_depth bigint, reconnect_count bigint, connection_status string")


def status(spark):
    return spark.createDataFrame(P.STATUS, STATUS_SCHEMA)


def test_published_scores(spark):
    by_id = {s[0]: s for s in P.STATUS}
    data = [(d, by_id[d][1], by_id[d][2], by_id[d][9], r[0], r[1], r[2], r[3], by_id[d][8], by_id[d][7])
            for d, r in P.RELIABILITY.items()]
    metrics = spark.createDataFrame(
        data, "device_id string, device_type string, location string, connection_status string, avg_cpu double, "
              "max_cpu double, avg_temp double, anomaly_count bigint, reconnect_count bigint, queue_depth bigint")
    got = {r["device_id"]: (r["health_score"], int(r["reliability_tier"][5]), r["health_rank"])
           for r in fleet.score_devices(metrics).collect()}
    assert got == {d: r[4:] for d, r in P.RELIABILITY.items()}


def test_published_status_results(spark):
    st = status(spark)
    above = [(r["device_id"], r["reconnect_count"], r["above_fleet_avg"]) for r in fleet.above_average_reconnects(st).collect()]
    assert above == [("device_008", 12, 5.3), *[(f"device_{i}", 11, 4.3) for i in ("002", "003", "012", "013")], ("device_015", 10, 3.3)]
    assert [r["device_id"] for r in report.high_reconnect(st).collect()] == [a[0] for a in above]
    assert [r["device_id"] for r in report.reliable_devices(st).collect()] == ["device_010"]
    assert report.stable_device(st).first()["device_id"] == "device_010"
    worst = report.worst_device(st).first()
    assert (worst["device_id"], worst["queue_depth"], worst["connection_status"]) == ("device_008", 23, "Online")
    assert report.most_queued(st).first()["device_id"] == "device_004"
    near = report.near_capacity(st).first()
    assert near["device_ids"] == "device_004 and device_009" and near["total_queue_depth"] == 99
    assert near["devices_text"].startswith("device_004 (warehouse_b, 50 messages queued) and ")


def test_stable_device_falls_back_to_all(spark):
    st = status(spark).filter("device_id <> 'device_010'")
    assert report.stable_device(st).first()["device_id"] == "device_005"
    assert report.near_capacity(st.filter("connection_status = 'Online'")).first()["device_ids"] == "none"


def readings(spark, data):
    """(device, second, cpu, temperature)"""
    start = datetime.datetime(2026, 1, 1)
    rows = [(i, d, "sensor", "lab", start + datetime.timedelta(seconds=s), c, t) for i, (d, s, c, t) in enumerate(data)]
    return spark.createDataFrame(
        rows, "id bigint, device_id string, device_type string, location string, timestamp timestamp_ntz, cpu_pct double, temperature_c double")


def test_spikes_are_strict_and_cpu_wins(spark):
    df = readings(spark, [
        ("a", 0, 10.0, 40.0), ("a", 1, 35.0, 40.0),      # exactly 25: no
        ("a", 2, 61.0, 60.0),                            # both: CPU
        ("a", 3, 61.0, 65.0), ("a", 4, 61.0, 70.5),      # exactly 5: no; then temperature only
        ("b", 0, 99.0, 90.0)])                           # first reading of a device
    got = [(r["device_id"], r["cpu_delta"], r["temp_delta"], r["spike_type"]) for r in fleet.spikes(df).collect()]
    assert got == [("a", 26.0, 20.0, "CPU spike"), ("a", 0.0, 5.5, "Temp spike")]


def test_hot_device_gives_the_same_rows(spark, sf_dir):
    tel = B.telemetry(spark, sf_dir)
    hot = tel.withColumn("device_id", F.when(F.col("id") % 3 == 0, "device_hot").otherwise(F.col("device_id")))
    for job in (fleet.running_counts, lambda t, **k: fleet.spikes(t, top=1000, **k)):
        plain, cut = job(hot), job(hot, rows=40)
        assert plain.exceptAll(cut).count() == 0 and cut.exceptAll(plain).count() == 0


def test_having_needs_more_than_fifty(spark):
    data = [("x", "sensor", False)] * 50 + [("y", "sensor", False)] * 50 + [("y", "sensor", True)]
    df = spark.createDataFrame(data, "location string, device_type string, is_anomaly boolean")
    assert [tuple(r) for r in fleet.anomaly_by_location(df).collect()] == [("y", "sensor", 51, 1, 1.96)]


def test_latest_status_is_unique(spark):
    data = [("a", 1, 5), ("a", 3, 7), ("a", 2, 9), ("b", 1, 1)]
    df = spark.createDataFrame(data, "device_id string, timestamp int, queue_depth int")
    assert sorted(tuple(r) for r in B.latest_per_device(df).collect()) == [("a", 3, 7), ("b", 1, 1)]


def test_device_without_status_counts_the_full_cap(spark):
    data = [("a", "t", "l", None, 10.0, 20.0, 30.0, 0, None, None)]
    metrics = spark.createDataFrame(
        data, "device_id string, device_type string, location string, connection_status string, avg_cpu double, "
              "max_cpu double, avg_temp double, anomaly_count bigint, reconnect_count bigint, queue_depth bigint")
    assert fleet.score_devices(metrics).first()["health_score"] == 80.0
