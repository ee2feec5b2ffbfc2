"""Telemetry, status, message and machine tables read from the given Parquet tables.

The SELECT texts are plain ANSI SQL, so the checker runs the same text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import derive
from ..functions.numeric import rnd_even

# How a device id, type and location follow from a user id.
DEVICE_ID = "concat('device_', lpad(CAST(user_id AS STRING), 4, '0'))"
DEVICE_TYPE = """CASE WHEN user_id % 20 < 9 THEN 'sensor' WHEN user_id % 20 < 13 THEN 'gateway'
      WHEN user_id % 20 < 17 THEN 'camera' ELSE 'controller' END"""
LOCATION = """CASE (user_id * 5 + CAST(floor(user_id / 20) AS BIGINT)) % 8
      WHEN 0 THEN 'warehouse_a' WHEN 1 THEN 'warehouse_b' WHEN 2 THEN 'factory_floor_1'
      WHEN 3 THEN 'factory_floor_2' WHEN 4 THEN 'office_block' WHEN 5 THEN 'server_room'
      WHEN 6 THEN 'loading_bay' ELSE 'outdoor_yard' END"""
PROP = "CAST(regexp_extract(props, '[0-9]+', 0) AS INT)"


def by_type(sensor: int, gateway: int, camera: int, controller: int) -> str:
    return f"""CASE WHEN user_id % 20 < 9 THEN {sensor} WHEN user_id % 20 < 13 THEN {gateway}
      WHEN user_id % 20 < 17 THEN {camera} ELSE {controller} END"""


TELEMETRY_SQL = f"""
SELECT event_id AS id, ts AS timestamp, {DEVICE_ID} AS device_id,
 {DEVICE_TYPE} AS device_type, {LOCATION} AS location,
 least(CAST(99 AS DOUBLE), {by_type(8, 28, 65, 18)} + floor(value * CAST(2 AS DOUBLE)) / CAST(10 AS DOUBLE)) AS cpu_pct,
 {by_type(35, 55, 70, 45)} + k / CAST(10 AS DOUBLE) AS ram_pct,
 least(CAST(95 AS DOUBLE), {by_type(42, 52, 61, 48)} + floor(value * CAST(10 AS DOUBLE)) / CAST(100 AS DOUBLE)) AS temperature_c,
 CAST({by_type(-62, -55, -58, -60)} + k % 41 - 20 AS INT) AS signal_dbm,
 event_id * 60 AS uptime_s, (event_type = 'error' AND k < 10) AS is_anomaly
FROM (SELECT event_id, ts, user_id, event_type, value, {PROP} AS k FROM {{events}}) e
"""

SNAPSHOT_SQL = f"""
SELECT ts AS timestamp, user_id, {DEVICE_ID} AS device_id,
 {DEVICE_TYPE} AS device_type, {LOCATION} AS location,
 event_id * 60 AS uptime_s, event_id % 2000 AS publish_count, event_id % 16 AS error_count,
 k % 51 AS queue_depth, k % 13 AS reconnect_count, CASE WHEN value < 70 THEN 1 ELSE 0 END AS is_connected
FROM (SELECT event_id, ts, user_id, value, {PROP} AS k FROM {{events}}
      WHERE event_type = 'signup' AND user_id % 25 <> 0) e
"""

FLEET_EVENT_SQL = f"""
SELECT event_id AS id, {DEVICE_ID} AS device_id, {DEVICE_TYPE} AS device_type, {LOCATION} AS location,
 CASE event_type WHEN 'signup' THEN 'boot' WHEN 'error' THEN 'alert' WHEN 'click' THEN 'reconnect'
      ELSE 'watchdog_reset' END AS event_type,
 '1.4.2' AS firmware_version, ts AS event_timestamp
FROM {{events}} WHERE event_type <> 'view'
"""

MACHINE_SQL = """
SELECT udi, concat(machine_type, CAST(10000 + udi AS STRING)) AS product_id, machine_type,
 air_dk / CAST(10 AS DOUBLE) AS air_temp_k, (air_dk + diff_dk) / CAST(10 AS DOUBLE) AS process_temp_k,
 rpm AS rotational_speed_rpm, torque_d / CAST(10 AS DOUBLE) AS torque_nm, wear AS tool_wear_min,
 twf OR hdf OR pwf OR osf AS machine_failure, twf AS failure_twf, hdf AS failure_hdf, pwf AS failure_pwf,
 osf AS failure_osf, rnf AS failure_rnf
FROM (SELECT *, wear >= 200 AND udi % 25 = 0 AS twf, diff_dk < 86 AND rpm < 1200 AS hdf,
        rpm * torque_d > 1200000 AS pwf, wear * torque_d > 172000 AS osf, udi % 500 = 7 AS rnf
 FROM (SELECT o_orderkey AS udi,
  CASE WHEN o_custkey % 10 < 5 THEN 'L' WHEN o_custkey % 10 < 8 THEN 'M' ELSE 'H' END AS machine_type,
  2953 + o_orderkey * 31 % 92 AS air_dk, 76 + o_orderkey * 17 % 45 AS diff_dk,
  1168 + o_orderkey * 10473 % 911 AS rpm, 38 + o_orderkey * 7919 % 729 AS torque_d, o_orderkey * 13 % 254 AS wear
 FROM {orders}) a) b
"""

RAW_MACHINE_SQL = """
SELECT udi, product_id,
 CASE WHEN udi % 331 = 0 THEN CASE machine_type WHEN 'L' THEN 'low' WHEN 'M' THEN 'MED' ELSE 'h' END ELSE machine_type END AS type,
 CASE WHEN udi % 71 = 3 THEN NULL WHEN udi % 1250 = 11 THEN air_temp_k - CAST(273.15 AS DOUBLE) ELSE air_temp_k END AS air_temp_k,
 process_temp_k,
 CASE WHEN udi % 67 = 5 THEN NULL WHEN udi % 3001 = 13 THEN 99999 WHEN udi % 3001 = 17 THEN -500 ELSE rotational_speed_rpm END AS rotational_speed_rpm,
 CASE WHEN udi % 61 = 9 THEN NULL ELSE torque_nm END AS torque_nm,
 CASE WHEN udi % 97 = 21 THEN 'N/A' ELSE CAST(tool_wear_min AS STRING) END AS tool_wear_raw,
 CAST(machine_failure AS INT) AS machine_failure, CAST(failure_twf AS INT) AS twf, CAST(failure_hdf AS INT) AS hdf,
 CAST(failure_pwf AS INT) AS pwf, CAST(failure_osf AS INT) AS osf, CAST(failure_rnf AS INT) AS rnf
FROM {copies}
"""

MESSAGE_SQL = """
SELECT CASE WHEN id % 211 = 4 THEN concat('other/', device_id, '/telemetry')
            WHEN id % 211 = 5 THEN concat('fleet/', device_id, '/telemetry/extra')
            WHEN id % 211 = 6 THEN concat('fleet/', device_id, '/firmware')
            ELSE concat('fleet/', device_id, '/telemetry') END AS topic,
 CASE WHEN id % 97 = 3 THEN '{{"cpu_percent": 1'
      WHEN id % 97 = 5 THEN concat('{{"cpu_percent": ', CAST(cpu_pct AS STRING), '}}')
      ELSE concat('{{"device_type": "', device_type, '", ', CASE WHEN id % 89 = 2 THEN '' ELSE concat('"location": "', location, '", ') END,
           '"cpu_percent": ', CAST(cpu_pct AS STRING), ', "ram_percent": ', CAST(ram_pct AS STRING),
           ', "temperature_c": ', CAST(temperature_c AS STRING), ', "signal_dbm": ', CAST(signal_dbm AS STRING),
           ', "uptime_s": ', CAST(uptime_s AS STRING), CASE WHEN is_anomaly THEN ', "anomaly": true' ELSE '' END, '}}') END AS payload,
 timestamp AS arrival_ts
FROM {copies}
"""

STATUS_MESSAGE_SQL = """
SELECT concat('fleet/', device_id, '/status') AS topic,
 concat('{{"device_type": "', device_type, '", "location": "', location, '", "uptime_s": ', CAST(uptime_s AS STRING),
   ', "publish_count": ', CASE WHEN uptime_s % 3540 = 0 THEN '"many"' ELSE CAST(publish_count AS STRING) END, ', "error_count": ', CAST(error_count AS STRING),
   CASE WHEN queue_depth = 0 THEN '' ELSE concat(', "queue_depth": ', CAST(queue_depth AS STRING)) END,
   ', "reconnect_count": ', CAST(reconnect_count AS STRING),
   CASE WHEN is_connected = 1 THEN ', "is_connected": true}}' ELSE ', "is_connected": false}}' END) AS payload,
 timestamp AS arrival_ts
FROM {snapshots}
"""

EVENT_MESSAGE_SQL = """
SELECT concat('fleet/', device_id, '/events') AS topic,
 concat('{{"device_type": "', device_type, '", "location": "', location, '"',
   CASE WHEN event_type = 'boot' THEN concat(', "event": "boot", "firmware_version": "', firmware_version, '"')
        WHEN event_type = 'watchdog_reset' THEN '' ELSE concat(', "event": "', event_type, '"') END, '}}') AS payload,
 event_timestamp AS arrival_ts
FROM {fleet_events}
"""

STATUS_COLUMNS = [
    "device_id", "device_type", "location", "uptime_s", "uptime_hours", "messages_published",
    "error_count", "queue_depth", "reconnect_count", "connection_status",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _twice_where(df: DataFrame, again) -> DataFrame:
    """Every row once, and the resent rows a second time; a narrow operation."""
    resend = F.when(again, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return df.withColumn("copy_no", F.explode(resend)).drop("copy_no")


def telemetry_from(events: DataFrame) -> DataFrame:
    return events.sparkSession.sql(TELEMETRY_SQL, events=events)


def telemetry_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry_from(table(spark, sf_dir, "events"))


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.with_reading_classes(telemetry_base(spark, sf_dir))


def snapshots_from(events: DataFrame) -> DataFrame:
    return events.sparkSession.sql(SNAPSHOT_SQL, events=events)


def status_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots_from(table(spark, sf_dir, "events"))


def latest_per_device(snapshots: DataFrame, ts: str = "timestamp") -> DataFrame:
    """The newest snapshot of each device, combined map-side.

    A snapshot is taken whole: of two with one time the greater row counts, so
    their values are never mixed.
    """
    rest = [c for c in snapshots.columns if c not in ("device_id", ts)]
    newest = F.max(F.struct(ts, *rest)).alias("newest")
    return snapshots.groupBy("device_id").agg(newest).select(
        *["device_id" if c == "device_id" else F.col(f"newest.{c}").alias(c) for c in snapshots.columns])


def status(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = latest_per_device(status_snapshots(spark, sf_dir))
    return (
        derive.with_status_classes(newest)
        .withColumnRenamed("publish_count", "messages_published")
        .select(*STATUS_COLUMNS)
    )


def fleet_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(FLEET_EVENT_SQL, events=table(spark, sf_dir, "events"))


def machines_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(MACHINE_SQL, orders=table(spark, sf_dir, "orders"))


def with_machine_features(df: DataFrame) -> DataFrame:
    """Power, temperature gap, load products and wear stage of clean readings."""
    rpm, torque, wear = F.col("rotational_speed_rpm"), F.col("torque_nm"), F.col("tool_wear_min")
    return df.withColumns(
        {
            "power_w": rnd_even(rpm * torque / F.lit(9550.0), 2),
            "temp_diff_k": rnd_even(F.col("process_temp_k") - F.col("air_temp_k"), 2),
            "wear_torque_product": rnd_even(wear * torque, 1),
            "speed_torque_product": rnd_even(rpm * torque, 0),
            "wear_stage": derive.wear_stage(wear),
        }
    )


def machines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_machine_features(machines_base(spark, sf_dir))


def machines_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    copies = _twice_where(machines_base(spark, sf_dir), F.col("udi") % 333 == 0)
    return spark.sql(RAW_MACHINE_SQL, copies=copies)


def messages_from(events: DataFrame) -> DataFrame:
    copies = _twice_where(telemetry_from(events), F.col("id") % 101 == 0)
    return events.sparkSession.sql(MESSAGE_SQL, copies=copies)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages_from(table(spark, sf_dir, "events"))


def status_messages_from(events: DataFrame) -> DataFrame:
    return events.sparkSession.sql(STATUS_MESSAGE_SQL, snapshots=snapshots_from(events))


def status_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status_messages_from(table(spark, sf_dir, "events"))


def event_messages_from(events: DataFrame) -> DataFrame:
    fleet = events.sparkSession.sql(FLEET_EVENT_SQL, events=events)
    return events.sparkSession.sql(EVENT_MESSAGE_SQL, fleet_events=fleet)


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_messages_from(table(spark, sf_dir, "events"))


def all_messages_from(events: DataFrame) -> DataFrame:
    """Telemetry, status and event messages of one source."""
    return messages_from(events).unionByName(status_messages_from(events)).unionByName(event_messages_from(events))
