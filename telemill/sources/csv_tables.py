"""CSV tables with display headers: explicit schemas in, renamed sinks out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.derive import flag_text
from ..functions.numeric import known_numbers

# snake_case names and the display names of the exported files.
TELEMETRY_NAMES = {
    "timestamp": "Timestamp", "device_id": "Device ID", "device_type": "Device Type", "location": "Location",
    "cpu_pct": "CPU %", "ram_pct": "RAM %", "temperature_c": "Temperature (°C)", "signal_dbm": "Signal (dBm)",
    "uptime_s": "Uptime (s)", "publish_count": "Publish Count", "is_anomaly": "Is Anomaly", "hour": "Hour",
    "date": "Date", "weekday": "Weekday", "signal_quality": "Signal Quality", "temp_status": "Temp Status",
    "cpu_status": "CPU Status",
}
STATUS_NAMES = {
    "device_id": "Device ID", "device_type": "Device Type", "location": "Location", "uptime_s": "Uptime (s)",
    "uptime_hours": "Uptime (hours)", "messages_published": "Messages Published", "error_count": "Error Count",
    "queue_depth": "Queue Depth", "inflight_count": "Inflight Messages", "is_connected": "Is Connected",
    "reconnect_count": "Reconnect Count", "connection_status": "Connection Status", "timestamp": "Timestamp",
}
EVENT_NAMES = {
    "device_id": "Device ID", "device_type": "Device Type", "location": "Location", "event_type": "Event Type",
    "firmware_version": "Firmware Version", "event_count": "Event Count", "event_timestamp": "Timestamp",
}
MACHINE_NAMES = {
    "udi": "UDI", "product_id": "Product ID", "machine_type": "Type", "air_temp_k": "Air temperature [K]",
    "process_temp_k": "Process temperature [K]", "rotational_speed_rpm": "Rotational speed [rpm]",
    "torque_nm": "Torque [Nm]", "tool_wear_min": "Tool wear [min]", "machine_failure": "Machine failure",
    "failure_twf": "TWF", "failure_hdf": "HDF", "failure_pwf": "PWF", "failure_osf": "OSF", "failure_rnf": "RNF",
    "power_w": "Power [W]", "temp_diff_k": "Temp diff [K]", "wear_torque_product": "Wear-torque product",
    "speed_torque_product": "Speed-torque product", "wear_stage": "Wear stage",
}
SUMMARY_NAMES = {
    "device_id": "Device ID", "avg_cpu_pct": "Avg CPU %", "max_cpu_pct": "Max CPU %", "p95_cpu_pct": "P95 CPU %",
    "avg_ram_pct": "Avg RAM %", "avg_temp_c": "Avg Temp (°C)", "max_temp_c": "Max Temp (°C)",
    "avg_signal_dbm": "Avg Signal (dBm)", "anomaly_count": "Anomaly Count", "device_type": "Device Type",
    "location": "Location", "reconnect_count": "Reconnect Count", "health_score": "Health Score",
}

TELEMETRY_CSV = [
    ("timestamp", "timestamp_ntz"), ("device_id", "string"), ("device_type", "string"), ("location", "string"),
    ("cpu_pct", "double"), ("ram_pct", "double"), ("temperature_c", "double"), ("signal_dbm", "int"),
    ("uptime_s", "bigint"), ("is_anomaly", "string"), ("hour", "int"), ("date", "date"), ("weekday", "string"),
    ("signal_quality", "string"), ("temp_status", "string"), ("cpu_status", "string"),
]
STATUS_CSV = [
    ("device_id", "string"), ("device_type", "string"), ("location", "string"), ("uptime_s", "bigint"),
    ("uptime_hours", "double"), ("messages_published", "bigint"), ("error_count", "bigint"), ("queue_depth", "bigint"),
    ("reconnect_count", "bigint"), ("connection_status", "string"),
]
EVENT_CSV = [
    ("device_id", "string"), ("device_type", "string"), ("location", "string"), ("event_type", "string"),
    ("firmware_version", "string"), ("event_timestamp", "timestamp_ntz"),
]
MACHINE_CSV = [
    ("udi", "bigint"), ("product_id", "string"), ("machine_type", "string"), ("air_temp_k", "double"),
    ("process_temp_k", "double"), ("rotational_speed_rpm", "double"), ("torque_nm", "double"), ("tool_wear_min", "double"),
    ("machine_failure", "string"), ("failure_twf", "string"), ("failure_hdf", "string"), ("failure_pwf", "string"),
    ("failure_osf", "string"), ("failure_rnf", "string"), ("power_w", "double"), ("temp_diff_k", "double"),
    ("wear_torque_product", "double"), ("speed_torque_product", "double"), ("wear_stage", "string"),
]


def bi_rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Display names for the columns that are there; others stay as they are."""
    return df.withColumnsRenamed({k: v for k, v in names.items() if k in df.columns})


def from_display(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed({v: k for k, v in names.items() if v in df.columns})


def write_csv(df: DataFrame, path: str, names: dict[str, str] | None = None) -> str:
    """Header CSV, one file per task; nothing is gathered on the driver."""
    out = bi_rename(df, names) if names else df
    micros = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    writer = out.write.mode("overwrite").option("header", True)
    writer.option("timestampFormat", micros).option("timestampNTZFormat", micros).csv(path)
    return path


def _read(spark: SparkSession, path: str, columns: list[tuple[str, str]], names: dict[str, str]) -> DataFrame:
    """The wanted columns, found by their header names; others are not read. NaN is read as null."""
    text = from_display(spark.read.option("header", True).csv(path), names)
    absent = [names[c] for c, _ in columns if c not in text.columns]
    if absent:
        raise ValueError(f"{path} has no column {', '.join(absent)}")
    typed = text.select(*[F.col(c).cast(kind).alias(c) for c, kind in columns])
    return known_numbers(typed, [c for c, kind in columns if kind == "double"])


def load_telemetry_csv(spark: SparkSession, path: str) -> DataFrame:
    df = _read(spark, path, TELEMETRY_CSV, TELEMETRY_NAMES)
    return load_telemetry_flags(df).drop("hour", "date", "weekday")


def load_telemetry_flags(df: DataFrame) -> DataFrame:
    """Anomaly text in any letter case to a boolean."""
    return df.withColumn("is_anomaly", flag_text(F.col("is_anomaly")))


def load_status_csv(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, STATUS_CSV, STATUS_NAMES)


def load_snapshots_csv(spark: SparkSession, path: str) -> DataFrame:
    """Status rows with their time: an export may hold several snapshots of a device."""
    return _read(spark, path, [*STATUS_CSV, ("timestamp", "timestamp_ntz")], STATUS_NAMES)


def load_events_csv(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, EVENT_CSV, EVENT_NAMES)


def load_machines_csv(spark: SparkSession, path: str) -> DataFrame:
    df = _read(spark, path, MACHINE_CSV, MACHINE_NAMES)
    flags = ["machine_failure", *[f"failure_{m}" for m in ("twf", "hdf", "pwf", "osf", "rnf")]]
    return df.withColumns({
        "tool_wear_min": F.col("tool_wear_min").cast("bigint"), **{c: F.col(c).cast("boolean") for c in flags}})
