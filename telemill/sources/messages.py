"""Decoding of device messages: topic routing, JSON payloads, dead letters.

Every function is a narrow projection, so batch and stream jobs share it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import count_true, known

# Topic layout, payload fields and their defaults.
ROOT = "fleet"
KINDS = ["telemetry", "status", "events"]
TELEMETRY_REQUIRED = {
    "cpu_percent": "double", "ram_percent": "double", "temperature_c": "double",
    "signal_dbm": "bigint", "uptime_s": "bigint",
}
STATUS_COUNTERS = ["uptime_s", "publish_count", "error_count", "queue_depth", "inflight_count", "reconnect_count"]
PAYLOAD_FIELDS = [
    "device_type", "location", "timestamp", "cpu_percent", "ram_percent", "temperature_c", "signal_dbm", "uptime_s",
    "publish_count", "anomaly", "error_count", "queue_depth", "inflight_count", "is_connected", "reconnect_count",
    "event", "firmware_version",
]
UNKNOWN = "unknown"
CORRUPT = "_corrupt"

# All fields are read as text and converted one by one, so a bad value is told from a bad payload.
PAYLOAD_SCHEMA = ", ".join(f"{f} STRING" for f in [*PAYLOAD_FIELDS, CORRUPT])


def route_topic(messages: DataFrame) -> DataFrame:
    """Add device_id, kind and whether the topic is subscribed to and well formed.

    ``kind`` is null for topics of another shape and the third part otherwise. A message
    whose topic could not be read counts as received.
    """
    parts = F.split("topic", "/")
    fits = (F.size(parts) == 3) & (F.get(parts, F.lit(0)) == ROOT)
    return messages.withColumns({
        "subscribed": F.col("topic").isNull() | (F.col("topic") == ROOT) | F.col("topic").startswith(f"{ROOT}/"),
        "device_id": F.when(fits, F.get(parts, F.lit(1))),
        "kind": F.when(fits, F.get(parts, F.lit(2))),
    })


def parse(messages: DataFrame) -> DataFrame:
    """Route, then parse the payload once; ``payload_ok`` is false for broken JSON.

    The parsed struct passes through a generator of one row: filters on its
    fields then stay above it, and no field access repeats the parsing.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    text = F.when(F.col("kind").isNotNull(), F.col("payload").cast("string"))
    routed = route_topic(messages).withColumn("d", F.explode(F.array(F.from_json(text, PAYLOAD_SCHEMA, options))))
    return routed.withColumn("payload_ok", F.col("d").isNotNull() & F.col(f"d.{CORRUPT}").isNull())


def _number(name: str, kind: str) -> Column:
    text = F.col(f"d.{name}")
    if kind == "double":
        return known(text.try_cast("double"))
    # whole numbers may be written with a fraction, which is cut off
    return F.coalesce(text.try_cast("bigint"), text.try_cast("double").try_cast("bigint"))


def _counter(name: str) -> Column:
    return F.coalesce(_number(name, "bigint"), F.lit(0).cast("bigint"))


def _tag(name: str) -> Column:
    return F.coalesce(F.col(f"d.{name}"), F.lit(UNKNOWN))


def _event_time() -> Column:
    """The payload's own time, else arrival: a replay must give the same rows."""
    arrival = F.col("arrival_ts").cast("timestamp")
    return F.coalesce(F.col("d.timestamp").try_cast("timestamp"), arrival)


def _bad_counters(kind: str) -> Column:
    """A counter that is there but is no number."""
    names = ["publish_count"] if kind == "telemetry" else STATUS_COUNTERS
    bad = F.lit(False)
    for name in names:
        bad = bad | (F.col(f"d.{name}").isNotNull() & _number(name, "bigint").isNull())
    if kind == "status":
        flag = F.lower("d.is_connected")
        bad = bad | (flag.isNotNull() & ~flag.isin("true", "false") & _number("is_connected", "bigint").isNull())
    return bad


def _complete() -> Column:
    ok = F.lit(True)
    for name, kind in TELEMETRY_REQUIRED.items():
        ok = ok & _number(name, kind).isNotNull()
    return ok


def outcome() -> Column:
    """What becomes of a parsed message."""
    known = F.col("kind").isin(KINDS)
    return (
        F.when(F.col("topic").isNull(), "parse_error")
        .when(~F.col("subscribed"), "not_subscribed")
        .when(F.col("kind").isNull(), "ignored_topic")
        .when(~F.col("payload_ok"), "parse_error")
        .when(~known, "ignored_kind")
        .when((F.col("kind") == "telemetry") & (~_complete() | _bad_counters("telemetry")), "parse_error")
        .when((F.col("kind") == "status") & _bad_counters("status"), "parse_error")
        .otherwise("written")
    )


def classified(messages: DataFrame) -> DataFrame:
    return parse(messages).withColumn("outcome", outcome())


def telemetry_points(parsed: DataFrame) -> DataFrame:
    good = parsed.filter((F.col("outcome") == "written") & (F.col("kind") == "telemetry"))
    return good.select(
        "device_id", _tag("device_type").alias("device_type"), _tag("location").alias("location"),
        F.initcap(F.coalesce(F.col("d.anomaly"), F.lit("false"))).alias("anomaly"),
        *[_number(n, k).alias(n) for n, k in TELEMETRY_REQUIRED.items()],
        _counter("publish_count").alias("publish_count"), _event_time().alias("time"))


def status_points(parsed: DataFrame) -> DataFrame:
    connected = F.lower("d.is_connected")
    as_int = F.when(connected == "true", 1).when(connected == "false", 0).otherwise(_counter("is_connected"))
    good = parsed.filter((F.col("outcome") == "written") & (F.col("kind") == "status"))
    return good.select(
        "device_id", _tag("device_type").alias("device_type"), _tag("location").alias("location"),
        *[_counter(c).alias(c) for c in STATUS_COUNTERS],
        as_int.cast("bigint").alias("is_connected"), _event_time().alias("time"))


def event_points(parsed: DataFrame) -> DataFrame:
    good = parsed.filter((F.col("outcome") == "written") & (F.col("kind") == "events"))
    return good.select(
        "device_id", _tag("device_type").alias("device_type"), _tag("location").alias("location"),
        _tag("event").alias("event"), _tag("firmware_version").alias("firmware_version"),
        F.lit(1).cast("bigint").alias("event_count"), _event_time().alias("time"))


def dead_letters(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("outcome") == "parse_error").select("topic", "payload", "arrival_ts")


def ingest_quality(parsed: DataFrame) -> DataFrame:
    """Messages received by the subscription, written as points, and failed."""
    result = F.col("outcome")
    return parsed.agg(
        count_true("subscribed").alias("messages_received"),
        count_true(result == "written").alias("messages_written"),
        count_true(result == "parse_error").alias("parse_errors"),
        count_true(result.startswith("ignored")).alias("ignored"))


POINT_KEYS = {
    "telemetry": ["time", "device_id", "device_type", "location", "anomaly"],
    "status": ["time", "device_id", "device_type", "location"],
    "events": ["time", "device_id", "device_type", "location", "event"],
}


def dedup_messages(points: DataFrame, kind: str = "telemetry") -> DataFrame:
    """One point per measurement key: resends carry the same tags and time."""
    return points.dropDuplicates(POINT_KEYS[kind])
