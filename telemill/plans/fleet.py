"""Fleet queries 1.1 to 1.10 over telemetry and the latest status per device."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.numeric import count_true, mean, mean_of, pct, rnd, exact_sum
from ..operators.ordered import ROWS_PER_SLICE, number_rows, rank_desc, slice_hot_groups, with_halo

# Reliability scoring and spike limits.
CPU_SPIKE = 25
TEMP_SPIKE = 5
HOT_CPU, HOT_CPU_COST = 85, 15
HOT_TEMP, HOT_TEMP_COST = 70, 10
RECONNECT_CAP, RECONNECT_COST = 10, 2.0
OFFLINE_COST = 20
ANOMALY_COST = 1.5
TIERS = [(85, "Tier 1 — Healthy"), (70, "Tier 2 — Monitor"), (50, "Tier 3 — At Risk")]
LAST_TIER = "Tier 4 — Critical"
MIN_GROUP_READINGS = 50
SPIKE_ROWS = 20
ROLLING_ROWS = 5


def device_metrics(telemetry: DataFrame) -> DataFrame:
    """One row per device, type and location; everything later joins these few rows."""
    return telemetry.groupBy("device_id", "device_type", "location").agg(
        F.count(F.lit(1)).alias("n"),
        exact_sum("cpu_pct").alias("cpu_total"), F.count("cpu_pct").alias("cpu_n"), F.max("cpu_pct").alias("cpu_max"),
        exact_sum("temperature_c").alias("temp_total"), F.count("temperature_c").alias("temp_n"),
        F.max("temperature_c").alias("temp_max"),
        F.sum(F.col("signal_dbm").cast("bigint")).alias("signal_sum"), F.count("signal_dbm").alias("signal_n"),
        count_true("is_anomaly").alias("anomalies"),
    )


def _with_status(metrics: DataFrame, status: DataFrame, *columns: str) -> DataFrame:
    """Left join of device rows with status rows, both already reduced to devices."""
    return metrics.join(status.select("device_id", *columns), "device_id", "left")


def fleet_health(telemetry: DataFrame, status: DataFrame) -> DataFrame:
    online = F.when(F.col("connection_status") == "Online", 1).when(F.col("connection_status") == "Offline", 0)
    devices = _with_status(device_metrics(telemetry), status.withColumn("online", online), "online")
    per_device = devices.groupBy("device_id").agg(
        F.max("online").alias("online"),
        *[F.sum(c).alias(c) for c in ("n", "cpu_total", "cpu_n", "temp_total", "temp_n", "anomalies")],
        F.max("temp_max").alias("temp_max"))
    fleet = per_device.agg(
        F.count("device_id").alias("total_devices"),
        count_true((F.col("online") == 1) & F.col("device_id").isNotNull()).alias("online_devices"),
        count_true((F.col("online") == 0) & F.col("device_id").isNotNull()).alias("offline_devices"),
        *[F.sum(c).alias(c) for c in ("n", "cpu_total", "cpu_n", "temp_total", "temp_n", "anomalies")],
        F.max("temp_max").alias("temp_max"))
    return fleet.select(
        "total_devices", "online_devices", "offline_devices",
        rnd(pct("online_devices", "total_devices"), 1).alias("fleet_uptime_pct"),
        rnd(mean_of("cpu_total", "cpu_n"), 1).alias("avg_cpu_pct"),
        rnd(mean_of("temp_total", "temp_n"), 1).alias("avg_temp_c"),
        rnd("temp_max", 1).alias("max_temp_c"),
        F.col("anomalies").alias("total_anomalies"),
        rnd(pct("anomalies", "n"), 2).alias("anomaly_rate_pct"))


def device_summary(telemetry: DataFrame, status: DataFrame) -> DataFrame:
    devices = _with_status(device_metrics(telemetry), status, "connection_status", "reconnect_count",
                           "queue_depth", "messages_published")
    return devices.select(
        "device_id", "device_type", "location", "connection_status",
        F.col("n").alias("reading_count"),
        rnd(mean_of("cpu_total", "cpu_n"), 1).alias("avg_cpu_pct"),
        rnd("cpu_max", 1).alias("max_cpu_pct"),
        rnd(mean_of("temp_total", "temp_n"), 1).alias("avg_temp_c"),
        rnd("temp_max", 1).alias("max_temp_c"),
        rnd(F.col("signal_sum").cast("double") / F.col("signal_n").cast("double"), 0).alias("avg_signal_dbm"),
        F.col("anomalies").alias("anomaly_count"),
        "reconnect_count", "queue_depth", "messages_published",
    ).orderBy(F.desc("anomaly_count"), F.desc("avg_cpu_pct"), "device_id")


def cpu_ranking(telemetry: DataFrame) -> DataFrame:
    means = telemetry.groupBy("device_id", "device_type", "location").agg(mean("cpu_pct").alias("cpu"))
    ranked = rank_desc(rank_desc(means, "cpu", "fleet_rank"), "cpu", "rank_in_location", ["location"])
    return ranked.select(
        "device_id", "device_type", "location", rnd("cpu", 1).alias("avg_cpu_pct"), "rank_in_location", "fleet_rank",
    ).orderBy("location", "rank_in_location", "device_id")


def hourly_patterns(telemetry: DataFrame) -> DataFrame:
    return (
        telemetry.groupBy(F.hour("timestamp").cast("bigint").alias("hour_of_day"))
        .agg(
            F.count(F.lit(1)).alias("reading_count"),
            rnd(mean("cpu_pct"), 1).alias("avg_cpu_pct"),
            rnd(mean("temperature_c"), 1).alias("avg_temp_c"),
            rnd(F.max("cpu_pct"), 1).alias("peak_cpu_pct"),
            count_true("is_anomaly").alias("anomaly_count"))
        .orderBy("hour_of_day")
    )


def anomaly_by_location(telemetry: DataFrame, min_readings: int = MIN_GROUP_READINGS) -> DataFrame:
    return (
        telemetry.groupBy("location", "device_type")
        .agg(F.count(F.lit(1)).alias("total_readings"), count_true("is_anomaly").alias("anomaly_count"))
        .filter(F.col("total_readings") > min_readings)
        .withColumn("anomaly_rate_pct", rnd(pct("anomaly_count", "total_readings"), 2))
        .orderBy(F.desc("anomaly_rate_pct"), "location", "device_type")
    )


def signal_pivot(telemetry: DataFrame) -> DataFrame:
    """Device counts per signal class; flags per device first, so no distinct counts."""
    classes = {"excellent": "Excellent", "good": "Good", "fair": "Fair", "poor": "Poor"}
    seen = telemetry.groupBy("location", "device_id").agg(
        F.sum(F.col("signal_dbm").cast("bigint")).alias("signal_sum"), F.count("signal_dbm").alias("signal_n"),
        *[F.max(F.when(F.col("signal_quality") == label, 1).otherwise(0)).alias(c) for c, label in classes.items()])
    return (
        seen.groupBy("location")
        .agg(
            F.count("device_id").alias("device_count"),
            *[count_true((F.col(c) == 1) & F.col("device_id").isNotNull()).alias(c) for c in classes],
            F.sum("signal_sum").alias("signal_sum"), F.sum("signal_n").alias("signal_n"))
        .select("location", "device_count", *classes,
                rnd(F.col("signal_sum").cast("double") / F.col("signal_n").cast("double"), 1).alias("avg_signal_dbm"))
        .orderBy(F.asc_nulls_last("avg_signal_dbm"), "location")
    )


def _per_device(telemetry: DataFrame, reach: int, rows: int) -> tuple[DataFrame, list[str], bool]:
    """Readings ready for frames over ``reach`` earlier rows of the same device.

    If a device holds more than ``rows`` readings, all rows are numbered and cut
    into equal blocks with a halo; otherwise one window per device will do.
    """
    cut, is_cut = slice_hot_groups(telemetry, "device_id", ["timestamp", "id"], rows)
    if not is_cut:
        return telemetry, ["device_id"], False
    numbered = number_rows(cut, ["timestamp", "id"], ["slice"], ["device_id"])
    return with_halo(numbered, "rn", reach, ["device_id"], rows), ["device_id", "block"], True


def running_counts(telemetry: DataFrame, rows: int = ROWS_PER_SLICE) -> DataFrame:
    readings = telemetry.select("id", "device_id", "device_type", "timestamp", "cpu_pct")
    readings, by, is_cut = _per_device(readings, ROLLING_ROWS - 1, rows)
    order = Window.partitionBy(*by).orderBy("timestamp", "id")
    recent = order.rowsBetween(-(ROLLING_ROWS - 1), 0)
    # Up to five exact unit values per frame: the sum does not depend on what left the frame.
    readings = readings.withColumn("rolling_avg_cpu_5", rnd(
        mean_of(exact_sum("cpu_pct").over(recent), F.count("cpu_pct").over(recent)), 1))
    if is_cut:
        numbered = readings.filter(~F.col("halo")).withColumns(
            {"reading_number": F.col("rn"), "cumulative_readings": F.col("rn")})
    else:
        numbered = readings.withColumns({
            "reading_number": F.row_number().over(order).cast("bigint"),
            "cumulative_readings": F.sum(F.lit(1)).over(order.rowsBetween(Window.unboundedPreceding, 0)).cast("bigint")})
    return numbered.select("device_id", "device_type", "timestamp", "cpu_pct", "reading_number",
                           "cumulative_readings", "rolling_avg_cpu_5").orderBy("device_id", "timestamp")


def spikes(telemetry: DataFrame, top: int = SPIKE_ROWS, rows: int = ROWS_PER_SLICE) -> DataFrame:
    readings = telemetry.select("id", "device_id", "device_type", "location", "timestamp", "cpu_pct", "temperature_c")
    readings, by, is_cut = _per_device(readings, 1, rows)
    order = Window.partitionBy(*by).orderBy("timestamp", "id")
    readings = readings.withColumns({
        "prev_cpu_pct": F.lag("cpu_pct").over(order), "prev_temp_c": F.lag("temperature_c").over(order)})
    if is_cut:
        readings = readings.filter(~F.col("halo"))
    cpu_jump = F.col("cpu_pct") - F.col("prev_cpu_pct")
    temp_jump = F.col("temperature_c") - F.col("prev_temp_c")
    found = readings.filter(F.col("prev_cpu_pct").isNotNull() & ((cpu_jump > CPU_SPIKE) | (temp_jump > TEMP_SPIKE)))
    kind = F.when(cpu_jump > CPU_SPIKE, "CPU spike").when(temp_jump > TEMP_SPIKE, "Temp spike").otherwise("Normal")
    return (
        found.orderBy(F.desc(F.abs(cpu_jump)), "device_id", "timestamp").limit(top)
        .select("device_id", "device_type", "location", "timestamp", "cpu_pct", "prev_cpu_pct",
                rnd(cpu_jump, 1).alias("cpu_delta"), "temperature_c", "prev_temp_c",
                rnd(temp_jump, 2).alias("temp_delta"), kind.alias("spike_type"))
    )


def score_devices(metrics: DataFrame) -> DataFrame:
    """Health score, tier and fleet rank from rounded device metrics and status."""
    offline = F.col("connection_status") == "Offline"
    score = (
        F.lit(100.0)
        - F.when(F.col("max_cpu") >= HOT_CPU, HOT_CPU_COST).otherwise(0)
        - F.when(F.col("avg_temp") >= HOT_TEMP, HOT_TEMP_COST).otherwise(0)
        # least() skips a null, so a device without status counts the full cap
        - F.least("reconnect_count", F.lit(RECONNECT_CAP)) * F.lit(RECONNECT_COST)
        - F.when(offline, OFFLINE_COST).otherwise(0)
        - F.col("anomaly_count") * F.lit(ANOMALY_COST)
    )
    tier = F.coalesce(*[F.when(F.col("health_score") >= limit, F.lit(name)) for limit, name in TIERS], F.lit(LAST_TIER))
    scored = metrics.withColumn("health_score", rnd(score, 1)).withColumn("reliability_tier", tier)
    return rank_desc(scored, "health_score", "health_rank")


def reliability(telemetry: DataFrame, status: DataFrame) -> DataFrame:
    devices = _with_status(device_metrics(telemetry), status, "connection_status", "reconnect_count", "queue_depth")
    metrics = devices.select(
        "device_id", "device_type", "location", "connection_status",
        rnd(mean_of("cpu_total", "cpu_n"), 1).alias("avg_cpu"), rnd("cpu_max", 1).alias("max_cpu"),
        rnd(mean_of("temp_total", "temp_n"), 1).alias("avg_temp"),
        F.col("anomalies").alias("anomaly_count"), "reconnect_count", "queue_depth")
    return score_devices(metrics).select(
        *metrics.columns, "health_score", "reliability_tier", "health_rank").orderBy("health_rank", "device_id")


def tier_counts(telemetry: DataFrame, status: DataFrame) -> DataFrame:
    return (
        reliability(telemetry, status).groupBy("reliability_tier")
        .agg(F.count(F.lit(1)).alias("device_count"))
        .orderBy(F.desc("device_count"), "reliability_tier")
    )


def above_average_reconnects(status: DataFrame) -> DataFrame:
    fleet_mean = status.agg(F.avg("reconnect_count")).scalar()
    return (
        status.withColumn("fleet_mean", fleet_mean)
        .filter(F.col("reconnect_count") > F.col("fleet_mean"))
        .select("device_id", "device_type", "location", "reconnect_count", "queue_depth", "connection_status",
                rnd(F.col("reconnect_count") - F.col("fleet_mean"), 1).alias("above_fleet_avg"))
        .orderBy(F.desc("reconnect_count"), "device_id")
    )
