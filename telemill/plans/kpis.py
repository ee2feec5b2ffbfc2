"""Fleet KPIs, league tables and chart datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.derive import HIGH_TEMP_LIMIT, POOR_SIGNAL_LIMIT
from ..functions.histogram import histogram
from ..functions.numeric import count_true, mean, mean_of, rnd, rnd_even, exact_sum
from ..operators.joins import sized
from ..operators.order_stats import grouped_quantiles

# Device types in display order, health weights, chart sizes.
DEVICE_TYPES = ["camera", "controller", "gateway", "sensor"]
LEAGUE_ROWS = 5
SIGNAL_BINS = 20
TREND_DEVICES = 5
WHISKER = 1.5


def _ratio(total: str, n: str):
    return F.col(total).cast("double") / F.nullif(F.col(n), F.lit(0)).cast("double")


def device_kpis(telemetry: DataFrame, snapshots: DataFrame) -> DataFrame:
    """One BI row per device with latest type and place, reconnect maximum and health score."""
    telemetry = telemetry.filter(F.col("device_id").isNotNull())
    # by type and place first: their latest values then come from a few rows, and the scan stays a hash aggregate
    places = telemetry.groupBy("device_id", "device_type", "location").agg(
        exact_sum("cpu_pct").alias("cpu"), F.count("cpu_pct").alias("cpu_n"), F.max("cpu_pct").alias("cpu_max"),
        exact_sum("ram_pct").alias("ram"), F.count("ram_pct").alias("ram_n"),
        exact_sum("temperature_c").alias("temp"), F.count("temperature_c").alias("temp_n"),
        F.max("temperature_c").alias("temp_max"),
        F.sum(F.col("signal_dbm").cast("bigint")).alias("signal"), F.count("signal_dbm").alias("signal_n"),
        count_true("is_anomaly").alias("anomalies"), F.max("timestamp").alias("last_ts"))
    totals = ["cpu", "cpu_n", "ram", "ram_n", "temp", "temp_n", "signal", "signal_n", "anomalies"]
    devices = places.groupBy("device_id").agg(
        *[F.sum(c).alias(c) for c in totals], F.max("cpu_max").alias("cpu_max"), F.max("temp_max").alias("temp_max"),
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("last_ts"))).alias(c) for c in ("device_type", "location")])
    p95 = grouped_quantiles(telemetry, ["device_id"], ["cpu_pct"], [0.95], rule="lower")
    reconnects = snapshots.groupBy("device_id").agg(F.max("reconnect_count").alias("reconnect_count"))
    kpis = devices.join(p95, "device_id", "left").join(reconnects, "device_id", "left").select(
        "device_id",
        rnd_even(mean_of("cpu", "cpu_n"), 1).alias("avg_cpu_pct"), rnd_even("cpu_max", 1).alias("max_cpu_pct"),
        rnd_even(F.col("cpu_pct_q")[0], 1).alias("p95_cpu_pct"), rnd_even(mean_of("ram", "ram_n"), 1).alias("avg_ram_pct"),
        rnd_even(mean_of("temp", "temp_n"), 1).alias("avg_temp_c"), rnd_even("temp_max", 1).alias("max_temp_c"),
        rnd_even(_ratio("signal", "signal_n"), 0).alias("avg_signal_dbm"), F.col("anomalies").alias("anomaly_count"),
        "device_type", "location", "reconnect_count")
    score = (F.lit(100.0) - F.col("max_cpu_pct") * F.lit(0.3) - (F.col("max_temp_c") - F.lit(40.0)) * F.lit(0.5)
             - F.col("anomaly_count") * F.lit(2.0))
    clipped = F.when(score.isNotNull(), F.least(F.greatest(score, F.lit(0.0)), F.lit(100.0)))
    return kpis.withColumn("health_score", rnd_even(clipped, 1))


def fleet_summary(telemetry: DataFrame, snapshots: DataFrame) -> DataFrame:
    devices = telemetry.groupBy("device_id").agg(
        exact_sum("cpu_pct").alias("cpu"), F.count("cpu_pct").alias("cpu_n"), F.max("cpu_pct").alias("cpu_max"),
        exact_sum("temperature_c").alias("temp"), F.count("temperature_c").alias("temp_n"),
        count_true(F.col("temperature_c") > HIGH_TEMP_LIMIT).alias("hot"),
        F.sum(F.col("signal_dbm").cast("bigint")).alias("signal"), F.count("signal_dbm").alias("signal_n"),
        count_true(F.col("signal_dbm") < POOR_SIGNAL_LIMIT).alias("weak"), count_true("is_anomaly").alias("anomalies"))
    sums = ["cpu", "cpu_n", "temp", "temp_n", "hot", "signal", "signal_n", "weak", "anomalies"]
    fleet = devices.agg(F.count("device_id").alias("devices"), F.max("cpu_max").alias("cpu_max"),
                        *[F.sum(c).alias(c) for c in sums])
    peaks = snapshots.groupBy("device_id").agg(F.max("reconnect_count").alias("r"), F.max("queue_depth").alias("q"))
    queue = peaks.agg(F.max("q").cast("bigint")).scalar()
    reconnects = peaks.filter(F.col("device_id").isNotNull()).agg(F.sum("r")).scalar()
    return fleet.select(
        "devices", rnd(mean_of("cpu", "cpu_n"), 1).alias("avg_cpu_pct"), rnd("cpu_max", 1).alias("max_cpu_pct"),
        rnd(mean_of("temp", "temp_n"), 1).alias("avg_temp_c"), F.col("hot").alias("high_temp_readings"),
        rnd(_ratio("signal", "signal_n"), 0).alias("avg_signal_dbm"), F.col("weak").alias("poor_signal_readings"),
        F.col("anomalies").alias("anomaly_events"), queue.alias("max_queue"), reconnects.alias("total_reconnects"))


def league(telemetry: DataFrame, column: str, out: str, top: int = LEAGUE_ROWS) -> DataFrame:
    """Devices with the highest mean of a column."""
    return (
        telemetry.filter(F.col("device_id").isNotNull()).groupBy("device_id").agg(mean(column).alias("m"))
        .orderBy(F.desc_nulls_last("m"), "device_id").limit(top)
        .select("device_id", rnd("m", 1).alias(out))
    )


def location_means(telemetry: DataFrame) -> DataFrame:
    return (
        telemetry.filter(F.col("location").isNotNull()).groupBy("location")
        .agg(rnd_even(mean("cpu_pct"), 1).alias("avg_cpu_pct"), rnd_even(mean("temperature_c"), 1).alias("avg_temp_c"),
             rnd_even(F.sum(F.col("signal_dbm").cast("bigint")).cast("double") / F.count("signal_dbm").cast("double"), 1)
             .alias("avg_signal_dbm"))
        .orderBy("location")
    )


def cpu_boxplot(telemetry: DataFrame) -> DataFrame:
    """Quartiles and whiskers (furthest values within 1.5 quartile ranges) per device type."""
    rows = telemetry.filter(F.col("device_type").isNotNull()).select("device_type", "cpu_pct")
    quartiles = grouped_quantiles(rows, ["device_type"], ["cpu_pct"], [0.25, 0.5, 0.75])
    boxes = sized(quartiles.select(
        "device_type", *[F.col("cpu_pct_q")[i].alias(name) for i, name in enumerate(("q1", "median", "q3"))]))
    spread = F.col("q3") - F.col("q1")
    inside = (F.col("cpu_pct") >= F.col("q1") - F.lit(WHISKER) * spread) & (
        F.col("cpu_pct") <= F.col("q3") + F.lit(WHISKER) * spread)
    return (
        rows.join(boxes, "device_type").groupBy("device_type", "q1", "median", "q3")
        .agg(F.count("cpu_pct").alias("readings"), F.min("cpu_pct").alias("min"), F.max("cpu_pct").alias("max"),
             F.min(F.when(inside, F.col("cpu_pct"))).alias("whisker_lo"),
             F.max(F.when(inside, F.col("cpu_pct"))).alias("whisker_hi"),
             count_true(~inside).alias("outliers"))
        .orderBy("device_type")
    )


def signal_histogram(telemetry: DataFrame) -> DataFrame:
    return histogram(telemetry, "signal_dbm", SIGNAL_BINS).select("bin", "bin_lo", "bin_hi", "n").orderBy("bin")


def filter_anomalous(telemetry: DataFrame) -> DataFrame:
    return telemetry.filter("is_anomaly")


def anomalies_by_location(telemetry: DataFrame) -> DataFrame:
    return (
        filter_anomalous(telemetry).filter(F.col("location").isNotNull()).groupBy("location")
        .agg(F.count(F.lit(1)).alias("anomaly_count")).orderBy("anomaly_count", "location")
    )


def queue_trend(snapshots: DataFrame) -> DataFrame:
    return snapshots.groupBy("timestamp").agg(F.max("queue_depth").cast("bigint").alias("max_queue_depth")).orderBy("timestamp")


def ram_pivot(telemetry: DataFrame, types: list[str] = DEVICE_TYPES) -> DataFrame:
    """Mean RAM by location and device type; empty where no such device reports."""
    means = telemetry.groupBy("location").pivot("device_type", types).agg(rnd_even(mean("ram_pct"), 1))
    return means.filter(F.col("location").isNotNull()).orderBy("location")


def temp_trend(telemetry: DataFrame, devices: int = TREND_DEVICES) -> DataFrame:
    """Temperature series of the first devices by id; their few ids filter the scan."""
    ids = telemetry.select("device_id").distinct().filter(F.col("device_id").isNotNull()).orderBy("device_id")
    first = [r["device_id"] for r in ids.limit(devices).collect()]
    return (
        telemetry.filter(F.col("device_id").isin(first)).select("device_id", "timestamp", "temperature_c")
        .orderBy("device_id", "timestamp")
    )
