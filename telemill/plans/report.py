"""Insight report: metrics, findings and actions.

Everything is derived from two device-level tables, so the telemetry is
scanned once whatever the number of metrics.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import count_true, mean_of, pct, rnd_even, exact_sum
from ..session import checkpointed

# Report thresholds and the fixed parts of the action table.
MANY_RECONNECTS = 8
FEW_RECONNECTS = 2
PEAK_ROWS = 5
CAMERA = "camera"
MONITOR = "⚠ Monitor"
NO_VALUE = "—"
PRIORITIES = ["P1 — Critical", "P2 — High", "P3 — Medium"]


def device_facts(telemetry: DataFrame) -> DataFrame:
    """Per device, type and location: everything the report needs, from one scan."""
    critical_cpu = F.col("cpu_status") == "Critical"
    warm = F.col("temp_status").isin("Warning", "Critical")
    facts = telemetry.groupBy("device_id", "device_type", "location").agg(
        F.count(F.lit(1)).alias("n"),
        exact_sum("cpu_pct").alias("cpu"), F.count("cpu_pct").alias("cpu_n"),
        exact_sum("temperature_c").alias("temp"), F.count("temperature_c").alias("temp_n"),
        F.max("temperature_c").alias("temp_max"), F.max(F.when(warm, F.col("temperature_c"))).alias("warm_max"),
        F.max(F.when(critical_cpu, F.col("cpu_pct"))).alias("critical_cpu_max"),
        count_true(critical_cpu).alias("critical_n"), count_true("is_anomaly").alias("anomalies"))
    return checkpointed(facts)


def _total(c: str) -> Column:
    return F.coalesce(F.sum(c), F.lit(0))


def report_kpis(facts: DataFrame, status: DataFrame) -> DataFrame:
    """One row of headline numbers. Online is the telemetry fleet less the offline status rows."""
    per_device = facts.groupBy("device_id").agg(
        F.max((F.col("device_type") == CAMERA).cast("int")).alias("camera"),
        *[F.sum(c).alias(c) for c in ("n", "anomalies", "critical_n")],
        *[F.sum(F.when(F.col("device_type") == CAMERA, F.col(c))).alias(f"cam_{c}")
          for c in ("cpu", "cpu_n", "temp", "temp_n", "critical_n")],
        F.max(F.when(F.col("device_type") == CAMERA, F.col("temp_max"))).alias("cam_temp_max"))
    fleet = per_device.agg(
        F.count("device_id").alias("fleet_size"), _total("n").alias("n"), _total("anomalies").alias("anomaly_count"),
        _total("critical_n").alias("critical"), _total("cam_critical_n").alias("cam_critical"),
        *[F.sum(f"cam_{c}").alias(f"cam_{c}") for c in ("cpu", "cpu_n", "temp", "temp_n")],
        F.max("cam_temp_max").alias("cam_temp_max"), _total("camera").alias("camera_count"))
    totals = status.agg(F.struct(
        count_true(F.col("connection_status") == "Offline").alias("offline"),
        _total("messages_published").alias("messages"), _total("queue_depth").alias("queued"),
        _total("reconnect_count").alias("reconnects"))).scalar()
    row = fleet.withColumn("s", totals)
    online = F.col("fleet_size") - F.col("s.offline")
    camera_share = F.when(F.col("critical") > 0, F.bround(pct("cam_critical", "critical"))).otherwise(0)
    return row.select(
        "fleet_size", F.col("s.offline").alias("offline_count"), online.alias("online_count"),
        rnd_even(online.cast("double") / F.nullif(F.col("fleet_size"), F.lit(0)).cast("double") * F.lit(100.0), 1).alias("uptime_pct"),
        "anomaly_count",
        rnd_even(F.col("anomaly_count").cast("double") / F.nullif(F.col("n"), F.lit(0)).cast("double") * F.lit(100.0), 2)
        .alias("anomaly_rate"),
        F.col("s.messages").alias("total_messages"), F.col("s.queued").alias("total_queued"),
        F.col("s.reconnects").alias("total_reconnects"),
        rnd_even(mean_of("cam_cpu", "cam_cpu_n"), 1).alias("cam_cpu"),
        rnd_even(mean_of("cam_temp", "cam_temp_n"), 1).alias("cam_temp"),
        rnd_even("cam_temp_max", 1).alias("cam_temp_max"), "camera_count",
        camera_share.cast("bigint").alias("cam_crit_cpu_pct"))


def worst_device(status: DataFrame) -> DataFrame:
    return status.orderBy(F.desc_nulls_last("reconnect_count"), "device_id").limit(1)


def _is_reliable() -> Column:
    return (F.col("reconnect_count") <= FEW_RECONNECTS) & (F.col("connection_status") == "Online")


def stable_device(status: DataFrame) -> DataFrame:
    """Fewest reconnects among reliable devices; among all if none is reliable."""
    unreliable = F.when(_is_reliable(), 0).otherwise(1)
    return status.orderBy(unreliable, F.asc_nulls_last("reconnect_count"), "device_id").limit(1)


def _offline_by_queue(status: DataFrame, top: int) -> DataFrame:
    offline = status.filter(F.col("connection_status") == "Offline")
    return offline.orderBy(F.desc_nulls_last("queue_depth"), "device_id").limit(top)


def most_queued(status: DataFrame) -> DataFrame:
    return _offline_by_queue(status, 1)


def hot_location(facts: DataFrame) -> DataFrame:
    places = facts.filter(F.col("location").isNotNull()).groupBy("location").agg(
        mean_of(F.sum("cpu"), F.sum("cpu_n")).alias("m"))
    return places.orderBy(F.desc_nulls_last("m"), "location").limit(1).select("location", rnd_even("m", 1).alias("avg_cpu_pct"))


def critical_cpu_devices(facts: DataFrame) -> DataFrame:
    return (
        facts.filter((F.col("critical_n") > 0) & F.col("device_id").isNotNull()).groupBy("device_id")
        .agg(F.max("critical_cpu_max").alias("max_cpu_pct")).orderBy(F.desc("max_cpu_pct"), "device_id")
    )


def temp_peaks(facts: DataFrame, top: int | None = PEAK_ROWS) -> DataFrame:
    """Hottest warm reading per device and location, all device types; the report shows the first five."""
    peaks = (
        facts.filter(F.col("warm_max").isNotNull() & F.col("device_id").isNotNull() & F.col("location").isNotNull())
        .groupBy("device_id", "location").agg(F.max("warm_max").alias("peak_temp_c"))
        .orderBy(F.desc("peak_temp_c"), "device_id", "location")
    )
    return peaks if top is None else peaks.limit(top)


def high_reconnect(status: DataFrame) -> DataFrame:
    return (
        status.filter(F.col("reconnect_count") > MANY_RECONNECTS)
        .select("device_id", "location", "reconnect_count").orderBy(F.desc("reconnect_count"), "device_id")
    )


def reliable_devices(status: DataFrame) -> DataFrame:
    return status.filter(_is_reliable())


def anomaly_leader(facts: DataFrame) -> DataFrame:
    """Device type with most anomalies; ('none', 0) if there are none."""
    types = facts.filter((F.col("anomalies") > 0) & F.col("device_type").isNotNull()).groupBy("device_type").agg(
        F.sum("anomalies").alias("anomaly_count"))
    best = types.orderBy(F.desc("anomaly_count"), "device_type").limit(1).agg(
        F.max("device_type").alias("t"), F.max("anomaly_count").alias("c"))
    return best.select(F.coalesce("t", F.lit("none")).alias("device_type"),
                       F.coalesce("c", F.lit(0).cast("bigint")).alias("anomaly_count"))


def _joined(values: Column, separator: str = " and ", none: str = "none") -> Column:
    return F.when(F.size(values) > 0, F.concat_ws(separator, values)).otherwise(none)


def near_capacity(status: DataFrame) -> DataFrame:
    """The two offline devices with the longest queues, as text and sum."""
    two = _offline_by_queue(status, 2).select(
        F.struct((-F.col("queue_depth")).alias("o"), "device_id", "location", "queue_depth").alias("d"))
    ordered = F.array_sort(F.collect_list("d"))
    one = two.agg(ordered.alias("l"), F.sum("d.queue_depth").alias("q"))
    text = F.transform("l", lambda d: F.format_string(
        "%s (%s, %d messages queued)", d["device_id"], d["location"], d["queue_depth"]))
    return one.select(
        _joined(F.transform("l", lambda d: d["device_id"])).alias("device_ids"), _joined(text).alias("devices_text"),
        F.coalesce("q", F.lit(0).cast("bigint")).alias("total_queue_depth"))


def hot_cameras(facts: DataFrame) -> DataFrame:
    """Two hottest camera places (warm readings first, all if none is warm) and two hottest cameras."""
    cameras = facts.filter(F.col("device_type") == CAMERA)
    def places(column: str) -> Column:
        best = cameras.filter(F.col(column).isNotNull() & F.col("location").isNotNull()).groupBy("location").agg(F.max(column).alias("t"))
        return _ordered_names(best.orderBy(F.desc("t"), "location").limit(2), "location")
    devices = cameras.filter(F.col("device_id").isNotNull()).groupBy("device_id").agg(F.max("temp_max").alias("t"))
    ids = _ordered_names(devices.orderBy(F.desc_nulls_last("t"), "device_id").limit(2), "device_id")
    one = cameras.agg(F.count(F.lit(1)).alias("n")).withColumns({
        "warm": places("warm_max"), "all": places("temp_max"), "ids": ids})
    names = F.when(F.size("warm") > 0, F.col("warm")).otherwise(F.col("all"))
    return one.select(_joined(names, none="the camera zones").alias("locations"),
                      _joined(F.col("ids"), none="the hottest cameras").alias("device_ids"))


def _ordered_names(top: DataFrame, name: str) -> Column:
    """Names of a few top rows, hottest first, as an array."""
    rows = F.array_sort(F.collect_list(F.struct((-F.col("t")).alias("o"), F.col(name).alias("v"))))
    return top.agg(F.transform(rows, lambda r: r["v"])).scalar()


def camera_mean_cpu(facts: DataFrame) -> DataFrame:
    """Peak table with the device's mean CPU if it is a camera, a dash otherwise."""
    means = facts.filter((F.col("device_type") == CAMERA) & F.col("device_id").isNotNull()).groupBy("device_id").agg(
        rnd_even(mean_of(F.sum("cpu"), F.sum("cpu_n")), 1).alias("m"))
    return (
        temp_peaks(facts).join(means, "device_id", "left")
        .select("device_id", "location",
                F.when(F.col("m").isNotNull(), F.format_string("%.1f%%", F.col("m"))).otherwise(NO_VALUE).alias("avg_cpu"),
                F.format_string("%.1f°C", rnd_even("peak_temp_c", 1)).alias("peak_temp"), F.lit(MONITOR).alias("status"))
        .orderBy(F.desc("peak_temp"), "device_id", "location")
    )


def report_facts(facts: DataFrame, status: DataFrame) -> DataFrame:
    """All report metrics in one row, kept for the texts built from it."""
    status = checkpointed(status)
    def one(df: DataFrame) -> Column:
        return df.select(F.struct(*df.columns)).scalar()
    reconnecting = status.filter(F.col("reconnect_count") > MANY_RECONNECTS)
    # two location names and a count are all the texts use: nothing grows with the fleet
    problem = reconnecting.agg(F.struct(
        F.count(F.lit(1)).alias("devices"), F.count_distinct("location").alias("places"))).scalar()
    places = reconnecting.select("location").distinct().orderBy("location").limit(2)
    row = report_kpis(facts, status).withColumns({
        "worst": one(worst_device(status)), "stable": one(stable_device(status)), "hot": one(hot_location(facts)),
        "leader": one(anomaly_leader(facts)), "near": one(near_capacity(status)), "cams": one(hot_cameras(facts)),
        "problem": problem, "zones": places.agg(F.concat_ws(", ", F.array_sort(F.collect_list("location")))).scalar(),
        "reliable": reliable_devices(status).agg(F.count(F.lit(1))).scalar(),
    })
    return checkpointed(row)


def _rows(row: DataFrame, names: list[str], rows: list[tuple]) -> DataFrame:
    cells = [F.struct(*[(x if isinstance(x, Column) else F.lit(x)).alias(n) for n, x in zip(names, r)]) for r in rows]
    return row.select(F.explode(F.array(*cells)).alias("r")).select("r.*")


def priority_actions(row: DataFrame) -> DataFrame:
    text = F.format_string
    actions = [
        (PRIORITIES[0], text("Bring %s (%s) back: %d reconnects, %d messages queued, now %s", "worst.device_id",
                             "worst.location", "worst.reconnect_count", "worst.queue_depth", "worst.connection_status"),
         "Network / IT", "Today"),
        (PRIORITIES[0], text("Check camera cooling at %s: peak %.1f°C", "cams.locations", "cam_temp_max"), "Hardware", "Today"),
        (PRIORITIES[1], text("Reconnect %s before their queues overflow: %d messages waiting", "near.device_ids",
                             "near.total_queue_depth"), "Network / IT", "< 2 hours"),
        (PRIORITIES[1], text("Audit access points at %s: %d devices above %d reconnects", "zones", "problem.devices",
                             F.lit(MANY_RECONNECTS)), "Network", "This week"),
        (PRIORITIES[2], text("Review video load: about %.1f%% CPU on %d cameras", "cam_cpu", "camera_count"),
         "Firmware", "This sprint"),
        (PRIORITIES[2], "Raise the queue limit of devices in problem zones", "DevOps", "This sprint"),
    ]
    numbered = [(i + 1, *a) for i, a in enumerate(actions)]
    return _rows(row, ["position", "priority", "action", "owner", "timeline"], numbered)


def findings(row: DataFrame) -> DataFrame:
    text = F.format_string
    share = F.bround(pct("offline_count", "fleet_size")).cast("bigint")
    sections = [
        ("Executive summary", text(
            "%d devices sent %d messages. Availability is %.1f%%, %d devices are unreachable, %d messages wait in offline "
            "queues and %d reconnects were seen. %d anomalies were detected (%.2f%% of readings), most of them by the "
            "%s class (%d of %d).",
            "fleet_size", "total_messages", "uptime_pct", "offline_count", "total_queued", "total_reconnects",
            "anomaly_count", "anomaly_rate", "leader.device_type", "leader.anomaly_count", "anomaly_count")),
        ("Finding 1 — cameras at thermal risk", text(
            "%d cameras run at %.1f%% CPU and %.1f°C on average, with a peak of %.1f°C, and cause %d%% of critical CPU "
            "readings. Hottest places: %s. Inspect within 7 days: %s.",
            "camera_count", "cam_cpu", "cam_temp", "cam_temp_max", "cam_crit_cpu_pct", "cams.locations", "cams.device_ids")),
        ("Finding 2 — unstable connections", text(
            "%d of %d devices (%d%%) are offline. %d devices at %d locations reconnected more than %d times. Worst is %s "
            "(%s, %s): %d reconnects, now %s.",
            "offline_count", "fleet_size", share, "problem.devices", "problem.places", F.lit(MANY_RECONNECTS),
            "worst.device_id", "worst.device_type", "worst.location", "worst.reconnect_count", "worst.connection_status")),
        ("Finding 3 — offline queues", text(
            "%d messages wait in offline queues. Nearest to capacity: %s.", "total_queued", "near.devices_text")),
        ("Finding 4 — most stable devices", text(
            "%s (%s, %s) reconnected %d times. %d devices stayed online with %d reconnects or fewer.",
            "stable.device_id", "stable.device_type", "stable.location", "stable.reconnect_count", "reliable",
            F.lit(FEW_RECONNECTS))),
    ]
    return _rows(row, ["position", "section", "finding"], [(i, *s) for i, s in enumerate(sections)])
