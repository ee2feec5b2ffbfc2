"""Query name to a function (spark, sf_dir) -> DataFrame over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import derive
from ..functions.histogram import histogram
from ..functions.numeric import count_true, mean, rnd
from ..operators import anomaly, cleaning, table_detectors
from ..operators.ordered import range_of
from ..session import apply_conf, new_folder
from ..sources import bindings as B, csv_tables as C, messages as M, points as P
from ..sources.message_log import log_messages, write_log
from ..streaming import ingest as S
from ..streaming.counts import COLUMNS as COUNTS, read_counts
from . import eda, export, fleet, kpis, machine, report

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
TWO_METHODS = ("zscore", "iqr")


def query(name: str):
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_conf(spark)
            return fn(spark, sf_dir)
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return register


def _over(name: str, *tables, job):
    """Register a job over tables of the binding."""
    @query(name)
    def run(spark, sf_dir):
        return job(*[t(spark, sf_dir) for t in tables])
    return run


def _ntz(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


# Fleet queries

_over("q1_1_fleet_health", B.telemetry, B.status, job=fleet.fleet_health)
_over("q1_2_device_summary", B.telemetry, B.status, job=fleet.device_summary)
_over("q1_3_cpu_ranking", B.telemetry, job=fleet.cpu_ranking)
_over("q1_4_hourly", B.telemetry, job=fleet.hourly_patterns)
_over("q1_5_anomaly_by_location", B.telemetry, job=fleet.anomaly_by_location)
_over("q1_6_signal_pivot", B.telemetry, job=fleet.signal_pivot)
_over("q1_7_running", B.telemetry, job=fleet.running_counts)
_over("q1_8_spikes", B.telemetry, job=fleet.spikes)
_over("q1_9_reliability", B.telemetry, B.status, job=fleet.reliability)
_over("q1_10_above_avg_reconnect", B.status, job=fleet.above_average_reconnects)
_over("tier_counts", B.telemetry, B.status, job=fleet.tier_counts)

# Machine queries

_over("q2_1_failure_by_type", B.machines, job=machine.failure_by_type)
_over("q2_2_failure_modes", B.machines, job=machine.failure_modes)
_over("q2_3_wear_stage", B.machines, job=machine.wear_stage_risk)
_over("q2_4_envelope", B.machines, job=machine.envelope)
_over("q2_5_torque_decile", B.machines, job=machine.torque_deciles)
_over("q2_6_risk_ranking", B.machines, job=machine.risk_ranking)
_over("q2_7_rolling_failure", B.machines, job=machine.rolling_failure_rate)
_over("cumulative_high_wear", B.machines, job=machine.cumulative_high_wear)
_over("envelope_pivot", B.machines, job=machine.envelope_pivot)

# Messages and points


def _all_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.messages(spark, sf_dir).unionByName(B.status_messages(spark, sf_dir)).unionByName(B.event_messages(spark, sf_dir))


def _kind_counts(messages: DataFrame) -> DataFrame:
    routed = M.route_topic(messages)
    return routed.select("device_id", F.when(F.col("kind").isin(M.KINDS), F.col("kind")).alias("kind")).filter(
        F.col("kind").isNotNull()).groupBy("device_id", "kind").agg(F.count(F.lit(1)).alias("messages"))


_over("route_topic", _all_messages, job=_kind_counts)
_over("decode_telemetry", B.messages, job=lambda m: _ntz(M.telemetry_points(M.classified(m)), "time"))
_over("decode_status", B.status_messages, job=lambda m: _ntz(M.status_points(M.classified(m)), "time"))
_over("decode_events", B.event_messages, job=lambda m: _ntz(M.event_points(M.classified(m)), "time"))
_over("dead_letters", _all_messages, job=lambda m: M.dead_letters(M.classified(m)))
_over("ingest_quality", _all_messages, job=lambda m: M.ingest_quality(M.classified(m)))
_over("dedup_messages", B.messages,
      job=lambda m: _ntz(M.dedup_messages(M.telemetry_points(M.classified(m))), "time"))
_over("range_scan", B.telemetry_base, job=lambda t: P.range_scan(t, 6))
_over("unpivot_fields", B.telemetry_base, job=P.unpivot_fields)
_over("pivot_fields", B.telemetry_base, job=lambda t: P.pivot_fields(P.unpivot_fields(t)))
_over("latest_status", B.status, job=lambda s: s)
_over("surrogate_id", B.telemetry_base, job=lambda t: P.surrogate_id(
    t.select("timestamp", "device_id", "id"), ["timestamp", "device_id", "id"]))


@query("normalise_result")
def normalise_result(spark, sf_dir):
    """Result tables as a time-series store hands them out: one per field set, with bookkeeping columns."""
    tel = B.telemetry_base(spark, sf_dir).withColumn("_time", F.col("timestamp").cast("timestamp")).drop("timestamp")
    loads = tel.select(F.lit("_result").alias("result"), F.lit(0).alias("table"), F.col("_time"),
                       F.col("_time").alias("_start"), "device_id", "cpu_pct", "ram_pct")
    radio = tel.select(F.lit("_result").alias("result"), F.lit(1).alias("table"), F.col("_time"),
                       F.col("_time").alias("_stop"), "device_id", "signal_dbm")
    return P.normalise_result([loads, radio])


@query("table_counts")
def table_counts(spark, sf_dir):
    return P.table_counts({
        "fleet_telemetry": B.telemetry_base(spark, sf_dir), "fleet_status": B.status(spark, sf_dir),
        "fleet_events": B.fleet_events(spark, sf_dir), "machines": B.machines_base(spark, sf_dir)})


@query("load_telemetry_flags")
def load_telemetry_flags(spark, sf_dir):
    text = F.col("is_anomaly").cast("string")
    mixed = F.when(F.col("id") % 3 == 0, F.upper(text)).when(F.col("id") % 3 == 1, F.initcap(text)).otherwise(text)
    tel = B.telemetry_base(spark, sf_dir).select("id", "device_id", mixed.alias("is_anomaly"))
    return C.load_telemetry_flags(tel)


# CSV round trips


@query("load_telemetry_csv")
def load_telemetry_csv(spark, sf_dir):
    tel = derive.time_parts(B.telemetry(spark, sf_dir)).select(*[c for c, _ in C.TELEMETRY_CSV])
    return C.load_telemetry_csv(spark, C.write_csv(tel, new_folder(spark, "csv"), C.TELEMETRY_NAMES))


@query("load_status_csv")
def load_status_csv(spark, sf_dir):
    df = B.status(spark, sf_dir).select(*[c for c, _ in C.STATUS_CSV])
    return C.load_status_csv(spark, C.write_csv(df, new_folder(spark, "csv"), C.STATUS_NAMES))


@query("load_events_csv")
def load_events_csv(spark, sf_dir):
    df = B.fleet_events(spark, sf_dir).select(*[c for c, _ in C.EVENT_CSV])
    return C.load_events_csv(spark, C.write_csv(df, new_folder(spark, "csv"), C.EVENT_NAMES))


@query("load_machines_csv")
def load_machines_csv(spark, sf_dir):
    df = B.machines(spark, sf_dir).select(*[c for c, _ in C.MACHINE_CSV])
    return C.load_machines_csv(spark, C.write_csv(df, new_folder(spark, "csv"), C.MACHINE_NAMES))


@query("write_csv")
def write_csv(spark, sf_dir):
    """The per-device summary through the CSV sink and back, as text columns."""
    df = fleet.device_summary(B.telemetry(spark, sf_dir), B.status(spark, sf_dir))
    path = C.write_csv(df.select("device_id", "reading_count", "anomaly_count"), new_folder(spark, "csv"))
    return spark.read.schema("device_id STRING, reading_count BIGINT, anomaly_count BIGINT").option("header", True).csv(path)


_over("bi_rename", B.telemetry_base, job=export.export_telemetry)
_over("export_status", B.status_snapshots, job=lambda s: export.export_status(s.drop("user_id")))
_over("export_events", B.fleet_events, job=export.export_events)



def _export_inputs(spark, sf_dir):
    return B.telemetry_base(spark, sf_dir), B.status_snapshots(spark, sf_dir).drop("user_id"), B.fleet_events(spark, sf_dir)


@query("export_summary")
def export_summary(spark, sf_dir):
    """The summary table of the export: devices of the same range as its other tables."""
    return export.export_tables(*_export_inputs(spark, sf_dir))["summary"]


@query("export_roundtrip")
def export_roundtrip(spark, sf_dir):
    """The export written as files and loaded again: readings and snapshots per device."""
    paths = export.write_export(new_folder(spark, "export"), *_export_inputs(spark, sf_dir))
    readings = C.load_telemetry_csv(spark, paths["telemetry"]).groupBy("device_id").agg(
        F.count(F.lit(1)).alias("reading_count"), count_true("is_anomaly").alias("anomaly_count"),
        F.max("cpu_pct").alias("max_cpu_pct"), F.max("timestamp").alias("last_reading"))
    snapshots = C.load_snapshots_csv(spark, paths["status"]).groupBy("device_id").agg(F.count(F.lit(1)).alias("snapshots"))
    return readings.join(snapshots, "device_id", "left").fillna(0, ["snapshots"])


# Derived columns

_over("time_parts", B.telemetry_base, job=lambda t: derive.time_parts(t.select("id", "timestamp")))
_over("signal_quality", B.telemetry_base, job=lambda t: t.select(
    "id", "signal_dbm", derive.signal_quality(F.col("signal_dbm")).alias("signal_quality")))
_over("temp_status", B.telemetry_base, job=lambda t: t.select(
    "id", "temperature_c", derive.temp_status(F.col("temperature_c")).alias("temp_status")))
_over("cpu_status", B.telemetry_base, job=lambda t: t.select(
    "id", "cpu_pct", derive.cpu_status(F.col("cpu_pct")).alias("cpu_status")))
_over("uptime_hours", B.status_snapshots, job=lambda s: s.select(
    "device_id", "timestamp", derive.uptime_hours(F.col("uptime_s")).alias("uptime_hours")))
_over("connection_status", B.status_snapshots, job=lambda s: s.select(
    "device_id", "timestamp", derive.connection_status(F.col("is_connected")).alias("connection_status")))
_over("filter_anomalous", B.telemetry_base, job=kpis.filter_anomalous)
_over("simple_thresholds", B.telemetry_base, job=derive.simple_thresholds)

# Joins


@query("join_status_left")
def join_status_left(spark, sf_dir):
    per_device = B.telemetry_base(spark, sf_dir).groupBy("device_id").agg(F.count(F.lit(1)).alias("reading_count"))
    status = B.status(spark, sf_dir).select("device_id", "connection_status", "reconnect_count", "queue_depth")
    return per_device.join(status, "device_id", "left")


@query("summary_join_latest")
def summary_join_latest(spark, sf_dir):
    all_kpis = kpis.device_kpis(B.telemetry(spark, sf_dir), B.status_snapshots(spark, sf_dir))
    return all_kpis.select("device_id", "avg_cpu_pct", "device_type", "location")


@query("summary_join_reconnect")
def summary_join_reconnect(spark, sf_dir):
    all_kpis = kpis.device_kpis(B.telemetry(spark, sf_dir), B.status_snapshots(spark, sf_dir))
    return all_kpis.select("device_id", "max_cpu_pct", "reconnect_count")


@query("scalar_subquery")
def scalar_subquery(spark, sf_dir):
    """Devices whose mean CPU lies above the fleet's mean reading."""
    tel = B.telemetry_base(spark, sf_dir)
    means = tel.groupBy("device_id").agg(mean("cpu_pct").alias("m"))
    fleet_mean = tel.agg(mean("cpu_pct")).scalar()
    return means.withColumn("f", fleet_mean).filter("m > f").select(
        "device_id", rnd("m", 2).alias("avg_cpu_pct"), rnd(F.col("m") - F.col("f"), 2).alias("above_fleet_avg"))


# Anomaly detection


def _z_columns(t: DataFrame) -> DataFrame:
    return anomaly.zscore(t).select("id", "device_id", rnd("max_zscore", 9).alias("max_zscore"), "zscore_anomaly", "zscore_trigger")


def _iqr_columns(t: DataFrame) -> DataFrame:
    fences = [f"iqr_{side}_{f}" for f in anomaly.FEATURES for side in ("lo", "hi")]
    return anomaly.iqr(t).select("id", "device_id", *[rnd(c, 9).alias(c) for c in fences], "iqr_anomaly", "iqr_trigger")


def _two(t: DataFrame) -> DataFrame:
    return anomaly.detect(t, TWO_METHODS)


def _with_jump(t: DataFrame) -> DataFrame:
    table_detectors.register(t.sparkSession, "jump", table_detectors.Jump)
    return anomaly.detect(t, (*TWO_METHODS, "jump"))


def _validated(t: DataFrame) -> DataFrame:
    anomaly.validate_features(t)
    return t.agg(*[F.count(f).alias(f"{f}_values") for f in anomaly.FEATURES])


_over("validate_features", B.telemetry_base, job=_validated)
_over("zscore", B.telemetry_base, job=_z_columns)
_over("iqr", B.telemetry_base, job=_iqr_columns)
_over("align_methods", B.telemetry_base, job=lambda t: _two(t).select(
    "id", "zscore_anomaly", "zscore_trigger", "iqr_anomaly", "iqr_trigger"))
_over("consensus", B.telemetry_base, job=lambda t: _two(t).select("id", "method_count", "consensus_anomaly"))
_over("anomaly_summary", B.telemetry_base, job=lambda t: anomaly.summarise(_two(t), TWO_METHODS))
_over("method_rates", B.telemetry_base, job=lambda t: anomaly.method_rates(anomaly.summarise(_two(t), TWO_METHODS), TWO_METHODS))
_over("consensus_by_type", B.telemetry_base, job=lambda t: anomaly.consensus_by_type(anomaly.summarise(_two(t), TWO_METHODS)))
_over("method_agreement", B.telemetry_base,
      job=lambda t: anomaly.method_agreement(anomaly.summarise(_two(t), TWO_METHODS), TWO_METHODS))
_over("top_device_series", B.telemetry_base, job=lambda t: _rounded(
    anomaly.top_device_series(_two(t)), "iqr_lo_temperature_c", "iqr_hi_temperature_c"))
_over("zscore_histogram", B.telemetry_base, job=lambda t: _z_histogram(t))
_over("isolation_forest", B.telemetry_base, job=lambda t: anomaly.isolation_forest(t).select(
    "id", "device_id", "iforest_score", "iforest_anomaly"))
_over("consensus_three", B.telemetry_base, job=lambda t: anomaly.detect(t).select("id", "method_count", "consensus_anomaly"))
_over("consensus_jump", B.telemetry_base, job=lambda t: _with_jump(t).select("id", "jump_anomaly", "method_count", "consensus_anomaly"))
_over("anomaly_report", B.telemetry_base, job=lambda t: anomaly.report(anomaly.detect(t)))
_over("top_consensus", B.telemetry_base, job=lambda t: anomaly.top_consensus(anomaly.detect(t)))
_over("iforest_threshold", B.telemetry_base, job=lambda t: anomaly.iforest_threshold(anomaly.detect(t)))
_over("anomaly_summary_three", B.telemetry_base, job=lambda t: anomaly.summarise(anomaly.detect(t)))
_over("consensus_by_type_three", B.telemetry_base,
      job=lambda t: anomaly.consensus_by_type(anomaly.summarise(anomaly.detect(t))))
_over("method_agreement_three", B.telemetry_base,
      job=lambda t: anomaly.method_agreement(anomaly.summarise(anomaly.detect(t))))
_over("top_device_series_three", B.telemetry_base, job=lambda t: anomaly.top_device_series(anomaly.detect(t)))
_over("method_rates_three", B.telemetry_base, job=lambda t: anomaly.method_rates(anomaly.summarise(anomaly.detect(t))))


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: rnd(c, 9) for c in columns})


def _z_histogram(t: DataFrame) -> DataFrame:
    # nine digits keep a value from changing bins with the last bit of a mean
    scored = anomaly.zscore(t).select(rnd("max_zscore", 9).alias("max_zscore")).filter(F.col("max_zscore") < 8)
    return histogram(scored, "max_zscore", 40).select("bin", "n")


# Cleaning


def _collapsed(raw: DataFrame) -> DataFrame:
    return cleaning.collapse_copies(cleaning.coerce_wear(raw))


def _medians_filled(raw: DataFrame) -> DataFrame:
    filled = cleaning.fill_group_median(_collapsed(raw), medians=cleaning.group_medians(raw))
    return filled.groupBy("udi", "type", "torque_nm").agg(F.sum("copies").alias("copies"))


def _in_order(step):
    """A fill over udi slices whose extent is read from the raw rows."""
    return lambda raw: step(_collapsed(raw), extent=range_of(raw, "udi"))


def _padded(raw: DataFrame) -> DataFrame:
    padded = raw.withColumnsRenamed({"air_temp_k": " air_temp_k", "process_temp_k": "process_temp_k  "})
    return cleaning.strip_headers(padded).select("udi", "air_temp_k", "process_temp_k")


def _celsius_rows(raw: DataFrame) -> DataFrame:
    readings = cleaning.deduplicated(raw)
    return cleaning.celsius_to_kelvin(readings).select("udi", "air_temp_k", "process_temp_k")


def _clipped_rows(raw: DataFrame) -> DataFrame:
    clipped = cleaning.clip_iqr(cleaning.deduplicated(raw))
    return clipped.select("udi", rnd("rotational_speed_rpm", 6).alias("rotational_speed_rpm"), rnd("torque_nm", 6).alias("torque_nm"))


_over("profile", B.machines_raw, job=eda.profile)
_over("strip_headers", B.machines_raw, job=_padded)
_over("coerce_numeric", B.machines_raw, job=cleaning.wear_sentinels)
_over("null_audit", B.machines_raw, job=lambda r: cleaning.null_audit(cleaning.coerce_wear(r)))
_over("fill_forward", B.machines_raw, job=lambda r: _in_order(cleaning.fill_forward)(r).groupBy(
    "udi", "air_temp_k", "rotational_speed_rpm").agg(F.sum("copies").alias("copies")))
_over("fill_group_median", B.machines_raw, job=_medians_filled)
_over("interpolate", B.machines_raw, job=lambda r: _in_order(cleaning.interpolate)(r).groupBy(
    "udi", "tool_wear_min").agg(F.sum("copies").alias("copies")))
_over("dedup_exact", B.machines_raw, job=lambda r: cleaning.dedup_exact(cleaning.imputed_readings(r)))
_over("celsius_to_kelvin", B.machines_raw, job=_celsius_rows)
_over("celsius_report", B.machines_raw, job=lambda r: cleaning.celsius_report(cleaning.deduplicated(r)))
_over("clip_iqr", B.machines_raw, job=_clipped_rows)
_over("clip_report", B.machines_raw, job=lambda r: cleaning.clip_report(cleaning.deduplicated(r)))
_over("normalise_type", B.machines_raw, job=lambda r: cleaning.type_report(cleaning.deduplicated(r)))
_over("fix_labels", B.machines_raw, job=lambda r: cleaning.label_report(cleaning.deduplicated(r)))
_over("features", B.machines_base, job=lambda m: B.with_machine_features(m).select(
    "udi", "power_w", "temp_diff_k", "wear_torque_product", "speed_torque_product"))
_over("wear_stage", B.machines_base, job=lambda m: m.select(
    "udi", "tool_wear_min", derive.wear_stage(F.col("tool_wear_min")).alias("wear_stage")))
_over("clean_machines", B.machines_raw, job=cleaning.clean_machines)
_over("profile_clean", B.machines_raw, job=lambda r: eda.profile(cleaning.clean_machines(r)))
_over("describe_features", B.machines_raw, job=lambda r: eda.describe(cleaning.clean_machines(r)))
_over("key_findings", B.machines_raw, job=lambda r: eda.key_findings(cleaning.clean_machines(r)))
_over("class_histograms", B.machines_raw, job=lambda r: eda.class_histograms(cleaning.clean_machines(r)).select(
    "feature", "outcome", "bin", rnd("bin_lo", 6).alias("bin_lo"), rnd("bin_hi", 6).alias("bin_hi"), "n",
    rnd("density", 9).alias("density")))
_over("air_histogram", B.machines_raw, job=lambda r: eda.air_histogram(cleaning.deduplicated(r)).select(
    "bin", rnd("bin_lo", 6).alias("bin_lo"), rnd("bin_hi", 6).alias("bin_hi"), "n"))
_over("rate_by_type", B.machines_raw, job=lambda r: eda.rate_by(cleaning.clean_machines(r), "machine_type"))
_over("rate_by_stage", B.machines_raw, job=lambda r: eda.rate_by(cleaning.clean_machines(r), "wear_stage"))
_over("mode_totals", B.machines_raw, job=lambda r: eda.mode_totals(cleaning.clean_machines(r)))
_over("correlation_matrix", B.machines_raw, job=lambda r: eda.correlation_matrix(cleaning.clean_machines(r)))
_over("cleaning_log", B.machines_raw, job=eda.cleaning_log)
_over("power_vs_dt_points", B.machines_raw, job=lambda r: eda.power_vs_dt_points(cleaning.clean_machines(r)))

# KPIs and charts

_over("device_kpis", B.telemetry, B.status_snapshots, job=kpis.device_kpis)
_over("fleet_summary", B.telemetry, B.status_snapshots, job=kpis.fleet_summary)
_over("top_cpu", B.telemetry, job=lambda t: kpis.league(t, "cpu_pct", "avg_cpu_pct"))
_over("top_temp", B.telemetry, job=lambda t: kpis.league(t, "temperature_c", "avg_temp_c"))
_over("location_means", B.telemetry, job=kpis.location_means)
_over("cpu_boxplot", B.telemetry, job=lambda t: _rounded(kpis.cpu_boxplot(t), "q1", "median", "q3"))
_over("signal_histogram", B.telemetry, job=lambda t: _rounded(kpis.signal_histogram(t), "bin_lo", "bin_hi"))
_over("anomalies_by_location", B.telemetry, job=kpis.anomalies_by_location)
_over("queue_trend", B.status_snapshots, job=kpis.queue_trend)
_over("ram_pivot", B.telemetry, job=kpis.ram_pivot)
_over("temp_trend", B.telemetry, job=kpis.temp_trend)

# Insight report


def _from_facts(name: str, job):
    _over(name, B.telemetry, job=lambda t: job(report.device_facts(t)))


_over("report_kpis", B.telemetry, B.status, job=lambda t, s: report.report_kpis(report.device_facts(t), s))
_over("worst_device", B.status, job=report.worst_device)
_over("stable_device", B.status, job=report.stable_device)
_over("most_queued", B.status, job=report.most_queued)
_from_facts("hot_location", report.hot_location)
_from_facts("critical_cpu_devices", report.critical_cpu_devices)
_from_facts("temp_peaks", report.temp_peaks)
_over("high_reconnect", B.status, job=report.high_reconnect)
_over("reliable_devices", B.status, job=report.reliable_devices)
_from_facts("anomaly_leader", report.anomaly_leader)
_over("near_capacity", B.status, job=report.near_capacity)
_from_facts("hot_cameras", report.hot_cameras)
_from_facts("camera_mean_cpu", report.camera_mean_cpu)
_from_facts("lookup_camera_cpu", lambda f: report.camera_mean_cpu(f).select("device_id", "location", "avg_cpu"))
_over("priority_actions", B.telemetry, B.status,
      job=lambda t, s: report.priority_actions(report.report_facts(report.device_facts(t), s)))
_over("findings", B.telemetry, B.status, job=lambda t, s: report.findings(report.report_facts(report.device_facts(t), s)))

# Streams over the same tables


def _message_stream(spark: SparkSession, sf_dir: str, binding=B.messages_from) -> DataFrame:
    return binding(S.file_stream(spark, sf_dir, "events.parquet"))


@query("ingest_messages")
def ingest_messages(spark, sf_dir):
    """All point counts after streaming ingest of every kind of message, by sink."""
    folder = S.run_on_tables(spark, _message_stream(spark, sf_dir, B.all_messages_from), S.ingest, "ingest")
    brought = S.point_table(spark, folder).brought()
    return spark.createDataFrame(sorted(brought.items()), "sink string, points long")


@query("ingest_message_log")
def ingest_message_log(spark, sf_dir):
    """All point counts after streaming ingest from growing log files, by sink: a second run takes up what was appended since."""
    logs, folder = new_folder(spark, "logs"), new_folder(spark, "log_ingest")
    messages = _all_messages(spark, sf_dir)
    early = F.pmod(F.xxhash64("payload"), F.lit(2)) == 0
    for some in (messages.filter(early), messages.filter(~early)):
        write_log(some, logs)
        S.ingest(log_messages(spark, logs), folder)
    return spark.createDataFrame(sorted(S.point_table(spark, folder).brought().items()), "sink string, points long")


@query("stream_quality")
def stream_quality(spark, sf_dir):
    """Messages received, written and failed, as the listener of the ingest stored them batch by batch."""
    folder = S.run_on_tables(spark, _message_stream(spark, sf_dir, B.all_messages_from), S.ingest, "quality")
    return read_counts(spark, folder).agg(*[F.sum(c).alias(c) for c in COUNTS])


@query("store_range")
def store_range(spark, sf_dir):
    """Telemetry points of the newest six hours, from the dates of the store that reach into them."""
    folder = S.run_on_tables(spark, _message_stream(spark, sf_dir), S.ingest, "range")
    return _ntz(S.read_points(spark, folder, "telemetry", hours=6), "time")


@query("write_points")
def write_points(spark, sf_dir):
    """Telemetry points as read back from the store: one per key."""
    folder = S.run_on_tables(spark, _message_stream(spark, sf_dir), S.ingest, "points")
    return _ntz(S.read_points(spark, folder, "telemetry"), "time")


@query("stream_ingest")
def stream_ingest(spark, sf_dir):
    """Status points through the stream and the store."""
    folder = S.run_on_tables(spark, _message_stream(spark, sf_dir, B.status_messages_from), S.ingest, "ingest")
    return _ntz(S.read_points(spark, folder, "status"), "time")


@query("stream_dedup")
def stream_dedup(spark, sf_dir):
    folder = S.run_on_tables(spark, _message_stream(spark, sf_dir), S.stream_dedup, "dedup")
    return _ntz(S.read_dedup(spark, folder), "time")


@query("stream_derive")
def stream_derive(spark, sf_dir):
    folder = S.run_on_tables(spark, _message_stream(spark, sf_dir), S.stream_derive, "derive")
    return _ntz(S.results(spark, folder), "timestamp").select(
        "device_id", "timestamp", "hour", "weekday", "is_anomaly", "signal_quality", "temp_status", "cpu_status")


@query("stream_latest_status")
def stream_latest_status(spark, sf_dir):
    folder = S.run_on_tables(
        spark, _message_stream(spark, sf_dir, B.status_messages_from), S.stream_latest_status, "latest")
    return S.read_latest_status(spark, folder).select(
        "device_id", "device_type", "location", "queue_depth", "reconnect_count", "uptime_hours", "connection_status")


@query("stream_hourly")
def stream_hourly(spark, sf_dir):
    folder = S.run_on_tables(spark, _message_stream(spark, sf_dir), S.stream_hourly, "hourly")
    return _ntz(S.read_hourly(spark, folder), "hour_start")
