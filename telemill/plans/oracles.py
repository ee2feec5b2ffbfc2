"""The same questions as plain SQL over the same tables, for the checker."""

from __future__ import annotations

import re

from ..sources import bindings as B
from ..sources.csv_tables import SUMMARY_NAMES

_COPIES = "(SELECT x.* FROM {t} x JOIN (SELECT 0 AS c UNION ALL SELECT 1 AS c) d ON d.c = 0 OR {again}) y"

_QUALITY = """CASE WHEN {x} >= -60 THEN 'Excellent' WHEN {x} >= -70 THEN 'Good' WHEN {x} >= -80 THEN 'Fair' ELSE 'Poor' END"""
_TEMP = "CASE WHEN {x} >= 80 THEN 'Critical' WHEN {x} >= 70 THEN 'Warning' ELSE 'Normal' END"
_CPU = "CASE WHEN {x} >= 85 THEN 'Critical' WHEN {x} >= 70 THEN 'High' ELSE 'Normal' END"
_STAGE = """CASE WHEN tool_wear_min BETWEEN 0 AND 80 THEN 'early' WHEN tool_wear_min > 80 AND tool_wear_min <= 170 THEN 'mid'
 WHEN tool_wear_min > 170 AND tool_wear_min <= 253 THEN 'late' END"""


def avg(x: str) -> str:
    """Mean with compensated summation, NaN left out."""
    return f"favg({x}) FILTER (WHERE NOT isnan(CAST({x} AS DOUBLE)))"


def iavg(x: str) -> str:
    return f"(CAST(SUM({x}) AS DOUBLE) / CAST(COUNT({x}) AS DOUBLE))"


def pct(part: str, whole: str = "COUNT(*)") -> str:
    return f"(CAST({part} AS DOUBLE) * CAST(100 AS DOUBLE) / CAST({whole} AS DOUBLE))"


def quantile(x: str, p: float, rule: str = "nearer") -> str:
    """Linear quantile spelled out as the data-frame libraries compute it.

    ``nearer`` starts from the closer of the two readings (whole columns),
    ``lower`` from the smaller one (grouped quantiles).
    """
    items = f"list_sort(list(CAST({x} AS DOUBLE)) FILTER (WHERE {x} IS NOT NULL))"
    place = f"((COUNT({x}) - 1) * CAST({p} AS DOUBLE))"
    lo, hi = (f"{items}[CAST({f}{place} AS BIGINT) + 1]" for f in ("floor", "ceil"))
    part = f"({place} - floor({place}))"
    low = f"{lo} + ({hi} - {lo}) * {part}"
    return f"({low})" if rule == "lower" else f"(CASE WHEN {part} >= 0.5 THEN {hi} - ({hi} - {lo}) * (1 - {part}) ELSE {low} END)"


def cnt(condition: str) -> str:
    return f"CAST(COUNT(*) FILTER (WHERE {condition}) AS BIGINT)"


FEATURES = f"""round_even(rotational_speed_rpm * torque_nm / CAST(9550 AS DOUBLE), 2) AS power_w,
 round_even(process_temp_k - air_temp_k, 2) AS temp_diff_k, round_even(tool_wear_min * torque_nm, 1) AS wear_torque_product,
 round_even(rotational_speed_rpm * torque_nm, 0) AS speed_torque_product, {_STAGE} AS wear_stage"""

VIEWS: dict[str, tuple[list[str], str]] = {
    "tel": ([], f"""SELECT *, {_QUALITY.format(x='signal_dbm')} AS signal_quality,
      {_TEMP.format(x='temperature_c')} AS temp_status, {_CPU.format(x='cpu_pct')} AS cpu_status
      FROM ({B.TELEMETRY_SQL.format(events='events')}) t"""),
    "snap": ([], B.SNAPSHOT_SQL.format(events="events")),
    "sta": (["snap"], """SELECT device_id, device_type, location, uptime_s,
      round_even(uptime_s / CAST(3600 AS DOUBLE), 2) AS uptime_hours, publish_count AS messages_published, error_count,
      queue_depth, reconnect_count, CASE WHEN is_connected = 1 THEN 'Online' ELSE 'Offline' END AS connection_status
      FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY device_id ORDER BY timestamp DESC) AS nth FROM snap) s WHERE nth = 1"""),
    "fev": ([], B.FLEET_EVENT_SQL.format(events="events")),
    "base": ([], B.MACHINE_SQL.format(orders="orders")),
    "mach": (["base"], f"SELECT *, {FEATURES} FROM base"),
    "raw": (["base"], B.RAW_MACHINE_SQL.format(copies=_COPIES.format(t="base", again="x.udi % 333 = 0"))),
    "msg": (["tel"], B.MESSAGE_SQL.format(copies=_COPIES.format(t="tel", again="x.id % 101 = 0"))),
    "smsg": (["snap"], B.STATUS_MESSAGE_SQL.format(snapshots="snap")),
    "emsg": (["fev"], B.EVENT_MESSAGE_SQL.format(fleet_events="fev")),
    "allmsg": (["msg", "smsg", "emsg"], "SELECT * FROM msg UNION ALL SELECT * FROM smsg UNION ALL SELECT * FROM emsg"),
    "routed": (["allmsg"], """SELECT *, CASE WHEN len(p) = 3 AND p[1] = 'fleet' THEN p[2] END AS device_id,
      CASE WHEN len(p) = 3 AND p[1] = 'fleet' THEN p[3] END AS kind, topic LIKE 'fleet/%' AS subscribed,
      json_valid(payload) AS ok FROM (SELECT *, string_split(topic, '/') AS p FROM allmsg) a"""),
    "parsed": (["routed"], """SELECT *, CASE WHEN ok THEN json(payload) END AS j FROM routed"""),
    "outcome": (["parsed"], """SELECT *, CASE WHEN NOT subscribed THEN 'not_subscribed' WHEN kind IS NULL THEN 'ignored_topic'
      WHEN NOT ok THEN 'parse_error' WHEN kind NOT IN ('telemetry', 'status', 'events') THEN 'ignored_kind'
      WHEN kind = 'telemetry' AND (j->>'$.cpu_percent' IS NULL OR j->>'$.ram_percent' IS NULL
        OR j->>'$.temperature_c' IS NULL OR j->>'$.signal_dbm' IS NULL OR j->>'$.uptime_s' IS NULL) THEN 'parse_error'
      WHEN kind = 'status' AND j->>'$.publish_count' IS NOT NULL AND TRY_CAST(j->>'$.publish_count' AS BIGINT) IS NULL
        THEN 'parse_error'
      ELSE 'written' END AS outcome FROM parsed"""),
    "tpoints": (["outcome"], """SELECT device_id, COALESCE(j->>'$.device_type', 'unknown') AS device_type,
      COALESCE(j->>'$.location', 'unknown') AS location,
      CASE WHEN j->>'$.anomaly' = 'true' THEN 'True' ELSE 'False' END AS anomaly,
      CAST(j->>'$.cpu_percent' AS DOUBLE) AS cpu_percent, CAST(j->>'$.ram_percent' AS DOUBLE) AS ram_percent,
      CAST(j->>'$.temperature_c' AS DOUBLE) AS temperature_c, CAST(j->>'$.signal_dbm' AS BIGINT) AS signal_dbm,
      CAST(j->>'$.uptime_s' AS BIGINT) AS uptime_s, COALESCE(CAST(j->>'$.publish_count' AS BIGINT), 0) AS publish_count,
      arrival_ts AS time FROM outcome WHERE outcome = 'written' AND kind = 'telemetry'"""),
    "spoints": (["outcome"], """SELECT device_id, COALESCE(j->>'$.device_type', 'unknown') AS device_type,
      COALESCE(j->>'$.location', 'unknown') AS location, COALESCE(CAST(j->>'$.uptime_s' AS BIGINT), 0) AS uptime_s,
      COALESCE(CAST(j->>'$.publish_count' AS BIGINT), 0) AS publish_count,
      COALESCE(CAST(j->>'$.error_count' AS BIGINT), 0) AS error_count,
      COALESCE(CAST(j->>'$.queue_depth' AS BIGINT), 0) AS queue_depth,
      COALESCE(CAST(j->>'$.inflight_count' AS BIGINT), 0) AS inflight_count,
      COALESCE(CAST(j->>'$.reconnect_count' AS BIGINT), 0) AS reconnect_count,
      CAST(CASE WHEN j->>'$.is_connected' = 'true' THEN 1 ELSE 0 END AS BIGINT) AS is_connected,
      arrival_ts AS time FROM outcome WHERE outcome = 'written' AND kind = 'status'"""),
    "epoints": (["outcome"], """SELECT device_id, COALESCE(j->>'$.device_type', 'unknown') AS device_type,
      COALESCE(j->>'$.location', 'unknown') AS location, COALESCE(j->>'$.event', 'unknown') AS event,
      COALESCE(j->>'$.firmware_version', 'unknown') AS firmware_version, CAST(1 AS BIGINT) AS event_count,
      arrival_ts AS time FROM outcome WHERE outcome = 'written' AND kind = 'events'"""),
    # per-device detectors
    "dstats": (["tel"], "SELECT device_id" + "".join(
        f", AVG({f}) AS {f}_m, STDDEV_POP({f}) AS {f}_s, COUNT({f}) AS {f}_n, "
        f"{quantile(f, 0.25)} AS {f}_q1, {quantile(f, 0.75)} AS {f}_q3"
        for f in ("cpu_pct", "ram_pct", "temperature_c", "signal_dbm")) + " FROM tel GROUP BY device_id"),
    "zrows": (["tel", "dstats"], "SELECT t.*" + "".join(
        f", CASE WHEN {f}_n < 10 THEN CAST(0 AS DOUBLE) ELSE ABS({f} - {f}_m) / NULLIF({f}_s, 0) END AS z_{f}"
        f", CASE WHEN {f}_n >= 10 THEN {f}_q1 - CAST(1.5 AS DOUBLE) * ({f}_q3 - {f}_q1) END AS iqr_lo_{f}"
        f", CASE WHEN {f}_n >= 10 THEN {f}_q3 + CAST(1.5 AS DOUBLE) * ({f}_q3 - {f}_q1) END AS iqr_hi_{f}"
        for f in ("cpu_pct", "ram_pct", "temperature_c", "signal_dbm")) + " FROM tel t JOIN dstats USING (device_id)"),
    "flags": (["zrows"], "SELECT *, COALESCE(max_zscore > 3, FALSE) AS zscore_anomaly, "
        + " OR ".join(f"COALESCE({f} < iqr_lo_{f} OR {f} > iqr_hi_{f}, FALSE)"
                      for f in ("cpu_pct", "ram_pct", "temperature_c", "signal_dbm")) + """ AS iqr_anomaly,
      CASE WHEN cpu_pct < iqr_lo_cpu_pct OR cpu_pct > iqr_hi_cpu_pct THEN 'CPU %'
        WHEN ram_pct < iqr_lo_ram_pct OR ram_pct > iqr_hi_ram_pct THEN 'RAM %'
        WHEN temperature_c < iqr_lo_temperature_c OR temperature_c > iqr_hi_temperature_c THEN 'Temperature (°C)'
        WHEN signal_dbm < iqr_lo_signal_dbm OR signal_dbm > iqr_hi_signal_dbm THEN 'Signal (dBm)' ELSE '' END AS iqr_trigger,
      CASE WHEN NOT COALESCE(max_zscore > 3, FALSE) THEN '' WHEN z_cpu_pct = max_zscore THEN 'CPU %'
        WHEN z_ram_pct = max_zscore THEN 'RAM %' WHEN z_temperature_c = max_zscore THEN 'Temperature (°C)'
        ELSE 'Signal (dBm)' END AS zscore_trigger
      FROM (SELECT *, GREATEST(z_cpu_pct, z_ram_pct, z_temperature_c, z_signal_dbm) AS max_zscore FROM zrows) z"""),
    "cons": (["flags"], """SELECT *, CAST(zscore_anomaly AS BIGINT) + CAST(iqr_anomaly AS BIGINT) AS method_count,
      zscore_anomaly AND iqr_anomaly AS consensus_anomaly FROM flags"""),
    "asum": (["cons"], f"""SELECT device_id, device_type, location, COUNT(cpu_pct) AS total_readings,
      {cnt('zscore_anomaly')} AS zscore_anomalies, {cnt('iqr_anomaly')} AS iqr_anomalies,
      {cnt('consensus_anomaly')} AS consensus_anomalies, round_even({avg('cpu_pct')}, 1) AS avg_cpu,
      round_even(MAX(cpu_pct), 1) AS max_cpu, round_even({avg('temperature_c')}, 1) AS avg_temp,
      round_even(MAX(temperature_c), 1) AS max_temp FROM cons GROUP BY device_id, device_type, location"""),
    # cleaning
    "num": (["raw"], "SELECT *, TRY_CAST(trim(tool_wear_raw) AS DOUBLE) AS w, ROW_NUMBER() OVER (ORDER BY udi) AS pos FROM raw"),
    "med": (["num"], "SELECT type, quantile_cont(torque_nm, 0.5) AS m FROM num WHERE type IS NOT NULL GROUP BY type"),
    "near": (["num"], """SELECT *,
      COALESCE(last_value(air_temp_k IGNORE NULLS) OVER up, first_value(air_temp_k IGNORE NULLS) OVER down) AS air_f,
      COALESCE(last_value(rotational_speed_rpm IGNORE NULLS) OVER up, first_value(rotational_speed_rpm IGNORE NULLS) OVER down) AS rpm_f,
      last_value(w IGNORE NULLS) OVER up AS pw, MAX(CASE WHEN w IS NOT NULL THEN pos END) OVER up AS pp,
      first_value(w IGNORE NULLS) OVER down AS nw, MIN(CASE WHEN w IS NOT NULL THEN pos END) OVER down AS np
      FROM num WINDOW up AS (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
        down AS (ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"""),
    "filled": (["near", "med"], """SELECT udi, product_id, n.type, air_f AS air_temp_k, process_temp_k,
      rpm_f AS rotational_speed_rpm, COALESCE(torque_nm, m) AS torque_nm,
      CAST(round_even(CASE WHEN w IS NOT NULL THEN w WHEN nw IS NULL THEN pw
        ELSE pw + (nw - pw) / CAST(np - pp AS DOUBLE) * CAST(pos - pp AS DOUBLE) END, 0) AS BIGINT) AS tool_wear_min,
      machine_failure, twf, hdf, pwf, osf, rnf FROM near n LEFT JOIN med ON n.type = med.type"""),
    "uniq": (["filled"], "SELECT DISTINCT * FROM filled"),
    "kelvin": (["uniq"], """SELECT * REPLACE (CASE WHEN air_temp_k < 100 THEN air_temp_k + CAST(273.15 AS DOUBLE)
      ELSE air_temp_k END AS air_temp_k) FROM uniq"""),
    "fence": (["uniq"], f"""SELECT GREATEST(r1 - 3 * (r3 - r1), 0) AS rlo, r3 + 3 * (r3 - r1) AS rhi,
      GREATEST(t1 - 3 * (t3 - t1), 0) AS tlo, t3 + 3 * (t3 - t1) AS thi FROM (
      SELECT {quantile('rotational_speed_rpm', 0.25)} AS r1, {quantile('rotational_speed_rpm', 0.75)} AS r3,
        {quantile('torque_nm', 0.25)} AS t1, {quantile('torque_nm', 0.75)} AS t3 FROM uniq) q"""),
    "clipped": (["kelvin", "fence"], """SELECT k.* REPLACE (
      LEAST(GREATEST(CAST(rotational_speed_rpm AS DOUBLE), rlo), rhi) AS rotational_speed_rpm,
      LEAST(GREATEST(torque_nm, tlo), thi) AS torque_nm) FROM kelvin k, fence"""),
    "clean": (["clipped"], f"""SELECT *, {FEATURES} FROM (SELECT udi, product_id, CASE
        WHEN type IN ('L', 'l', 'low', 'Low', 'LOW') THEN 'L' WHEN type IN ('M', 'm', 'med', 'MED', 'Med', 'medium') THEN 'M'
        WHEN type IN ('H', 'h', 'high', 'HIGH', 'High') THEN 'H' END AS machine_type,
      air_temp_k, process_temp_k, rotational_speed_rpm, torque_nm, tool_wear_min, machine_failure = 1 AS machine_failure,
      machine_failure = 1 AND twf = 1 AS failure_twf, machine_failure = 1 AND hdf = 1 AS failure_hdf,
      machine_failure = 1 AND pwf = 1 AS failure_pwf, machine_failure = 1 AND osf = 1 AS failure_osf,
      machine_failure = 1 AND rnf = 1 AS failure_rnf FROM clipped) c"""),
}


def _order(names: list[str], seen: list[str]) -> list[str]:
    for name in names:
        _order(VIEWS[name][0], seen)
        if name not in seen:
            seen.append(name)
    return seen


def over(views: str, sql: str) -> str:
    """A statement with the views it needs in front."""
    needed = _order(views.split(), [])
    return "WITH " + ",\n".join(f"{v} AS ({VIEWS[v][1]})" for v in needed) + "\n" + sql


def _hist(rel: str, key: str, bins: int) -> str:
    """Bins between the extremes of ``v`` per key in relation ``rel``; ``b`` holds all bins."""
    on = f"USING ({key})" if key else "ON TRUE"
    k = f"{key}, " if key else ""
    group = f"GROUP BY {key}" if key else ""
    return f"""span AS (SELECT {k}MIN(v) - CASE WHEN MIN(v) = MAX(v) THEN 0.5 ELSE 0 END AS lo,
        MAX(v) + CASE WHEN MIN(v) = MAX(v) THEN 0.5 ELSE 0 END AS hi, COUNT(*) AS total FROM {rel} {group}),
      hits AS (SELECT {k}LEAST(CAST(floor((v - lo) * CAST({bins} AS DOUBLE) / (hi - lo)) AS BIGINT), {bins - 1}) AS bin, COUNT(*) AS n
        FROM {rel} JOIN span {on} GROUP BY ALL),
      edges AS (SELECT {k}CAST(i AS BIGINT) AS bin, lo, hi, total, (hi - lo) / CAST({bins} AS DOUBLE) AS width FROM span, range({bins}) r(i)),
      histo AS (SELECT {k}bin, lo + bin * width AS bin_lo, lo + (bin + 1) * width AS bin_hi, COALESCE(n, 0) AS n,
        COALESCE(n, 0) / (CAST(total AS DOUBLE) * width) AS density FROM edges LEFT JOIN hits USING ({k}bin))"""


def over_hist(views: str, rel: str, key: str, bins: int, sql: str) -> str:
    needed = _order(views.split(), [])
    ctes = [f"{v} AS ({VIEWS[v][1]})" for v in needed]
    return "WITH " + ",\n".join([*ctes, f"v AS ({rel})", _hist("v", key, bins)]) + "\n" + sql


_JOINED = "tel t LEFT JOIN sta s ON t.device_id = s.device_id"

ORACLES: dict[str, str] = {}


def _profile(view: str, columns: dict[str, str]) -> str:
    parts = [f"""SELECT '{c}' AS column_name, '{t}' AS dtype, {cnt(f'{c} IS NULL')} AS nulls,
      ROUND({pct(f'COUNT(*) FILTER (WHERE {c} IS NULL)')}, 2) AS null_pct, COUNT(DISTINCT {c}) AS unique_values,
      MAX(CASE WHEN udi = (SELECT MIN(udi) FROM {view}) THEN CAST({c} AS VARCHAR) END) AS sample FROM {view}"""
             for c, t in columns.items()]
    return "\nUNION ALL ".join(parts)


RAW_TYPES = {
    "udi": "bigint", "product_id": "string", "type": "string", "air_temp_k": "double", "process_temp_k": "double",
    "rotational_speed_rpm": "bigint", "torque_nm": "double", "tool_wear_raw": "string", "machine_failure": "int",
    "twf": "int", "hdf": "int", "pwf": "int", "osf": "int", "rnf": "int",
}
CLEAN_TYPES = {
    "udi": "bigint", "product_id": "string", "machine_type": "string", "air_temp_k": "double", "process_temp_k": "double",
    "rotational_speed_rpm": "double", "torque_nm": "double", "tool_wear_min": "bigint",
    **{c: "boolean" for c in ("machine_failure", "failure_twf", "failure_hdf", "failure_pwf", "failure_osf", "failure_rnf")},
    "power_w": "double", "temp_diff_k": "double", "wear_torque_product": "double", "speed_torque_product": "double",
    "wear_stage": "string",
}

# Fleet queries

ORACLES["q1_1_fleet_health"] = over("tel sta", f"""
SELECT COUNT(DISTINCT t.device_id) AS total_devices,
 COUNT(DISTINCT CASE WHEN s.connection_status = 'Online' THEN t.device_id END) AS online_devices,
 COUNT(DISTINCT CASE WHEN s.connection_status = 'Offline' THEN t.device_id END) AS offline_devices,
 ROUND({pct("COUNT(DISTINCT CASE WHEN s.connection_status = 'Online' THEN t.device_id END)", 'COUNT(DISTINCT t.device_id)')}, 1) AS fleet_uptime_pct,
 ROUND({avg('t.cpu_pct')}, 1) AS avg_cpu_pct, ROUND({avg('t.temperature_c')}, 1) AS avg_temp_c,
 ROUND(MAX(t.temperature_c), 1) AS max_temp_c, {cnt('t.is_anomaly')} AS total_anomalies,
 ROUND({pct('COUNT(*) FILTER (WHERE t.is_anomaly)')}, 2) AS anomaly_rate_pct FROM {_JOINED}""")

ORACLES["q1_2_device_summary"] = over("tel sta", f"""
SELECT t.device_id, t.device_type, t.location, s.connection_status, COUNT(*) AS reading_count,
 ROUND({avg('t.cpu_pct')}, 1) AS avg_cpu_pct, ROUND(MAX(t.cpu_pct), 1) AS max_cpu_pct,
 ROUND({avg('t.temperature_c')}, 1) AS avg_temp_c, ROUND(MAX(t.temperature_c), 1) AS max_temp_c,
 ROUND({iavg('t.signal_dbm')}, 0) AS avg_signal_dbm, {cnt('t.is_anomaly')} AS anomaly_count,
 s.reconnect_count, s.queue_depth, s.messages_published FROM {_JOINED}
GROUP BY t.device_id, t.device_type, t.location, s.connection_status, s.reconnect_count, s.queue_depth, s.messages_published
ORDER BY anomaly_count DESC, avg_cpu_pct DESC, t.device_id""")

ORACLES["q1_3_cpu_ranking"] = over("tel", f"""
SELECT device_id, device_type, location, ROUND(m, 1) AS avg_cpu_pct,
 CAST(RANK() OVER (PARTITION BY location ORDER BY m DESC) AS BIGINT) AS rank_in_location,
 CAST(RANK() OVER (ORDER BY m DESC) AS BIGINT) AS fleet_rank
FROM (SELECT device_id, device_type, location, {avg('cpu_pct')} AS m FROM tel GROUP BY ALL) d
ORDER BY location, rank_in_location, device_id""")

ORACLES["q1_4_hourly"] = over("tel", f"""
SELECT CAST(EXTRACT(HOUR FROM timestamp) AS BIGINT) AS hour_of_day, COUNT(*) AS reading_count,
 ROUND({avg('cpu_pct')}, 1) AS avg_cpu_pct, ROUND({avg('temperature_c')}, 1) AS avg_temp_c,
 ROUND(MAX(cpu_pct), 1) AS peak_cpu_pct, {cnt('is_anomaly')} AS anomaly_count
FROM tel GROUP BY 1 ORDER BY hour_of_day""")

ORACLES["q1_5_anomaly_by_location"] = over("tel", f"""
SELECT location, device_type, COUNT(*) AS total_readings, {cnt('is_anomaly')} AS anomaly_count,
 ROUND({pct('COUNT(*) FILTER (WHERE is_anomaly)')}, 2) AS anomaly_rate_pct
FROM tel GROUP BY location, device_type HAVING COUNT(*) > 50 ORDER BY anomaly_rate_pct DESC""")

ORACLES["q1_6_signal_pivot"] = over("tel", f"""
SELECT location, COUNT(DISTINCT device_id) AS device_count,
 COUNT(DISTINCT CASE WHEN signal_quality = 'Excellent' THEN device_id END) AS excellent,
 COUNT(DISTINCT CASE WHEN signal_quality = 'Good' THEN device_id END) AS good,
 COUNT(DISTINCT CASE WHEN signal_quality = 'Fair' THEN device_id END) AS fair,
 COUNT(DISTINCT CASE WHEN signal_quality = 'Poor' THEN device_id END) AS poor,
 ROUND({iavg('signal_dbm')}, 1) AS avg_signal_dbm FROM tel GROUP BY location ORDER BY avg_signal_dbm""")

ORACLES["q1_7_running"] = over("tel", """
SELECT device_id, device_type, timestamp, cpu_pct, ROW_NUMBER() OVER w AS reading_number,
 CAST(SUM(1) OVER (PARTITION BY device_id ORDER BY timestamp ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulative_readings,
 ROUND(ROUND(AVG(cpu_pct) OVER f, 9), 1) AS rolling_avg_cpu_5
FROM tel WINDOW w AS (PARTITION BY device_id ORDER BY timestamp),
 f AS (PARTITION BY device_id ORDER BY timestamp ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) ORDER BY device_id, timestamp""")

ORACLES["q1_8_spikes"] = over("tel", """
SELECT device_id, device_type, location, timestamp, cpu_pct, prev_cpu_pct, ROUND(cpu_pct - prev_cpu_pct, 1) AS cpu_delta,
 temperature_c, prev_temp_c, ROUND(temperature_c - prev_temp_c, 2) AS temp_delta,
 CASE WHEN cpu_pct - prev_cpu_pct > 25 THEN 'CPU spike' WHEN temperature_c - prev_temp_c > 5 THEN 'Temp spike' ELSE 'Normal' END AS spike_type
FROM (SELECT *, LAG(cpu_pct) OVER w AS prev_cpu_pct, LAG(temperature_c) OVER w AS prev_temp_c
  FROM tel WINDOW w AS (PARTITION BY device_id ORDER BY timestamp)) r
WHERE prev_cpu_pct IS NOT NULL AND (cpu_pct - prev_cpu_pct > 25 OR temperature_c - prev_temp_c > 5)
ORDER BY ABS(cpu_pct - prev_cpu_pct) DESC, device_id, timestamp LIMIT 20""")

_Q19 = f"""
SELECT *, CASE WHEN health_score >= 85 THEN 'Tier 1 — Healthy' WHEN health_score >= 70 THEN 'Tier 2 — Monitor'
  WHEN health_score >= 50 THEN 'Tier 3 — At Risk' ELSE 'Tier 4 — Critical' END AS reliability_tier,
 CAST(RANK() OVER (ORDER BY health_score DESC) AS BIGINT) AS health_rank
FROM (SELECT *, ROUND(CAST(100 AS DOUBLE) - CASE WHEN max_cpu >= 85 THEN 15 ELSE 0 END - CASE WHEN avg_temp >= 70 THEN 10 ELSE 0 END
   - LEAST(reconnect_count, 10) * CAST(2 AS DOUBLE) - CASE WHEN connection_status = 'Offline' THEN 20 ELSE 0 END
   - anomaly_count * CAST(1.5 AS DOUBLE), 1) AS health_score
 FROM (SELECT t.device_id, t.device_type, t.location, s.connection_status, ROUND({avg('t.cpu_pct')}, 1) AS avg_cpu,
   ROUND(MAX(t.cpu_pct), 1) AS max_cpu, ROUND({avg('t.temperature_c')}, 1) AS avg_temp, {cnt('t.is_anomaly')} AS anomaly_count,
   s.reconnect_count, s.queue_depth FROM {_JOINED}
  GROUP BY t.device_id, t.device_type, t.location, s.connection_status, s.reconnect_count, s.queue_depth) m) x"""
ORACLES["q1_9_reliability"] = over("tel sta", f"SELECT * FROM ({_Q19}) r ORDER BY health_rank")
ORACLES["tier_counts"] = over("tel sta", f"SELECT reliability_tier, COUNT(*) AS device_count FROM ({_Q19}) r GROUP BY 1")

ORACLES["q1_10_above_avg_reconnect"] = over("sta", """
SELECT device_id, device_type, location, reconnect_count, queue_depth, connection_status,
 ROUND(reconnect_count - (SELECT AVG(reconnect_count) FROM sta), 1) AS above_fleet_avg
FROM sta WHERE reconnect_count > (SELECT AVG(reconnect_count) FROM sta) ORDER BY reconnect_count DESC""")

# Machine queries

ORACLES["q2_1_failure_by_type"] = over("mach", f"""
SELECT machine_type, COUNT(*) AS total_readings, {cnt('machine_failure')} AS failure_count,
 ROUND({pct('COUNT(*) FILTER (WHERE machine_failure)')}, 2) AS failure_rate_pct, ROUND({avg('torque_nm')}, 1) AS avg_torque_nm,
 ROUND({avg('rotational_speed_rpm')}, 0) AS avg_speed_rpm, ROUND({avg('tool_wear_min')}, 0) AS avg_tool_wear_min,
 CASE WHEN {pct('COUNT(*) FILTER (WHERE machine_failure)')} > 5 THEN 'High risk'
  WHEN {pct('COUNT(*) FILTER (WHERE machine_failure)')} > 2 THEN 'Medium risk' ELSE 'Low risk' END AS risk_category
FROM mach GROUP BY machine_type ORDER BY failure_rate_pct DESC""")

ORACLES["q2_2_failure_modes"] = over("mach", " UNION ALL ".join(
    f"SELECT '{label}' AS failure_mode, {cnt(c)} AS event_count, ROUND({pct(f'COUNT(*) FILTER (WHERE {c})')}, 3) AS rate_pct FROM mach"
    for c, label in [("failure_twf", "TWF — Tool Wear Failure"), ("failure_hdf", "HDF — Heat Dissipation Failure"),
                     ("failure_pwf", "PWF — Power Failure"), ("failure_osf", "OSF — Overstrain Failure"),
                     ("failure_rnf", "RNF — Random Failure")]))

ORACLES["q2_3_wear_stage"] = over("mach", f"""
SELECT wear_stage, COUNT(*) AS readings, {cnt('machine_failure')} AS failures,
 ROUND({pct('COUNT(*) FILTER (WHERE machine_failure)')}, 2) AS failure_rate_pct, ROUND({avg('torque_nm')}, 1) AS avg_torque,
 ROUND({avg('tool_wear_min')}, 0) AS avg_wear_min, ROUND({avg('power_w')}, 1) AS avg_power_w FROM mach GROUP BY wear_stage""")

_ENVELOPE = f"""SELECT torque_band, speed_band, COUNT(*) AS reading_count, {cnt('machine_failure')} AS failure_count,
 ROUND({pct('COUNT(*) FILTER (WHERE machine_failure)')}, 2) AS failure_rate_pct
FROM (SELECT machine_failure,
  CASE WHEN torque_nm < 30 THEN 'Low (<30 Nm)' WHEN torque_nm BETWEEN 30 AND 50 THEN 'Normal (30–50 Nm)' ELSE 'High (>50 Nm)' END AS torque_band,
  CASE WHEN rotational_speed_rpm < 1400 THEN 'Low (<1400 rpm)' WHEN rotational_speed_rpm BETWEEN 1400 AND 1700 THEN 'Normal (1400–1700)'
   ELSE 'High (>1700 rpm)' END AS speed_band FROM mach) b GROUP BY torque_band, speed_band"""
ORACLES["q2_4_envelope"] = over("mach", _ENVELOPE)
ORACLES["envelope_pivot"] = over("mach", f"""
SELECT speed_band, COALESCE(AVG(CASE WHEN torque_band LIKE 'Low%' THEN failure_rate_pct END), 0) AS torque_low,
 COALESCE(AVG(CASE WHEN torque_band LIKE 'Normal%' THEN failure_rate_pct END), 0) AS torque_normal,
 COALESCE(AVG(CASE WHEN torque_band LIKE 'High%' THEN failure_rate_pct END), 0) AS torque_high
FROM ({_ENVELOPE}) e GROUP BY speed_band""")

ORACLES["q2_5_torque_decile"] = over("mach", f"""
SELECT torque_decile, COUNT(*) AS reading_count, ROUND(MIN(torque_nm), 1) AS torque_min, ROUND(MAX(torque_nm), 1) AS torque_max,
 {cnt('machine_failure')} AS failures, ROUND({pct('COUNT(*) FILTER (WHERE machine_failure)')}, 2) AS failure_rate_pct
FROM (SELECT *, CAST(NTILE(10) OVER (ORDER BY torque_nm, udi) AS BIGINT) AS torque_decile FROM mach) r
GROUP BY torque_decile ORDER BY torque_decile""")

_RISK = """ROUND(tool_wear_min / CAST(253 AS DOUBLE) * CAST(40 AS DOUBLE) + CASE WHEN torque_nm > 50 THEN 30 WHEN torque_nm > 40 THEN 15 ELSE 0 END
  + CASE WHEN temp_diff_k < CAST(8.6 AS DOUBLE) THEN 20 ELSE 0 END + CASE WHEN power_w > 8000 OR power_w < 3500 THEN 10 ELSE 0 END, 1)"""
ORACLES["q2_6_risk_ranking"] = over("mach", f"""
SELECT * FROM (SELECT CAST(RANK() OVER (ORDER BY risk_score DESC) AS BIGINT) AS risk_rank, udi, product_id, machine_type, tool_wear_min,
 ROUND(torque_nm, 1) AS torque_nm, ROUND(power_w, 0) AS power_w, ROUND(temp_diff_k, 1) AS temp_diff_k, risk_score,
 CASE WHEN risk_score >= 70 THEN 'Immediate attention' WHEN risk_score >= 50 THEN 'Schedule maintenance'
  WHEN risk_score >= 30 THEN 'Monitor closely' ELSE 'Normal operation' END AS recommendation
FROM (SELECT *, {_RISK} AS risk_score FROM mach WHERE NOT machine_failure) s) r WHERE risk_rank <= 15 ORDER BY risk_rank""")

ORACLES["q2_7_rolling_failure"] = over("mach", "SELECT udi, machine_failure, " + ", ".join(
    f"""ROUND(CAST(SUM(CAST(machine_failure AS INT)) OVER (ORDER BY udi ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS DOUBLE)
 / CAST(COUNT(*) OVER (ORDER BY udi ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS DOUBLE) * CAST(100 AS DOUBLE), 2) AS rolling_{n}_failure_rate_pct"""
    for n in (500, 1000)) + " FROM mach WHERE udi % 50 = 0 ORDER BY udi")

ORACLES["cumulative_high_wear"] = over("mach", """
SELECT udi, machine_type, tool_wear_min, CAST(COUNT(*) OVER (PARTITION BY machine_type ORDER BY tool_wear_min DESC, udi
 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulative_high_wear FROM mach WHERE NOT machine_failure""")

# Messages and points

ORACLES["route_topic"] = over("routed", """
SELECT device_id, kind, COUNT(*) AS messages FROM routed WHERE kind IN ('telemetry', 'status', 'events') GROUP BY ALL""")
ORACLES["decode_telemetry"] = over("tpoints", "SELECT * FROM tpoints")
ORACLES["decode_status"] = over("spoints", "SELECT * FROM spoints")
ORACLES["decode_events"] = over("epoints", "SELECT * FROM epoints")
ORACLES["dead_letters"] = over("outcome", "SELECT topic, payload, arrival_ts FROM outcome WHERE outcome = 'parse_error'")
ORACLES["ingest_quality"] = over("outcome", f"""
SELECT {cnt('subscribed')} AS messages_received, {cnt("outcome = 'written'")} AS messages_written,
 {cnt("outcome = 'parse_error'")} AS parse_errors, {cnt("outcome LIKE 'ignored%'")} AS ignored FROM outcome""")
ORACLES["dedup_messages"] = over("tpoints", "SELECT DISTINCT * FROM tpoints")
ORACLES["write_points"] = ORACLES["dedup_messages"]
ORACLES["stream_dedup"] = ORACLES["dedup_messages"]
ORACLES["stream_quality"] = ORACLES["ingest_quality"]
ORACLES["store_range"] = over("tpoints", """
SELECT DISTINCT * FROM tpoints WHERE time >= (SELECT MAX(time) FROM tpoints) - INTERVAL 6 HOUR""")
ORACLES["stream_ingest"] = over("spoints", "SELECT DISTINCT * FROM spoints")
ORACLES["ingest_messages"] = over("outcome", """
SELECT CASE WHEN outcome = 'parse_error' THEN 'dead_letter' ELSE kind END AS sink, COUNT(*) AS points
FROM outcome WHERE outcome IN ('written', 'parse_error') GROUP BY 1""")
ORACLES["ingest_message_log"] = ORACLES["ingest_messages"]
ORACLES["stream_derive"] = over("tpoints", f"""
SELECT device_id, time AS timestamp, CAST(hour(time) AS BIGINT) AS hour, dayname(time) AS weekday, anomaly = 'True' AS is_anomaly,
 {_QUALITY.format(x='signal_dbm')} AS signal_quality, {_TEMP.format(x='temperature_c')} AS temp_status,
 {_CPU.format(x='cpu_percent')} AS cpu_status FROM tpoints""")
ORACLES["stream_latest_status"] = over("spoints", """
SELECT device_id, device_type, location, queue_depth, reconnect_count,
 round_even(uptime_s / CAST(3600 AS DOUBLE), 2) AS uptime_hours,
 CASE WHEN is_connected = 1 THEN 'Online' ELSE 'Offline' END AS connection_status
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY device_id ORDER BY time DESC) AS nth FROM spoints) s WHERE nth = 1""")
ORACLES["stream_hourly"] = over("tpoints", f"""
SELECT date_trunc('hour', time) AS hour_start, COUNT(*) AS reading_count, ROUND({avg('cpu_percent')}, 1) AS avg_cpu_pct,
 ROUND({avg('temperature_c')}, 1) AS avg_temp_c, ROUND(MAX(cpu_percent), 1) AS peak_cpu_pct, {cnt("anomaly = 'True'")} AS anomaly_count
FROM tpoints GROUP BY 1""")
_BASE = "id, timestamp, device_id, device_type, location, cpu_pct, ram_pct, temperature_c, signal_dbm, uptime_s, is_anomaly"
ORACLES["range_scan"] = over("tel", f"""
SELECT {_BASE} FROM tel WHERE timestamp >= (SELECT MAX(timestamp) FROM tel) - INTERVAL 6 HOUR""")
_KEYS = "timestamp, device_id, device_type, location, is_anomaly"
_FIELDS = ["cpu_pct", "ram_pct", "temperature_c", "signal_dbm", "uptime_s"]
ORACLES["unpivot_fields"] = over("tel", " UNION ALL ".join(
    f"SELECT {_KEYS}, '{f}' AS field, CAST({f} AS DOUBLE) AS value FROM tel" for f in _FIELDS))
ORACLES["pivot_fields"] = over("tel", f"SELECT {_KEYS}, " + ", ".join(f"CAST({f} AS DOUBLE) AS {f}" for f in _FIELDS) + " FROM tel")
ORACLES["normalise_result"] = over("tel", """
SELECT timestamp, device_id, cpu_pct, ram_pct, CAST(NULL AS INTEGER) AS signal_dbm FROM tel
UNION ALL SELECT timestamp, device_id, NULL, NULL, signal_dbm FROM tel""")
ORACLES["latest_status"] = over("sta", "SELECT * FROM sta")
ORACLES["surrogate_id"] = over("tel", """
SELECT timestamp, device_id, id, ROW_NUMBER() OVER (ORDER BY timestamp, device_id) AS surrogate_id FROM tel""")
ORACLES["table_counts"] = over("tel sta fev base", """
SELECT 'fleet_telemetry' AS table_name, COUNT(*) AS row_count FROM tel UNION ALL SELECT 'fleet_status', COUNT(*) FROM sta
UNION ALL SELECT 'fleet_events', COUNT(*) FROM fev UNION ALL SELECT 'machines', COUNT(*) FROM base""")
ORACLES["load_telemetry_flags"] = over("tel", "SELECT id, device_id, is_anomaly FROM tel")
ORACLES["load_telemetry_csv"] = over("tel", "SELECT * EXCLUDE (id) FROM tel")
ORACLES["load_status_csv"] = over("sta", """SELECT * REPLACE (CAST(queue_depth AS BIGINT) AS queue_depth,
 CAST(reconnect_count AS BIGINT) AS reconnect_count) FROM sta""")
ORACLES["load_events_csv"] = over("fev", "SELECT * EXCLUDE (id) FROM fev")
ORACLES["load_machines_csv"] = over("mach", "SELECT * REPLACE (CAST(rotational_speed_rpm AS DOUBLE) AS rotational_speed_rpm) FROM mach")
ORACLES["write_csv"] = over("tel", f"SELECT device_id, COUNT(*) AS reading_count, {cnt('is_anomaly')} AS anomaly_count FROM tel GROUP BY 1")
ORACLES["bi_rename"] = over("tel", """
SELECT id, timestamp AS "Timestamp", device_id AS "Device ID", device_type AS "Device Type", location AS "Location", cpu_pct AS "CPU %",
 ram_pct AS "RAM %", temperature_c AS "Temperature (°C)", signal_dbm AS "Signal (dBm)", uptime_s AS "Uptime (s)",
 is_anomaly AS "Is Anomaly", signal_quality AS "Signal Quality", temp_status AS "Temp Status", cpu_status AS "CPU Status",
 CAST(hour(timestamp) AS BIGINT) AS "Hour", CAST(timestamp AS DATE) AS "Date", dayname(timestamp) AS "Weekday" FROM tel""")
ORACLES["export_status"] = over("snap", """
SELECT timestamp AS "Timestamp", device_id AS "Device ID", device_type AS "Device Type", location AS "Location", uptime_s AS "Uptime (s)",
 publish_count AS "Messages Published", error_count AS "Error Count", queue_depth AS "Queue Depth", reconnect_count AS "Reconnect Count",
 is_connected AS "Is Connected", round_even(uptime_s / CAST(3600 AS DOUBLE), 2) AS "Uptime (hours)",
 CASE WHEN is_connected = 1 THEN 'Online' ELSE 'Offline' END AS "Connection Status" FROM snap""")
ORACLES["export_events"] = over("fev", """
SELECT id, device_id AS "Device ID", device_type AS "Device Type", location AS "Location", event_type AS "Event Type",
 firmware_version AS "Firmware Version", event_timestamp AS "Timestamp" FROM fev""")

# Derived columns and joins

ORACLES["time_parts"] = over("tel", """
SELECT id, timestamp, CAST(hour(timestamp) AS BIGINT) AS hour, CAST(timestamp AS DATE) AS date, dayname(timestamp) AS weekday FROM tel""")
ORACLES["signal_quality"] = over("tel", "SELECT id, signal_dbm, signal_quality FROM tel")
ORACLES["temp_status"] = over("tel", "SELECT id, temperature_c, temp_status FROM tel")
ORACLES["cpu_status"] = over("tel", "SELECT id, cpu_pct, cpu_status FROM tel")
ORACLES["uptime_hours"] = over("snap", "SELECT device_id, timestamp, round_even(uptime_s / CAST(3600 AS DOUBLE), 2) AS uptime_hours FROM snap")
ORACLES["connection_status"] = over("snap", """
SELECT device_id, timestamp, CASE WHEN is_connected = 1 THEN 'Online' ELSE 'Offline' END AS connection_status FROM snap""")
ORACLES["filter_anomalous"] = over("tel", f"SELECT {_BASE} FROM tel WHERE is_anomaly")
ORACLES["simple_thresholds"] = over("tel", f"""
SELECT {cnt('temperature_c > 75')} AS high_temp_readings, {cnt('signal_dbm < -75')} AS poor_signal_readings FROM tel""")
ORACLES["join_status_left"] = over("tel sta", f"""
SELECT t.device_id, COUNT(*) AS reading_count, s.connection_status, s.reconnect_count, s.queue_depth FROM {_JOINED}
GROUP BY t.device_id, s.connection_status, s.reconnect_count, s.queue_depth""")
_KPIS = f"""SELECT device_id, avg_cpu_pct, max_cpu_pct, p95_cpu_pct, avg_ram_pct, avg_temp_c, max_temp_c, avg_signal_dbm, anomaly_count,
 device_type, location, reconnect_count, round_even(LEAST(GREATEST(CAST(100 AS DOUBLE) - max_cpu_pct * CAST(0.3 AS DOUBLE)
  - (max_temp_c - CAST(40 AS DOUBLE)) * CAST(0.5 AS DOUBLE) - anomaly_count * CAST(2 AS DOUBLE), 0), 100), 1) AS health_score
FROM (SELECT device_id, round_even({avg('cpu_pct')}, 1) AS avg_cpu_pct, round_even(MAX(cpu_pct), 1) AS max_cpu_pct,
  round_even({quantile('cpu_pct', 0.95, 'lower')}, 1) AS p95_cpu_pct, round_even({avg('ram_pct')}, 1) AS avg_ram_pct,
  round_even({avg('temperature_c')}, 1) AS avg_temp_c, round_even(MAX(temperature_c), 1) AS max_temp_c,
  round_even({iavg('signal_dbm')}, 0) AS avg_signal_dbm, {cnt('is_anomaly')} AS anomaly_count,
  arg_max(device_type, timestamp) AS device_type, arg_max(location, timestamp) AS location FROM tel GROUP BY device_id) d
LEFT JOIN (SELECT device_id, MAX(reconnect_count) AS reconnect_count FROM snap GROUP BY device_id) r USING (device_id)"""
ORACLES["device_kpis"] = over("tel snap", _KPIS)
ORACLES["summary_join_latest"] = over("tel snap", f"SELECT device_id, avg_cpu_pct, device_type, location FROM ({_KPIS}) k")
ORACLES["summary_join_reconnect"] = over("tel snap", f"SELECT device_id, max_cpu_pct, reconnect_count FROM ({_KPIS}) k")
_RANGE = "timestamp >= (SELECT MAX(timestamp) FROM tel) - INTERVAL 6 HOUR"
_RECENT = over("tel snap", "SELECT 1").removesuffix("SELECT 1").rstrip() + f""",
 rtel AS (SELECT * FROM tel WHERE {_RANGE}), rsnap AS (SELECT * FROM snap WHERE {_RANGE})
"""
_RECENT_KPIS = re.sub(r"\bsnap\b", "rsnap", re.sub(r"\btel\b", "rtel", _KPIS))
ORACLES["export_summary"] = _RECENT + "SELECT " + ", ".join(
    f'{c} AS "{n}"' for c, n in SUMMARY_NAMES.items()) + f" FROM ({_RECENT_KPIS}) k"
ORACLES["export_roundtrip"] = _RECENT + f"""SELECT device_id, COUNT(*) AS reading_count, {cnt('is_anomaly')} AS anomaly_count,
 MAX(cpu_pct) AS max_cpu_pct, MAX(timestamp) AS last_reading, (SELECT COUNT(*) FROM rsnap s WHERE s.device_id = r.device_id) AS snapshots
FROM rtel r GROUP BY device_id"""
ORACLES["scalar_subquery"] = over("tel", f"""
SELECT device_id, ROUND(m, 2) AS avg_cpu_pct, ROUND(m - f, 2) AS above_fleet_avg
FROM (SELECT device_id, {avg('cpu_pct')} AS m FROM tel GROUP BY device_id) d, (SELECT {avg('cpu_pct')} AS f FROM tel) g WHERE m > f""")

# Anomaly detection

ORACLES["validate_features"] = over("tel", """SELECT COUNT(cpu_pct) AS cpu_pct_values, COUNT(ram_pct) AS ram_pct_values,
 COUNT(temperature_c) AS temperature_c_values, COUNT(signal_dbm) AS signal_dbm_values FROM tel""")
ORACLES["zscore"] = over("flags", "SELECT id, device_id, ROUND(max_zscore, 9) AS max_zscore, zscore_anomaly, zscore_trigger FROM flags")
ORACLES["iqr"] = over("flags", "SELECT id, device_id, " + ", ".join(
    f"ROUND(iqr_{s}_{f}, 9) AS iqr_{s}_{f}" for f in ("cpu_pct", "ram_pct", "temperature_c", "signal_dbm") for s in ("lo", "hi"))
    + ", iqr_anomaly, iqr_trigger FROM flags")
ORACLES["align_methods"] = over("flags", "SELECT id, zscore_anomaly, zscore_trigger, iqr_anomaly, iqr_trigger FROM flags")
ORACLES["consensus"] = over("cons", "SELECT id, method_count, consensus_anomaly FROM cons")
ORACLES["consensus_jump"] = over("cons", """
SELECT id, jump AS jump_anomaly, method_count + CAST(jump AS BIGINT) AS method_count, method_count + CAST(jump AS BIGINT) >= 2 AS consensus_anomaly
FROM (SELECT *, COALESCE(ABS(temperature_c - LAG(temperature_c IGNORE NULLS) OVER (
  PARTITION BY device_id, CAST(timestamp AS DATE) ORDER BY timestamp, id)) > 30, FALSE) AS jump FROM cons) j""")
ORACLES["anomaly_summary"] = over("asum", "SELECT * FROM asum ORDER BY consensus_anomalies DESC, device_id")
ORACLES["method_rates"] = over("asum", " UNION ALL ".join(
    f"SELECT '{m}' AS method, CAST(SUM({m}_anomalies) AS BIGINT) AS anomalies, ROUND({pct(f'SUM({m}_anomalies)', 'SUM(total_readings)')}, 2) AS rate_pct FROM asum"
    for m in ("zscore", "iqr", "consensus")))
ORACLES["consensus_by_type"] = over("asum", """
SELECT device_type, CAST(SUM(consensus_anomalies) AS BIGINT) AS consensus_anomalies FROM asum GROUP BY 1""")
ORACLES["method_agreement"] = over("asum", " UNION ALL ".join(
    f"SELECT device_id, '{m}' AS method, ROUND({pct(f'{m}_anomalies', 'total_readings')}, 4) AS rate_pct FROM asum" for m in ("zscore", "iqr")))
ORACLES["top_device_series"] = over("cons", """
SELECT device_id, timestamp, cpu_pct, temperature_c, ROUND(iqr_lo_temperature_c, 9) AS iqr_lo_temperature_c,
 ROUND(iqr_hi_temperature_c, 9) AS iqr_hi_temperature_c, zscore_anomaly, iqr_anomaly, consensus_anomaly FROM cons
WHERE device_id = (SELECT device_id FROM cons GROUP BY device_id ORDER BY COUNT(*) FILTER (WHERE consensus_anomaly) DESC, device_id LIMIT 1)""")
ORACLES["zscore_histogram"] = over_hist(
    "flags", "SELECT ROUND(max_zscore, 9) AS v FROM flags WHERE ROUND(max_zscore, 9) < 8", "", 40, "SELECT bin, n FROM histo")

# Cleaning

ORACLES["profile"] = over("raw", _profile("raw", RAW_TYPES))
ORACLES["strip_headers"] = over("raw", "SELECT udi, air_temp_k, process_temp_k FROM raw")
ORACLES["coerce_numeric"] = over("raw", f"""
SELECT tool_wear_raw AS sentinel, COUNT(*) AS readings, ROUND({pct('COUNT(*)', '(SELECT COUNT(*) FROM raw)')}, 2) AS share_pct
FROM raw WHERE tool_wear_raw IS NOT NULL AND TRY_CAST(trim(tool_wear_raw) AS DOUBLE) IS NULL GROUP BY 1""")
ORACLES["null_audit"] = over("num", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{name}' AS column_name, {cnt(f'{c} IS NULL')} AS nulls, {cnt(f'{c} IS NULL AND machine_failure = 1')} AS nulls_on_failures FROM num"
    for c, name in [*[(c, c) for c in RAW_TYPES if c != "tool_wear_raw"], ("w", "tool_wear_min")]) + ") n WHERE nulls > 0")
ORACLES["fill_forward"] = over("filled", "SELECT udi, air_temp_k, rotational_speed_rpm, COUNT(*) AS copies FROM filled GROUP BY ALL")
ORACLES["fill_group_median"] = over("filled", "SELECT udi, type, torque_nm, COUNT(*) AS copies FROM filled GROUP BY ALL")
ORACLES["interpolate"] = over("filled", "SELECT udi, tool_wear_min, COUNT(*) AS copies FROM filled GROUP BY ALL")
ORACLES["dedup_exact"] = over("uniq", "SELECT * FROM uniq")
ORACLES["celsius_to_kelvin"] = over("kelvin", "SELECT udi, air_temp_k, process_temp_k FROM kelvin")
ORACLES["celsius_report"] = over("uniq kelvin", f"""
SELECT (SELECT {cnt('air_temp_k < 100')} FROM uniq) AS air_celsius_rows, {cnt('process_temp_k < 100')} AS process_celsius_rows,
 MIN(air_temp_k) AS air_min_k, MAX(air_temp_k) AS air_max_k, MIN(air_temp_k) > 200 AS all_kelvin FROM kelvin""")
ORACLES["clip_iqr"] = over("clipped", "SELECT udi, ROUND(rotational_speed_rpm, 6) AS rotational_speed_rpm, ROUND(torque_nm, 6) AS torque_nm FROM clipped")
ORACLES["clip_report"] = over("uniq fence", """
SELECT 'rotational_speed_rpm' AS column_name, MAX(rlo) AS lower_fence, MAX(rhi) AS upper_fence,
 CAST(COUNT(*) FILTER (WHERE rotational_speed_rpm < rlo OR rotational_speed_rpm > rhi) AS BIGINT) AS clipped FROM uniq, fence
UNION ALL SELECT 'torque_nm', MAX(tlo), MAX(thi), CAST(COUNT(*) FILTER (WHERE torque_nm < tlo OR torque_nm > thi) AS BIGINT) FROM uniq, fence""")
ORACLES["normalise_type"] = over("uniq clean", """
SELECT u.type AS raw_type, c.machine_type, COUNT(*) AS readings FROM uniq u JOIN (SELECT DISTINCT udi, machine_type FROM clean) c
 ON u.udi = c.udi GROUP BY ALL""")
_ANY = "twf + hdf + pwf + osf + rnf > 0"
ORACLES["fix_labels"] = over("uniq", f"""
SELECT {cnt(f'machine_failure = 0 AND {_ANY}')} AS contradictions, CAST(0 AS BIGINT) AS contradictions_after,
 {cnt('machine_failure = 1')} AS failures, {cnt(f'machine_failure = 1 AND NOT ({_ANY})')} AS failures_without_mode FROM uniq""")
ORACLES["features"] = over("mach", "SELECT udi, power_w, temp_diff_k, wear_torque_product, speed_torque_product FROM mach")
ORACLES["wear_stage"] = over("mach", "SELECT udi, tool_wear_min, wear_stage FROM mach")
ORACLES["clean_machines"] = over("clean", "SELECT * FROM clean")
ORACLES["profile_clean"] = over("clean", _profile("clean", CLEAN_TYPES))
ORACLES["describe_features"] = over("clean", " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, COUNT({c}) AS value_count, round_even(AVG({c}), 2) AS mean, round_even(STDDEV_SAMP({c}), 2) AS std,
 round_even(MIN({c}), 2) AS min, round_even({quantile(c, 0.25)}, 2) AS q25, round_even({quantile(c, 0.5)}, 2) AS q50,
 round_even({quantile(c, 0.75)}, 2) AS q75, round_even(MAX({c}), 2) AS max FROM clean"""
    for c in ("power_w", "temp_diff_k", "wear_torque_product", "speed_torque_product")))
_RATE = pct("COUNT(*) FILTER (WHERE machine_failure)")
_FAILED = cnt("machine_failure")
ORACLES["key_findings"] = over("clean", f"""
SELECT 'failure_rate' AS finding, 'all' AS item, ROUND({_RATE}, 1) AS value, {_FAILED} AS events, '' AS note FROM clean
UNION ALL SELECT 'rate_by_type', machine_type, ROUND({_RATE}, 1), {_FAILED}, '' FROM clean WHERE machine_type IS NOT NULL GROUP BY machine_type
UNION ALL SELECT 'rate_by_stage', wear_stage, ROUND({_RATE}, 1), {_FAILED}, CASE WHEN {_RATE} > 5 THEN 'HIGH RISK' ELSE 'normal' END
 FROM clean WHERE wear_stage IS NOT NULL GROUP BY wear_stage
UNION ALL SELECT * FROM (SELECT 'top_mode', mode, CAST(NULL AS DOUBLE), events, '' FROM (""" + " UNION ALL ".join(
    f"SELECT {i} AS o, '{m}' AS mode, {cnt('failure_' + m.lower())} AS events FROM clean" for i, m in enumerate(("TWF", "HDF", "PWF", "OSF", "RNF")))
    + f""") m ORDER BY events DESC, o LIMIT 1) t
UNION ALL SELECT 'threshold', 'torque_above', ROUND({quantile('torque_nm', 0.75)}, 1), NULL, 'elevated failure risk' FROM clean WHERE machine_failure
UNION ALL SELECT 'threshold', 'speed_below', ROUND({quantile('rotational_speed_rpm', 0.25)}, 0), NULL, 'elevated failure risk' FROM clean WHERE machine_failure""")
ORACLES["class_histograms"] = over_hist("clean", " UNION ALL ".join(
    f"""SELECT '{f}' AS feature, CASE WHEN machine_failure THEN 'failure' ELSE 'normal' END AS outcome, CAST({f} AS DOUBLE) AS v
 FROM clean WHERE {f} IS NOT NULL""" for f in ("torque_nm", "rotational_speed_rpm", "tool_wear_min", "wear_torque_product")),
    "feature, outcome", 40, """SELECT feature, outcome, bin, ROUND(bin_lo, 6) AS bin_lo, ROUND(bin_hi, 6) AS bin_hi, n,
 ROUND(density, 9) AS density FROM histo""")
ORACLES["air_histogram"] = over_hist("uniq", "SELECT air_temp_k AS v FROM uniq WHERE air_temp_k IS NOT NULL", "", 80,
    "SELECT bin, ROUND(bin_lo, 6) AS bin_lo, ROUND(bin_hi, 6) AS bin_hi, n FROM histo")
ORACLES["rate_by_type"] = over("clean", f"SELECT machine_type, {_RATE} AS failure_rate_pct FROM clean WHERE machine_type IS NOT NULL GROUP BY 1")
ORACLES["rate_by_stage"] = over("clean", f"SELECT wear_stage, {_RATE} AS failure_rate_pct FROM clean WHERE wear_stage IS NOT NULL GROUP BY 1")
ORACLES["mode_totals"] = over("clean", " UNION ALL ".join(
    f"SELECT '{m}' AS mode, {cnt('failure_' + m.lower())} AS events FROM clean" for m in ("TWF", "HDF", "PWF", "OSF", "RNF")))
_CORR = ["air_temp_k", "process_temp_k", "rotational_speed_rpm", "torque_nm", "tool_wear_min", "power_w", "temp_diff_k", "machine_failure"]
def _num(c: str) -> str:
    return f"CAST(CAST({c} AS INTEGER) AS DOUBLE)" if c == "machine_failure" else c


ORACLES["correlation_matrix"] = over("clean", " UNION ALL ".join(
    f"SELECT '{a}' AS x, '{b}' AS y, ROUND(CORR({_num(a)}, {_num(b)}), 9) AS r FROM clean" for a in _CORR for b in _CORR))
ORACLES["cleaning_log"] = over("raw num uniq fence", f"""
SELECT 'Step 1' AS step, 'Padded column names' AS problem, 'trimmed' AS effect, CAST(0 AS BIGINT) AS affected
UNION ALL SELECT 'Step 2', 'Text in the tool wear column', 'set to null', (SELECT {cnt('tool_wear_raw IS NOT NULL AND w IS NULL')} FROM num)
UNION ALL SELECT 'Step 3', 'Missing sensor values', 'filled forward, by type median, interpolated', (SELECT """ + " + ".join(
    cnt(f"{c} IS NULL") for c in [*[c for c in RAW_TYPES if c != "tool_wear_raw"], "w"]) + f""" FROM num)
UNION ALL SELECT 'Step 4', 'Resent readings', 'copies removed', (SELECT COUNT(*) FROM raw) - (SELECT COUNT(*) FROM uniq)
UNION ALL SELECT 'Step 5', 'Celsius among Kelvin', 'converted', (SELECT {cnt('air_temp_k < 100')} FROM uniq)
UNION ALL SELECT 'Step 6', 'Impossible speed or torque', 'clipped to the fences',
 (SELECT {cnt('rotational_speed_rpm < rlo OR rotational_speed_rpm > rhi')} + {cnt('torque_nm < tlo OR torque_nm > thi')} FROM uniq, fence)
UNION ALL SELECT 'Step 7', 'Spellings of the type', 'normalised to L, M, H', (SELECT {cnt("type IS NOT NULL AND type NOT IN ('L', 'M', 'H')")} FROM uniq)
UNION ALL SELECT 'Step 8', 'Failure mode without failure', 'modes set to 0', (SELECT {cnt(f'machine_failure = 0 AND {_ANY}')} FROM uniq)""")
ORACLES["power_vs_dt_points"] = over("clean", "SELECT power_w, temp_diff_k, machine_failure FROM clean")

# KPIs and charts

ORACLES["fleet_summary"] = over("tel snap", f"""
SELECT COUNT(DISTINCT device_id) AS devices, ROUND({avg('cpu_pct')}, 1) AS avg_cpu_pct, ROUND(MAX(cpu_pct), 1) AS max_cpu_pct,
 ROUND({avg('temperature_c')}, 1) AS avg_temp_c, {cnt('temperature_c > 75')} AS high_temp_readings, ROUND({iavg('signal_dbm')}, 0) AS avg_signal_dbm,
 {cnt('signal_dbm < -75')} AS poor_signal_readings, {cnt('is_anomaly')} AS anomaly_events,
 (SELECT CAST(MAX(queue_depth) AS BIGINT) FROM snap) AS max_queue,
 (SELECT CAST(SUM(r) AS BIGINT) FROM (SELECT MAX(reconnect_count) AS r FROM snap GROUP BY device_id) q) AS total_reconnects FROM tel""")
for _name, _col, _out in (("top_cpu", "cpu_pct", "avg_cpu_pct"), ("top_temp", "temperature_c", "avg_temp_c")):
    ORACLES[_name] = over("tel", f"""SELECT device_id, ROUND(m, 1) AS {_out} FROM (SELECT device_id, {avg(_col)} AS m FROM tel
 GROUP BY device_id ORDER BY m DESC, device_id LIMIT 5) d""")
ORACLES["location_means"] = over("tel", f"""
SELECT location, round_even({avg('cpu_pct')}, 1) AS avg_cpu_pct, round_even({avg('temperature_c')}, 1) AS avg_temp_c,
 round_even({iavg('signal_dbm')}, 1) AS avg_signal_dbm FROM tel GROUP BY location""")
ORACLES["cpu_boxplot"] = over("tel", f"""
SELECT device_type, ROUND(q1, 9) AS q1, ROUND(median, 9) AS median, ROUND(q3, 9) AS q3, COUNT(cpu_pct) AS readings, MIN(cpu_pct) AS min,
 MAX(cpu_pct) AS max, MIN(CASE WHEN inside THEN cpu_pct END) AS whisker_lo, MAX(CASE WHEN inside THEN cpu_pct END) AS whisker_hi,
 COUNT(*) FILTER (WHERE NOT inside) AS outliers
FROM (SELECT *, cpu_pct >= q1 - CAST(1.5 AS DOUBLE) * (q3 - q1) AND cpu_pct <= q3 + CAST(1.5 AS DOUBLE) * (q3 - q1) AS inside
 FROM tel JOIN (SELECT device_type, {quantile('cpu_pct', 0.25)} AS q1, {quantile('cpu_pct', 0.5)} AS median, {quantile('cpu_pct', 0.75)} AS q3
  FROM tel GROUP BY device_type) q USING (device_type)) t GROUP BY device_type, q1, median, q3""")
ORACLES["signal_histogram"] = over_hist("tel", "SELECT CAST(signal_dbm AS DOUBLE) AS v FROM tel", "", 20,
    "SELECT bin, ROUND(bin_lo, 9) AS bin_lo, ROUND(bin_hi, 9) AS bin_hi, n FROM histo")
ORACLES["anomalies_by_location"] = over("tel", "SELECT location, COUNT(*) AS anomaly_count FROM tel WHERE is_anomaly GROUP BY location")
ORACLES["queue_trend"] = over("snap", "SELECT timestamp, CAST(MAX(queue_depth) AS BIGINT) AS max_queue_depth FROM snap GROUP BY timestamp")
ORACLES["ram_pivot"] = over("tel", "SELECT location, " + ", ".join(
    f"round_even(favg(ram_pct) FILTER (WHERE device_type = '{t}'), 1) AS {t}"
    for t in ("camera", "controller", "gateway", "sensor")) + " FROM tel GROUP BY location")
ORACLES["temp_trend"] = over("tel", """
SELECT device_id, timestamp, temperature_c FROM tel WHERE device_id IN (SELECT DISTINCT device_id FROM tel ORDER BY device_id LIMIT 5)""")

# Insight report

_R = f"""SELECT fleet_size, offline_count, fleet_size - offline_count AS online_count,
 round_even((fleet_size - offline_count) / CAST(fleet_size AS DOUBLE) * CAST(100 AS DOUBLE), 1) AS uptime_pct, anomaly_count,
 round_even(anomaly_count / CAST(n AS DOUBLE) * CAST(100 AS DOUBLE), 2) AS anomaly_rate, total_messages, total_queued, total_reconnects,
 cam_cpu, cam_temp, cam_temp_max, camera_count, CAST(round_even(cam_crit * CAST(100 AS DOUBLE) / crit, 0) AS BIGINT) AS cam_crit_cpu_pct
FROM (SELECT COUNT(DISTINCT device_id) AS fleet_size, COUNT(*) AS n, {cnt('is_anomaly')} AS anomaly_count,
  {cnt("cpu_status = 'Critical'")} AS crit, {cnt("cpu_status = 'Critical' AND device_type = 'camera'")} AS cam_crit,
  COUNT(DISTINCT CASE WHEN device_type = 'camera' THEN device_id END) AS camera_count FROM tel) t,
 (SELECT round_even({avg('cpu_pct')}, 1) AS cam_cpu, round_even({avg('temperature_c')}, 1) AS cam_temp, round_even(MAX(temperature_c), 1) AS cam_temp_max
  FROM tel WHERE device_type = 'camera') c,
 (SELECT {cnt("connection_status = 'Offline'")} AS offline_count, CAST(SUM(messages_published) AS BIGINT) AS total_messages,
  CAST(SUM(queue_depth) AS BIGINT) AS total_queued, CAST(SUM(reconnect_count) AS BIGINT) AS total_reconnects FROM sta) s"""
ORACLES["report_kpis"] = over("tel sta", _R)
_WORST = "SELECT * FROM sta ORDER BY reconnect_count DESC, device_id LIMIT 1"
_RELIABLE = "reconnect_count <= 2 AND connection_status = 'Online'"
_STABLE = f"SELECT * FROM sta ORDER BY CASE WHEN {_RELIABLE} THEN 0 ELSE 1 END, reconnect_count, device_id LIMIT 1"
_QUEUED = "SELECT * FROM sta WHERE connection_status = 'Offline' ORDER BY queue_depth DESC, device_id LIMIT {n}"
_HOT = f"SELECT location, round_even(m, 1) AS avg_cpu_pct FROM (SELECT location, {avg('cpu_pct')} AS m FROM tel GROUP BY location ORDER BY m DESC, location LIMIT 1) l"
_LEADER = "SELECT device_type, COUNT(*) AS anomaly_count FROM tel WHERE is_anomaly GROUP BY device_type ORDER BY anomaly_count DESC, device_type LIMIT 1"
_NEAR = f"""SELECT string_agg(device_id, ' and ' ORDER BY queue_depth DESC, device_id) AS device_ids,
 string_agg(device_id || ' (' || location || ', ' || queue_depth || ' messages queued)', ' and ' ORDER BY queue_depth DESC, device_id) AS devices_text,
 CAST(SUM(queue_depth) AS BIGINT) AS total_queue_depth FROM ({_QUEUED.format(n=2)}) q"""
_CAMS = """SELECT (SELECT string_agg(location, ' and ' ORDER BY t DESC, location) FROM (SELECT location, MAX(temperature_c) AS t FROM tel
  WHERE device_type = 'camera' AND temp_status <> 'Normal' GROUP BY location ORDER BY t DESC, location LIMIT 2) l) AS locations,
 (SELECT string_agg(device_id, ' and ' ORDER BY t DESC, device_id) FROM (SELECT device_id, MAX(temperature_c) AS t FROM tel
  WHERE device_type = 'camera' GROUP BY device_id ORDER BY t DESC, device_id LIMIT 2) d) AS device_ids"""
_PEAKS = """SELECT device_id, location, MAX(temperature_c) AS peak_temp_c FROM tel WHERE temp_status <> 'Normal'
 GROUP BY device_id, location ORDER BY peak_temp_c DESC, device_id, location LIMIT 5"""
ORACLES["worst_device"] = over("sta", _WORST)
ORACLES["stable_device"] = over("sta", _STABLE)
ORACLES["most_queued"] = over("sta", _QUEUED.format(n=1))
ORACLES["hot_location"] = over("tel", _HOT)
ORACLES["critical_cpu_devices"] = over("tel", "SELECT device_id, MAX(cpu_pct) AS max_cpu_pct FROM tel WHERE cpu_status = 'Critical' GROUP BY device_id")
ORACLES["temp_peaks"] = over("tel", _PEAKS)
ORACLES["high_reconnect"] = over("sta", "SELECT device_id, location, reconnect_count FROM sta WHERE reconnect_count > 8")
ORACLES["reliable_devices"] = over("sta", f"SELECT * FROM sta WHERE {_RELIABLE}")
ORACLES["anomaly_leader"] = over("tel", _LEADER)
ORACLES["near_capacity"] = over("sta", _NEAR)
ORACLES["hot_cameras"] = over("tel", _CAMS)
_CAM_CPU = f"""SELECT p.device_id, p.location, COALESCE(printf('%.1f', m) || '%', '—') AS avg_cpu,
 printf('%.1f', round_even(peak_temp_c, 1)) || '°C' AS peak_temp, '⚠ Monitor' AS status FROM ({_PEAKS}) p
 LEFT JOIN (SELECT device_id, round_even({avg('cpu_pct')}, 1) AS m FROM tel WHERE device_type = 'camera' GROUP BY device_id) c USING (device_id)"""
ORACLES["camera_mean_cpu"] = over("tel", _CAM_CPU)
ORACLES["lookup_camera_cpu"] = over("tel", f"SELECT device_id, location, avg_cpu FROM ({_CAM_CPU}) c")

_ALL_FACTS = f"""({_R}) k, ({_WORST}) w, ({_NEAR}) n, ({_CAMS}) c,
 (SELECT COUNT(*) AS devices, COUNT(DISTINCT location) AS places FROM sta WHERE reconnect_count > 8) p,
 (SELECT string_agg(location, ', ' ORDER BY location) AS zones FROM (SELECT DISTINCT location FROM sta WHERE reconnect_count > 8 ORDER BY location LIMIT 2) z) z"""
ORACLES["priority_actions"] = over("tel sta", f"""
SELECT 1 AS position, 'P1 — Critical' AS priority, printf('Bring %s (%s) back: %d reconnects, %d messages queued, now %s', w.device_id, w.location,
 w.reconnect_count, w.queue_depth, w.connection_status) AS action, 'Network / IT' AS owner, 'Today' AS timeline FROM {_ALL_FACTS}
UNION ALL SELECT 2, 'P1 — Critical', printf('Check camera cooling at %s: peak %.1f°C', c.locations, k.cam_temp_max), 'Hardware', 'Today' FROM {_ALL_FACTS}
UNION ALL SELECT 3, 'P2 — High', printf('Reconnect %s before their queues overflow: %d messages waiting', n.device_ids, n.total_queue_depth),
 'Network / IT', '< 2 hours' FROM {_ALL_FACTS}
UNION ALL SELECT 4, 'P2 — High', printf('Audit access points at %s: %d devices above 8 reconnects', z.zones, p.devices), 'Network', 'This week' FROM {_ALL_FACTS}
UNION ALL SELECT 5, 'P3 — Medium', printf('Review video load: about %.1f%% CPU on %d cameras', k.cam_cpu, k.camera_count), 'Firmware', 'This sprint' FROM {_ALL_FACTS}
UNION ALL SELECT 6, 'P3 — Medium', 'Raise the queue limit of devices in problem zones', 'DevOps', 'This sprint'""")
ORACLES["findings"] = over("tel sta", f"""
SELECT 0 AS position, 'Executive summary' AS section, printf('%d devices sent %d messages. Availability is %.1f%%, %d devices are unreachable, %d messages wait in offline queues and %d reconnects were seen. %d anomalies were detected (%.2f%% of readings), most of them by the %s class (%d of %d).',
 fleet_size, total_messages, uptime_pct, offline_count, total_queued, total_reconnects, k.anomaly_count, anomaly_rate, l.device_type, l.anomaly_count, k.anomaly_count) AS finding
FROM ({_R}) k, ({_LEADER}) l
UNION ALL SELECT 1, 'Finding 1 — cameras at thermal risk', printf('%d cameras run at %.1f%% CPU and %.1f°C on average, with a peak of %.1f°C, and cause %d%% of critical CPU readings. Hottest places: %s. Inspect within 7 days: %s.',
 camera_count, cam_cpu, cam_temp, cam_temp_max, cam_crit_cpu_pct, c.locations, c.device_ids) FROM {_ALL_FACTS}
UNION ALL SELECT 2, 'Finding 2 — unstable connections', printf('%d of %d devices (%d%%) are offline. %d devices at %d locations reconnected more than 8 times. Worst is %s (%s, %s): %d reconnects, now %s.',
 offline_count, fleet_size, CAST(round_even(offline_count * CAST(100 AS DOUBLE) / fleet_size, 0) AS BIGINT), p.devices, p.places,
 w.device_id, w.device_type, w.location, w.reconnect_count, w.connection_status) FROM {_ALL_FACTS}
UNION ALL SELECT 3, 'Finding 3 — offline queues', printf('%d messages wait in offline queues. Nearest to capacity: %s.', total_queued, n.devices_text) FROM {_ALL_FACTS}
UNION ALL SELECT 4, 'Finding 4 — most stable devices', printf('%s (%s, %s) reconnected %d times. %d devices stayed online with 2 reconnects or fewer.',
 s.device_id, s.device_type, s.location, s.reconnect_count, (SELECT COUNT(*) FROM sta WHERE {_RELIABLE})) FROM ({_STABLE}) s""")
