"""Query suites over a folder of CSV tables: one result file per query, failures kept apart.

    python -m telemill.plans.suite DATA_DIR OUTPUT_DIR [all|fleet|machines|anomalies|report|export]
"""

from __future__ import annotations

import functools
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import anomaly
from ..session import apply_conf
from ..sources import csv_tables as C
from ..sources.bindings import latest_per_device
from ..sources.points import surrogate_id
from . import fleet, kpis, machine, report


class Tables:
    """The CSV tables of a folder, each read when a query first asks for it."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    @functools.cached_property
    def telemetry(self) -> DataFrame:
        rows = C.load_telemetry_csv(self.spark, f"{self.folder}/telemetry.csv")
        return surrogate_id(rows, ["timestamp", "device_id"], out="id")

    @functools.cached_property
    def status(self) -> DataFrame:
        path = f"{self.folder}/status.csv"
        if C.STATUS_NAMES["timestamp"] in self.spark.read.option("header", True).csv(path).columns:
            return latest_per_device(C.load_snapshots_csv(self.spark, path)).drop("timestamp")
        rows = C.load_status_csv(self.spark, path)
        if not rows.groupBy("device_id").count().filter("count > 1").isEmpty():
            raise ValueError("several status rows of a device and no time to tell the latest")
        return rows

    @functools.cached_property
    def events(self) -> DataFrame:
        return C.load_events_csv(self.spark, f"{self.folder}/events.csv")

    @functools.cached_property
    def machines(self) -> DataFrame:
        return C.load_machines_csv(self.spark, f"{self.folder}/machines.csv")

    @functools.cached_property
    def facts(self) -> DataFrame:
        return report.device_facts(self.telemetry)

    @functools.cached_property
    def report_row(self) -> DataFrame:
        return report.report_facts(self.facts, self.status)

    @functools.cached_property
    def detected(self) -> DataFrame:
        return anomaly.detect(self.telemetry)


SUITES: dict[str, dict[str, Callable[[Tables], DataFrame]]] = {
    "fleet": {
        "1.1_fleet_health_summary": lambda t: fleet.fleet_health(t.telemetry, t.status),
        "1.2_per_device_summary": lambda t: fleet.device_summary(t.telemetry, t.status),
        "1.3_cpu_ranking": lambda t: fleet.cpu_ranking(t.telemetry),
        "1.4_hourly_patterns": lambda t: fleet.hourly_patterns(t.telemetry),
        "1.5_anomaly_by_location": lambda t: fleet.anomaly_by_location(t.telemetry),
        "1.6_signal_pivot": lambda t: fleet.signal_pivot(t.telemetry),
        "1.7_running_counts": lambda t: fleet.running_counts(t.telemetry),
        "1.8_spike_detection": lambda t: fleet.spikes(t.telemetry),
        "1.9_reliability_tiers": lambda t: fleet.reliability(t.telemetry, t.status),
        "1.10_above_average_reconnects": lambda t: fleet.above_average_reconnects(t.status),
    },
    "machines": {
        "2.1_failure_by_type": lambda t: machine.failure_by_type(t.machines),
        "2.2_failure_modes": lambda t: machine.failure_modes(t.machines),
        "2.3_wear_stage_risk": lambda t: machine.wear_stage_risk(t.machines),
        "2.4_operating_envelope": lambda t: machine.envelope(t.machines),
        "2.5_torque_deciles": lambda t: machine.torque_deciles(t.machines),
        "2.6_risk_ranking": lambda t: machine.risk_ranking(t.machines),
        "2.7_rolling_failure_rate": lambda t: machine.rolling_failure_rate(t.machines),
    },
    "anomalies": {
        "anomaly_report": lambda t: anomaly.report(t.detected),
        "anomaly_summary": lambda t: anomaly.summarise(t.detected),
    },
    "report": {
        "kpis": lambda t: report.report_kpis(t.facts, t.status),
        "findings": lambda t: report.findings(t.report_row),
        "priority_actions": lambda t: report.priority_actions(t.report_row),
    },
    "export": {
        "summary": lambda t: C.bi_rename(kpis.device_kpis(t.telemetry, t.status), C.SUMMARY_NAMES),
    },
}


def run_suite(spark: SparkSession, folder: str, output: str, which: str = "all") -> dict[str, str]:
    """Write ``output/<query>`` for each query of a suite; returns 'ok' or the error per query."""
    apply_conf(spark)
    tables, outcome = Tables(spark, folder), {}
    for suite in SUITES if which == "all" else [which]:
        for name, job in SUITES[suite].items():
            try:
                C.write_csv(job(tables), f"{output.rstrip('/')}/{name}")
                outcome[name] = "ok"
            except Exception as error:  # one query's missing table must not stop the others
                outcome[name] = f"{type(error).__name__}: {str(error).splitlines()[0]}"
    return outcome


if __name__ == "__main__":
    session = SparkSession.builder.appName("telemill").getOrCreate()
    for query, result in run_suite(session, *sys.argv[1:4]).items():
        print(f"{query:32s} {result}")
