"""BI export: points of a time range to display-named tables."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, functions as F

from ..functions import derive
from ..sources import csv_tables as C
from ..sources.points import range_scan
from .kpis import device_kpis

RANGE_HOURS = 6


def export_telemetry(telemetry: DataFrame) -> DataFrame:
    """Readings with time parts and classes under their display names."""
    return C.bi_rename(derive.time_parts(derive.with_reading_classes(telemetry)), C.TELEMETRY_NAMES)


def export_status(snapshots: DataFrame) -> DataFrame:
    named = derive.with_status_classes(snapshots).withColumnRenamed("publish_count", "messages_published")
    return C.bi_rename(named, C.STATUS_NAMES)


def export_events(events: DataFrame) -> DataFrame:
    return C.bi_rename(events, C.EVENT_NAMES)


def export_summary(telemetry: DataFrame, snapshots: DataFrame) -> DataFrame:
    return C.bi_rename(device_kpis(telemetry, snapshots), C.SUMMARY_NAMES)


def export_tables(telemetry: DataFrame, snapshots: DataFrame, events: DataFrame, hours: int | None = RANGE_HOURS,
                  as_of: datetime.datetime | None = None) -> dict[str, DataFrame]:
    """The four tables of one range: all end at ``as_of`` (the newest reading), the summary is of the same rows."""
    if hours is not None:
        as_of = as_of or telemetry.agg(F.max("timestamp")).first()[0]
        if as_of is None:
            telemetry, snapshots, events = (df.limit(0) for df in (telemetry, snapshots, events))
        else:
            telemetry, snapshots = (range_scan(df, hours, as_of=as_of) for df in (telemetry, snapshots))
            events = range_scan(events, hours, ts="event_timestamp", as_of=as_of)
    return {"telemetry": export_telemetry(telemetry), "status": export_status(snapshots),
            "events": export_events(events), "summary": export_summary(telemetry, snapshots)}


def write_export(folder: str, telemetry: DataFrame, snapshots: DataFrame, events: DataFrame,
                 hours: int | None = RANGE_HOURS, as_of: datetime.datetime | None = None) -> dict[str, str]:
    """The four files of the export; an empty range writes nothing."""
    tables = export_tables(telemetry, snapshots, events, hours, as_of)
    if tables["telemetry"].isEmpty():
        return {}
    return {name: C.write_csv(df, f"{folder}/{name}.csv") for name, df in tables.items()}
