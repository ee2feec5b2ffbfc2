"""Row-level classes derived from a reading. Shared by batch and stream jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .numeric import known, rnd_even

# Class limits and labels every result depends on.
SIGNAL_CLASSES = [(-60, "Excellent"), (-70, "Good"), (-80, "Fair")]
SIGNAL_FLOOR = "Poor"
TEMP_CLASSES = [(80, "Critical"), (70, "Warning")]
TEMP_FLOOR = "Normal"
CPU_CLASSES = [(85, "Critical"), (70, "High")]
CPU_FLOOR = "Normal"
HIGH_TEMP_LIMIT = 75
POOR_SIGNAL_LIMIT = -75
WEAR_STAGES = [(80, "early"), (170, "mid"), (253, "late")]


def _at_least(x: Column, classes: list[tuple[float, str]], floor: str) -> Column:
    """First class whose limit the value reaches; missing values (null or NaN) get the floor."""
    return F.coalesce(*[F.when(known(x) >= limit, F.lit(label)) for limit, label in classes], F.lit(floor))


def signal_quality(dbm: Column) -> Column:
    return _at_least(dbm, SIGNAL_CLASSES, SIGNAL_FLOOR)


def temp_status(celsius: Column) -> Column:
    return _at_least(celsius, TEMP_CLASSES, TEMP_FLOOR)


def cpu_status(percent: Column) -> Column:
    return _at_least(percent, CPU_CLASSES, CPU_FLOOR)


def uptime_hours(seconds: Column) -> Column:
    return rnd_even(seconds / F.lit(3600.0), 2)


def connection_status(is_connected: Column) -> Column:
    return F.when(is_connected == 1, "Online").otherwise("Offline")


def wear_stage(minutes: Column) -> Column:
    """Closed at 0 below and at each limit above; null outside all stages."""
    stages = [F.when((minutes >= 0) & (minutes <= limit), F.lit(label)) for limit, label in WEAR_STAGES]
    return F.coalesce(*stages)


def flag_text(x: Column) -> Column:
    """'True' in any letter case to boolean; anything else, also null, is false."""
    return F.coalesce(F.lower(x.cast("string")) == "true", F.lit(False))


def time_parts(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    return df.withColumns(
        {
            "hour": F.hour(ts).cast("bigint"),
            "date": F.to_date(ts),
            "weekday": F.date_format(ts, "EEEE"),
        }
    )


def with_reading_classes(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "signal_quality": signal_quality(F.col("signal_dbm")),
            "temp_status": temp_status(F.col("temperature_c")),
            "cpu_status": cpu_status(F.col("cpu_pct")),
        }
    )


def with_status_classes(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "uptime_hours": uptime_hours(F.col("uptime_s")),
            "connection_status": connection_status(F.col("is_connected")),
        }
    )


def simple_thresholds(readings: DataFrame) -> DataFrame:
    """Readings above the plain temperature limit or below the plain signal limit."""
    return readings.agg(
        F.count_if(F.col("temperature_c") > HIGH_TEMP_LIMIT).alias("high_temp_readings"),
        F.count_if(F.col("signal_dbm") < POOR_SIGNAL_LIMIT).alias("poor_signal_readings"),
    )
