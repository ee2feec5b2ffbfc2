"""Points as long and wide tables, time ranges, result tables and dense ids."""

from __future__ import annotations

import datetime
import functools
import math

from pyspark.sql import DataFrame, functions as F

from ..operators.ordered import ROWS_PER_SLICE, number_rows, slice_by_order

TELEMETRY_KEYS = ["timestamp", "device_id", "device_type", "location", "is_anomaly"]
TELEMETRY_FIELDS = ["cpu_pct", "ram_pct", "temperature_c", "signal_dbm", "uptime_s"]


def range_scan(df: DataFrame, hours: int = 6, ts: str = "timestamp",
               as_of: datetime.datetime | None = None) -> DataFrame:
    """Rows of the last ``hours`` hours before ``as_of``, by default the newest row's time.

    The limit is a literal, so it prunes date partitions and row groups.
    """
    if as_of is None:
        as_of = df.agg(F.max(ts)).first()[0]
    if as_of is None:
        return df.limit(0)
    return df.filter(F.col(ts) >= F.lit(as_of - datetime.timedelta(hours=hours)).cast(df.schema[ts].dataType))


def unpivot_fields(df: DataFrame, keys: list[str] = TELEMETRY_KEYS, fields: list[str] = TELEMETRY_FIELDS) -> DataFrame:
    """One row per field of a point."""
    wide = df.select(*keys, *[F.col(f).cast("double").alias(f) for f in fields])
    return wide.unpivot(keys, fields, "field", "value")


def pivot_fields(df: DataFrame, keys: list[str] = TELEMETRY_KEYS, fields: list[str] = TELEMETRY_FIELDS) -> DataFrame:
    """One row per point from one row per field; the field list is explicit, so one pass suffices."""
    return df.groupBy(*keys).pivot("field", fields).agg(F.first("value"))


def normalise_result(tables: list[DataFrame]) -> DataFrame:
    """Union of result tables without bookkeeping columns, ``_time`` as a zone-free timestamp."""
    def plain(df: DataFrame) -> DataFrame:
        kept = ("_time", "_value", "_field", "_measurement")
        internal = [c for c in df.columns
                    if c.startswith("result") or c == "table" or (c.startswith("_") and c not in kept)]
        df = df.drop(*internal)
        if "_time" in df.columns:
            df = df.withColumn("_time", F.col("_time").cast("timestamp_ntz")).withColumnRenamed("_time", "timestamp")
        return df

    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [plain(t) for t in tables])


def surrogate_id(df: DataFrame, order: list[str], rows: int = ROWS_PER_SLICE, out: str = "surrogate_id") -> DataFrame:
    """Dense 1-based ids in the given order, which should tell all rows apart."""
    slices = max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(df.count() / rows))
    return number_rows(slice_by_order(df, order, slices), order, ["slice"], out=out).drop("slice")


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
              for name, df in tables.items()]
    return functools.reduce(DataFrame.unionByName, counts)
