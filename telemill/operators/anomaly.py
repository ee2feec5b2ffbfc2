"""Per-device detectors and their consensus.

A detector takes ``(readings, key, features)`` and returns the readings with
its own columns added; further detectors can join the consensus the same way.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import count_true, known_numbers, mean, pct, rnd, rnd_even
from . import table_detectors
from .iforest import isolation_scores
from .joins import attach
from .order_stats import grouped_quantiles

# Features in trigger order, with their display names, and detector settings.
FEATURES = {
    "cpu_pct": "CPU %",
    "ram_pct": "RAM %",
    "temperature_c": "Temperature (°C)",
    "signal_dbm": "Signal (dBm)",
}
KEY = "device_id"
MIN_VALUES = 10
Z_LIMIT = 3.0
FENCE = 1.5
CONTAMINATION = 0.02
CONSENSUS_METHODS = 2
METHODS = {"zscore": "Z-score", "iqr": "IQR", "iforest": "Isolation Forest"}


def validate_features(df: DataFrame, key: str = KEY, features: list[str] = list(FEATURES)) -> None:
    absent = [c for c in (key, *features) if c not in df.columns]
    if absent:
        raise ValueError(f"a detector needs the columns {', '.join(absent)}")


def _readings(df: DataFrame, key: str, features: list[str]) -> DataFrame:
    """Rows with a key; a feature that is NaN is missing, as null is."""
    validate_features(df, key, features)
    return known_numbers(df.filter(F.col(key).isNotNull()), features)


def _first_label(hits: dict[str, Column]) -> Column:
    """Display name of the first feature that hit, else ''."""
    return F.coalesce(*[F.when(hit, F.lit(FEATURES.get(f, f))) for f, hit in hits.items()], F.lit(""))


def zscore(df: DataFrame, key: str = KEY, features: list[str] = list(FEATURES), limit: float = Z_LIMIT) -> DataFrame:
    """Distance from the device's own mean in population deviations, maximum over features.

    A feature with fewer than ten values counts 0; a constant feature counts for nothing.
    """
    df = _readings(df, key, features)
    stats = df.groupBy(key).agg(*[
        x for f in features for x in (
            F.avg(f).alias(f"_{f}_m"), F.stddev_pop(f).alias(f"_{f}_s"), F.count(f).alias(f"_{f}_n"))])
    rows = attach(df, stats, [key])
    z = {
        f: F.when(F.col(f"_{f}_n") < MIN_VALUES, F.lit(0.0)).otherwise(
            F.abs(F.col(f) - F.col(f"_{f}_m")) / F.nullif(F.col(f"_{f}_s"), F.lit(0.0)))
        for f in features
    }
    rows = rows.withColumns({f"_z_{f}": z[f] for f in features})
    top = F.greatest(*[F.col(f"_z_{f}") for f in features]) if len(features) > 1 else F.col(f"_z_{features[0]}")
    rows = rows.withColumn("max_zscore", top)
    rows = rows.withColumn("zscore_anomaly", F.coalesce(F.col("max_zscore") > limit, F.lit(False)))
    hits = {f: F.col("zscore_anomaly") & (F.col(f"_z_{f}") == F.col("max_zscore")) for f in features}
    rows = rows.withColumn("zscore_trigger", _first_label(hits))
    return rows.drop(*[c for f in features for c in (f"_{f}_m", f"_{f}_s", f"_{f}_n", f"_z_{f}")])


def iqr(df: DataFrame, key: str = KEY, features: list[str] = list(FEATURES), fence: float = FENCE) -> DataFrame:
    """Outside the device's own quartile fences in any feature; keeps the fences per feature."""
    df = _readings(df, key, features)
    fences = grouped_quantiles(df, [key], features, [0.25, 0.75])
    for f in features:
        q1, q3 = F.col(f"{f}_q")[0], F.col(f"{f}_q")[1]
        enough = F.col(f"{f}_n") >= MIN_VALUES
        fences = fences.withColumns({
            f"iqr_lo_{f}": F.when(enough, q1 - F.lit(fence) * (q3 - q1)),
            f"iqr_hi_{f}": F.when(enough, q3 + F.lit(fence) * (q3 - q1))})
    fences = fences.select(key, *[c for f in features for c in (f"iqr_lo_{f}", f"iqr_hi_{f}")])
    rows = attach(df, fences, [key])
    out = {
        f: F.coalesce((F.col(f) < F.col(f"iqr_lo_{f}")) | (F.col(f) > F.col(f"iqr_hi_{f}")), F.lit(False))
        for f in features
    }
    rows = rows.withColumn("iqr_anomaly", reduce(lambda a, b: a | b, out.values()))
    return rows.withColumn("iqr_trigger", _first_label(out))


def isolation_forest(df: DataFrame, key: str = KEY, features: list[str] = list(FEATURES), row_id: str = "id",
                     contamination: float = CONTAMINATION, **options) -> DataFrame:
    """Multivariate detector: rows above the device's own (1 - contamination) score quantile."""
    scored = isolation_scores(_readings(df, key, features), key, row_id, features, **options)
    limits = iforest_limits(scored, key, contamination)
    rows = attach(scored, limits, [key])
    flag = F.coalesce(F.col("iforest_score") > F.col("iforest_limit"), F.lit(False))
    return rows.withColumn("iforest_anomaly", flag).drop("iforest_limit")


def iforest_limits(scored: DataFrame, key: str = KEY, contamination: float = CONTAMINATION) -> DataFrame:
    """Per-device score quantile. Scores have six decimals, so a group has at most 10^6 values."""
    return scored.groupBy(key).agg(F.percentile("iforest_score", F.lit(1.0 - contamination)).alias("iforest_limit"))


def consensus(df: DataFrame, methods: list[str] = list(METHODS), needed: int = CONSENSUS_METHODS) -> DataFrame:
    count = reduce(lambda a, b: a + b, [F.col(f"{m}_anomaly").cast("bigint") for m in methods])
    return df.withColumn("method_count", count).withColumn("consensus_anomaly", F.col("method_count") >= needed)


Detector = Callable[[DataFrame], DataFrame]


def detect(df: DataFrame, methods: tuple[str, ...] | Mapping[str, Detector] = tuple(METHODS),
           needed: int = CONSENSUS_METHODS, **options) -> DataFrame:
    """Run detectors one after another on the same rows; no row-level join is needed.

    ``methods`` are names of the detectors here or of table functions (``table_detectors``), or a mapping of names to own
    ones: each takes the readings and adds a boolean column ``<name>_anomaly``.
    """
    built_in = {"zscore": zscore, "iqr": iqr, "iforest": lambda rows: isolation_forest(rows, **options)}
    steps = methods if isinstance(methods, Mapping) else {m: built_in.get(m) or table_detectors.step(m) for m in methods}
    for step in steps.values():
        df = step(df)
    return consensus(df, list(steps), needed)


def summarise(df: DataFrame, methods: list[str] = list(METHODS)) -> DataFrame:
    """Flag counts and load per device; means and maxima rounded half to even."""
    return (
        df.groupBy("device_id", "device_type", "location")
        .agg(
            F.count("cpu_pct").alias("total_readings"),
            *[count_true(f"{m}_anomaly").alias(f"{m}_anomalies") for m in methods],
            count_true("consensus_anomaly").alias("consensus_anomalies"),
            rnd_even(mean("cpu_pct"), 1).alias("avg_cpu"), rnd_even(F.max("cpu_pct"), 1).alias("max_cpu"),
            rnd_even(mean("temperature_c"), 1).alias("avg_temp"), rnd_even(F.max("temperature_c"), 1).alias("max_temp"))
        .orderBy(F.desc("consensus_anomalies"), "device_id")
    )


def method_rates(summary: DataFrame, methods: list[str] = list(METHODS)) -> DataFrame:
    """Fleet-wide share of readings per method, in percent."""
    columns = [*[f"{m}_anomalies" for m in methods], "consensus_anomalies"]
    one = summary.agg(F.sum("total_readings").alias("n"), *[F.sum(c).alias(c) for c in columns])
    rows = F.explode(F.array(*[
        F.struct(F.lit(c.removesuffix("_anomalies")).alias("method"), F.col(c).alias("anomalies")) for c in columns]))
    return one.select("n", rows.alias("r")).select(
        "r.method", "r.anomalies", rnd(pct("r.anomalies", "n"), 2).alias("rate_pct"))


def method_agreement(summary: DataFrame, methods: list[str] = list(METHODS)) -> DataFrame:
    """One row per device and method: flagged share of the device's readings."""
    rows = F.explode(F.array(*[
        F.struct(F.lit(m).alias("method"), F.col(f"{m}_anomalies").alias("anomalies")) for m in methods]))
    return summary.select("device_id", "total_readings", rows.alias("r")).select(
        "device_id", "r.method", rnd(pct("r.anomalies", "total_readings"), 4).alias("rate_pct"))


def consensus_by_type(summary: DataFrame) -> DataFrame:
    return summary.groupBy("device_type").agg(F.sum("consensus_anomalies").alias("consensus_anomalies")).orderBy(
        "consensus_anomalies", "device_type")


def top_consensus(detected: DataFrame, by: str = "iforest_score", top: int = 10) -> DataFrame:
    return (
        detected.filter("consensus_anomaly").orderBy(F.desc_nulls_last(by), "device_id", "timestamp").limit(top)
        .select("timestamp", "device_id", "location", "cpu_pct", "temperature_c", "signal_dbm", "max_zscore", by)
    )


REPORT_COLUMNS = [
    "timestamp", "device_id", "device_type", "location", "cpu_pct", "ram_pct", "temperature_c", "signal_dbm",
    "zscore_anomaly", "max_zscore", "zscore_trigger", "iqr_anomaly", "iqr_trigger",
    "iforest_anomaly", "iforest_score", "method_count", "consensus_anomaly",
]


def report(detected: DataFrame) -> DataFrame:
    return detected.select(*[c for c in REPORT_COLUMNS if c in detected.columns])


def top_device(detected: DataFrame) -> DataFrame:
    """The device with most consensus anomalies, ties by id: one row."""
    counts = detected.groupBy("device_id").agg(count_true("consensus_anomaly").alias("n"))
    return counts.orderBy(F.desc("n"), "device_id").limit(1).select("device_id")


def top_device_series(detected: DataFrame) -> DataFrame:
    """Ordered readings, flags and temperature fences of the top device.

    The one device id reaches the scan as a literal, so the filter is pushed down.
    """
    first = top_device(detected).first()
    chosen = detected.filter(F.col("device_id") == F.lit(first["device_id"] if first else None))
    columns = ["device_id", "timestamp", "cpu_pct", "temperature_c", "iqr_lo_temperature_c", "iqr_hi_temperature_c",
               "zscore_anomaly", "iqr_anomaly", "iforest_anomaly", "iforest_score", "consensus_anomaly"]
    return chosen.select(*[c for c in columns if c in detected.columns]).orderBy("timestamp")


def iforest_threshold(detected: DataFrame) -> DataFrame:
    """98th percentile of the top device's scores and its rows at or above it."""
    first = top_device(detected).first()
    chosen = detected.filter(F.col("device_id") == F.lit(first["device_id"] if first else None))
    limit = iforest_limits(chosen)
    return chosen.join(F.broadcast(limit), "device_id").groupBy("device_id").agg(
        F.max("iforest_limit").alias("threshold"),
        count_true(F.col("iforest_score") >= F.col("iforest_limit")).alias("readings_at_or_above"))
