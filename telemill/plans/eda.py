"""Profiles, findings and chart datasets of machine readings, before and after cleaning."""

from __future__ import annotations

from decimal import Decimal
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.histogram import histogram, histograms
from ..functions.numeric import count_true, exact_total, known, mean, mean_of, pct, rnd, rnd_even
from ..operators import cleaning
from ..operators.order_stats import quantile_row
from ..session import checkpointed, written

# Columns and bins of the charts.
MODES = {"failure_twf": "TWF", "failure_hdf": "HDF", "failure_pwf": "PWF", "failure_osf": "OSF", "failure_rnf": "RNF"}
CLASS_FEATURES = ["torque_nm", "rotational_speed_rpm", "tool_wear_min", "wear_torque_product"]
CLASS_BINS = 40
AIR_BINS = 80
CORRELATED = ["air_temp_k", "process_temp_k", "rotational_speed_rpm", "torque_nm", "tool_wear_min", "power_w",
              "temp_diff_k", "machine_failure"]
NEW_FEATURES = ["power_w", "temp_diff_k", "wear_torque_product", "speed_torque_product"]
HIGH_RISK_PCT = 5


def profile(df: DataFrame, first_by: str = "udi") -> DataFrame:
    """Type, nulls, distinct values and the first row's value of every column.

    Values are counted per (column, value) first; that combines before the
    shuffle and spreads over all tasks, unlike one distinct count per column.
    """
    types = dict(df.dtypes)
    text = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    counts = text.unpivot([], df.columns, "column_name", "value").groupBy("column_name", "value").agg(
        F.count(F.lit(1)).alias("n"))
    one = counts.groupBy("column_name").agg(
        F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
        F.count("value").alias("unique_values"))
    head = df.orderBy(F.asc_nulls_last(first_by)).limit(1)
    samples = head.select(F.create_map(*[x for c in df.columns for x in (F.lit(c), F.col(c).cast("string"))]).alias("m"))
    dtype = F.create_map(*[F.lit(x) for kv in types.items() for x in kv])
    return one.withColumn("m", samples.scalar()).select(
        "column_name", F.try_element_at(dtype, F.col("column_name")).alias("dtype"), "nulls",
        rnd(pct("nulls", "n"), 2).alias("null_pct"), "unique_values",
        F.try_element_at("m", F.col("column_name")).alias("sample"))


def describe(machines: DataFrame, columns: list[str] = NEW_FEATURES) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles per column, two decimals."""
    one = machines.agg(*[x for c in columns for x in (
        F.count(c).alias(f"{c}_count"), F.avg(c).alias(f"{c}_mean"), F.stddev_samp(c).alias(f"{c}_std"),
        F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"))])
    quartiles = quantile_row(machines, columns, [0.25, 0.5, 0.75])
    def r(x) -> Column:
        return rnd_even(x, 2)
    rows = F.explode(F.array(*[F.struct(
        F.lit(c).alias("column_name"), F.col(f"{c}_count").alias("value_count"), r(f"{c}_mean").alias("mean"),
        r(f"{c}_std").alias("std"), r(f"{c}_min").alias("min"),
        *[r(F.lit(q)).alias(n) for q, n in zip(quartiles[c] or [None] * 3, ("q25", "q50", "q75"))],
        r(f"{c}_max").alias("max")) for c in columns]))
    return one.select(rows.alias("r")).select("r.*")


def rate_by(machines: DataFrame, column: str) -> DataFrame:
    """Mean failure in percent per machine type or wear stage."""
    return (
        machines.filter(F.col(column).isNotNull()).groupBy(column)
        .agg(count_true("machine_failure").alias("failures"), F.count(F.lit(1)).alias("readings"))
        .select(column, pct("failures", "readings").alias("failure_rate_pct")).orderBy(column)
    )


def mode_totals(machines: DataFrame) -> DataFrame:
    one = machines.agg(*[count_true(c).alias(c) for c in MODES])
    rows = F.explode(F.array(*[F.struct(F.lit(label).alias("mode"), F.col(c).alias("events")) for c, label in MODES.items()]))
    return one.select(rows.alias("r")).select("r.*").orderBy("events", "mode")


def key_findings(machines: DataFrame) -> DataFrame:
    """Failure rate overall, by type and stage, the top mode, and the thresholds seen in failures.

    One grouped pass per type and stage feeds all rates; nothing below it grows with the data.
    """
    cells = checkpointed(machines.groupBy("machine_type", "wear_stage").agg(
        F.count(F.lit(1)).alias("n"), count_true("machine_failure").alias("f"),
        *[count_true(c).alias(c) for c in MODES]))
    rate = rnd(pct(F.sum("f"), F.sum("n")), 1)
    overall = cells.agg(rate.alias("value"), F.sum("f").alias("events")).select(
        F.lit("failure_rate").alias("finding"), F.lit("all").alias("item"), "value", "events", F.lit("").alias("note"))
    def by(column: str, finding: str, noted: bool) -> DataFrame:
        full = pct(F.sum("f"), F.sum("n"))
        grouped = cells.filter(F.col(column).isNotNull()).groupBy(column).agg(
            rate.alias("value"), F.sum("f").alias("events"), (full > HIGH_RISK_PCT).alias("high"))
        note = F.when(F.col("high"), "HIGH RISK").otherwise("normal") if noted else F.lit("")
        return grouped.select(F.lit(finding).alias("finding"), F.col(column).alias("item"), "value", "events", note.alias("note"))
    # the first mode in the fixed order wins a tie
    modes = cells.agg(F.array(*[F.struct(F.coalesce(F.sum(c), F.lit(0)).alias("events"), F.lit(-i).alias("order"),
                                         F.lit(label).alias("mode")) for i, (c, label) in enumerate(MODES.items())]).alias("m"))
    top = modes.select(F.array_max("m").alias("t")).select(
        F.lit("top_mode").alias("finding"), F.col("t.mode").alias("item"), F.lit(None).cast("double").alias("value"),
        F.col("t.events").alias("events"), F.lit("").alias("note"))
    failed = machines.filter("machine_failure")
    torque = (quantile_row(failed, ["torque_nm"], [0.75])["torque_nm"] or [None])[0]
    speed = (quantile_row(failed, ["rotational_speed_rpm"], [0.25])["rotational_speed_rpm"] or [None])[0]
    def limit(item: str, value, digits: int) -> DataFrame:
        return cells.agg(F.lit(None).cast("bigint").alias("events")).select(
            F.lit("threshold").alias("finding"), F.lit(item).alias("item"),
            rnd(F.lit(value).cast("double"), digits).alias("value"), "events", F.lit("elevated failure risk").alias("note"))
    parts = [overall, by("machine_type", "rate_by_type", False), top, by("wear_stage", "rate_by_stage", True),
             limit("torque_above", torque, 1), limit("speed_below", speed, 0)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def class_histograms(machines: DataFrame, features: list[str] = CLASS_FEATURES, bins: int = CLASS_BINS) -> DataFrame:
    """Density histograms per feature and outcome, bins spanning each class's own range."""
    wide = machines.select(
        F.when(F.col("machine_failure"), "failure").otherwise("normal").alias("outcome"),
        *[F.col(f).cast("double").alias(f) for f in features])
    long = wide.unpivot(["outcome"], features, "feature", "value")
    return histograms(long, ["feature", "outcome"], "value", bins)


def air_histogram(deduplicated: DataFrame, bins: int = AIR_BINS) -> DataFrame:
    """Air temperature before the unit fix: two humps tell mixed units."""
    return histogram(deduplicated, "air_temp_k", bins).select("bin", "bin_lo", "bin_hi", "n")


MOMENTS = ["x", "y", "xx", "yy", "xy"]


def co_moments(rows: DataFrame, columns: list[str]) -> DataFrame:
    """a, b, n and exact sums of x, y, xx, yy, xy (units of 2^-60) over the rows where both columns are known.

    Each task adds up its own rows, so that a pair sends a row per batch and task, whatever their number.
    """
    pairs = [*combinations(range(len(columns)), 2), *[(i, i) for i in range(len(columns))]]

    def run(batches):
        for batch in batches:
            values = [np.asarray(batch.column(i).fill_null(float("nan"))) for i in range(len(columns))]
            out = {k: [] for k in ("a", "b", "n", *MOMENTS)}
            for i, j in pairs:
                both = ~(np.isnan(values[i]) | np.isnan(values[j]))
                x, y = values[i][both], values[j][both]
                for k, v in zip(("a", "b", "n", *MOMENTS), (columns[i], columns[j], len(x), *[
                        Decimal(exact_total(p)) for p in (x, y, x * x, y * y, x * y)])):
                    out[k].append(v)
            yield pa.RecordBatch.from_pydict(out, schema)

    whole = pa.decimal128(38, 0)
    schema = pa.schema([("a", pa.string()), ("b", pa.string()), ("n", pa.int64()), *[(m, whole) for m in MOMENTS]])
    parts = rows.select(*columns).mapInArrow(run, "a string, b string, n long, " + ", ".join(f"{m} decimal(38,0)" for m in MOMENTS))
    return parts.groupBy("a", "b").agg(*[F.sum(c).alias(c) for c in ("n", *MOMENTS)])


def correlation_matrix(machines: DataFrame, columns: list[str] = CORRELATED) -> DataFrame:
    """Pairwise Pearson correlations, full matrix as rows.

    Readings are centred at the exact means and their products added up exactly, so the order and number of
    partitions change no bit. A pair counts the rows where both are known; null where one of them does not vary.
    """
    wide = machines.select(*[F.col(c).cast("boolean").cast("double").alias(c) if c == "machine_failure"
                             else known(F.col(c).cast("double")).alias(c) for c in columns])
    centre = wide.agg(*[mean(c).alias(c) for c in columns]).first()
    sums = co_moments(wide.select(*[(F.col(c) - F.lit(centre[c] or 0.0)).alias(c) for c in columns]), columns)
    mx, my, mxx, myy, mxy = (mean_of(m, "n") for m in MOMENTS)
    r = (mxy - mx * my) / F.nullif(F.sqrt((mxx - mx * mx) * (myy - my * my)), F.lit(0.0))
    found = sums.select("a", "b", rnd(r, 9).alias("r"))
    other = found.filter("a != b").select(F.col("b").alias("a"), F.col("a").alias("b"), "r")
    return found.unionByName(other).select(F.col("a").alias("x"), F.col("b").alias("y"), "r")


def power_vs_dt_points(machines: DataFrame) -> DataFrame:
    return machines.select("power_w", "temp_diff_k", "machine_failure")


def cleaning_log(raw: DataFrame) -> DataFrame:
    """What each cleaning step found, counted on this data."""
    padded = len(cleaning.header_audit(raw))
    named = cleaning.strip_headers(raw)
    numeric = cleaning.coerce_wear(named)
    nulls = sum((F.when(F.col(c).isNull(), 1).otherwise(0) for c in numeric.columns), F.lit(0))
    text = named.withColumn("_text", F.col("tool_wear_raw"))
    before = cleaning.coerce_wear(text).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(nulls).alias("nulls"),
        count_true(F.col("_text").isNotNull() & F.col("tool_wear_min").isNull()).alias("sentinels")).first()
    unique = written(cleaning.dedup_exact(cleaning.impute(numeric)), "imputed")
    fences = cleaning.clip_fences(unique)
    outside = F.lit(0)
    for c, (lo, hi) in fences.items():
        outside = outside + F.when((F.col(c) < F.lit(lo)) | (F.col(c) > F.lit(hi)), 1).otherwise(0)
    canonical = F.col("type").isin(list(cleaning.TYPE_SPELLINGS))
    contradiction = (F.col("machine_failure") == 0) & (F.greatest(*cleaning.MODES) == 1)
    after = unique.agg(
        F.count(F.lit(1)).alias("rows"), F.sum(outside).alias("clipped"),
        count_true(F.col("air_temp_k") < cleaning.CELSIUS_BELOW).alias("celsius"),
        count_true(F.col("type").isNotNull() & ~canonical).alias("spellings"),
        count_true(contradiction).alias("contradictions")).first()
    log = [
        ("Step 1", "Padded column names", "trimmed", padded),
        ("Step 2", "Text in the tool wear column", "set to null", before["sentinels"]),
        ("Step 3", "Missing sensor values", "filled forward, by type median, interpolated", before["nulls"]),
        ("Step 4", "Resent readings", "copies removed", before["rows"] - after["rows"]),
        ("Step 5", "Celsius among Kelvin", "converted", after["celsius"]),
        ("Step 6", "Impossible speed or torque", "clipped to the fences", after["clipped"]),
        ("Step 7", "Spellings of the type", "normalised to L, M, H", after["spellings"]),
        ("Step 8", "Failure mode without failure", "modes set to 0", after["contradictions"]),
    ]
    return raw.sparkSession.createDataFrame(
        [(a, b, c, int(d or 0)) for a, b, c, d in log], "step string, problem string, effect string, affected bigint")
