"""Cleaning of raw machine readings, step by step, and feature building.

Resent readings are exact copies, and one group of copies may be huge. They
are counted once at the start (``copies``); every later step works on distinct
readings and weighs them, so no group of copies ever meets in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import count_true, pct, rnd
from ..session import written
from ..sources.bindings import with_machine_features
from .joins import attach
from .order_stats import grouped_quantiles, quantile_row
from .ordered import ROWS_PER_SLICE, range_of, slice_by_range, with_neighbours

# Spellings of the machine type, unit and outlier limits.
TYPE_SPELLINGS = {
    "L": ["L", "l", "low", "Low", "LOW"],
    "M": ["M", "m", "med", "MED", "Med", "medium"],
    "H": ["H", "h", "high", "HIGH", "High"],
}
MODES = ["twf", "hdf", "pwf", "osf", "rnf"]
CELSIUS_BELOW = 100
KELVIN_OFFSET = 273.15
MIN_KELVIN = 200
CLIP_FENCE = 3.0
CLIP_FLOOR = 0.0
FILLED_FORWARD = ["air_temp_k", "rotational_speed_rpm"]
CLIPPED = ["rotational_speed_rpm", "torque_nm"]


def strip_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def header_audit(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c != c.strip()]


def coerce_wear(raw: DataFrame, source: str = "tool_wear_raw") -> DataFrame:
    """Text wear to a number; sentinels become null."""
    wear = F.trim(F.col(source)).try_cast("double")
    return raw.withColumn("tool_wear_min", wear).drop(source)


def wear_sentinels(raw: DataFrame, source: str = "tool_wear_raw") -> DataFrame:
    """The texts that are no numbers, how often they occur and their share of all rows."""
    text = F.col(source)
    bad = F.when(text.isNotNull() & F.trim(text).try_cast("double").isNull(), text)
    counts = raw.groupBy(bad.alias("sentinel")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return (
        counts.withColumn("total", total).filter(F.col("sentinel").isNotNull())
        .select("sentinel", F.col("n").alias("readings"), rnd(pct("n", "total"), 2).alias("share_pct"))
    )


def collapse_copies(readings: DataFrame) -> DataFrame:
    """One row per distinct reading with its number of copies, combined before the shuffle."""
    return readings.groupBy(*readings.columns).agg(F.count(F.lit(1)).alias("copies"))


def _columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c != "copies"]


def null_audit(readings: DataFrame) -> DataFrame:
    """Nulls per column, in all readings and in those of failures, for columns that have any."""
    columns = _columns(readings)
    failed = F.col("machine_failure") == 1
    one = readings.agg(*[
        x for c in columns for x in (
            count_true(F.col(c).isNull()).alias(f"{c}_all"), count_true(F.col(c).isNull() & failed).alias(f"{c}_failed"))])
    rows = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"{c}_all").alias("nulls"),
                 F.col(f"{c}_failed").alias("nulls_on_failures")) for c in columns]))
    return one.select(rows.alias("r")).select("r.*").filter("nulls > 0")


def _with_all_neighbours(collapsed: DataFrame, columns: list[str], rows: int, extent: tuple | None) -> DataFrame:
    """Positions and neighbours in udi order; readings of one udi follow each other by content."""
    tie = F.xxhash64(*[F.col(c) for c in _columns(collapsed)])
    cut = slice_by_range(collapsed.withColumn("_tie", tie), "udi", rows, extent=extent)
    return with_neighbours(cut, ["udi", "_tie"], columns, "copies")


def _filled(c: str) -> Column:
    return F.coalesce(F.col(f"{c}_prev"), F.col(f"{c}_next"))


def fill_forward(collapsed: DataFrame, columns: list[str] = FILLED_FORWARD, rows: int = ROWS_PER_SLICE,
                 extent: tuple | None = None) -> DataFrame:
    """Last value before a gap in udi order; a leading gap takes the first value after it."""
    found = _with_all_neighbours(collapsed, columns, rows, extent)
    return found.withColumns({c: _filled(c) for c in columns}).select(*collapsed.columns)


def group_medians(readings: DataFrame, column: str = "torque_nm", group: str = "type") -> DataFrame:
    """Median per group as spelled, over all readings and their copies."""
    known = readings.filter(F.col(group).isNotNull() & F.col(column).isNotNull())
    weight = "copies" if "copies" in readings.columns else None
    medians = grouped_quantiles(known, [group], [column], [0.5], weight=weight, rule="middle")
    return medians.select(group, F.col(f"{column}_q")[0].alias("_median"))


def fill_group_median(collapsed: DataFrame, column: str = "torque_nm", group: str = "type",
                      medians: DataFrame | None = None) -> DataFrame:
    """Null readings take the median of their group; a null group stays null."""
    medians = group_medians(collapsed, column, group) if medians is None else medians
    return attach(collapsed, medians, [group]).withColumn(column, F.coalesce(column, "_median")).select(*collapsed.columns)


def _line(column: str, position: Column) -> Column:
    """Linear between the neighbours by position, last value after the end, null before the start."""
    before, after = F.col(f"{column}_prev"), F.col(f"{column}_next")
    gap = F.nullif(F.col(f"{column}_next_at") - F.col(f"{column}_prev_at"), F.lit(0)).cast("double")
    on_line = before + (after - before) / gap * (position - F.col(f"{column}_prev_at")).cast("double")
    return F.when(F.col(column).isNotNull(), F.col(column)).when(after.isNull(), before).otherwise(on_line)


def _interpolate(found: DataFrame, column: str, keep: list[str]) -> DataFrame:
    """Fill ``column`` from its neighbours and round to whole numbers, half to even.

    Copies of a null reading lie at different positions and may get different
    values. The line is monotone, so each whole number on it covers one stretch
    of positions whose ends are computed, not searched: the number of rows made
    is that of distinct values (or of copies, if those are fewer).
    """
    first, last = F.bround(_line(column, F.col("_start"))), F.bround(_line(column, F.col("_end")))
    values = F.abs(F.col("_last") - F.col("_first")).cast("bigint") + 1
    few = F.col("copies") <= F.col("_values")
    made = F.when(F.col("_values").isNull(), F.lit(1).cast("bigint")).otherwise(F.least("copies", "_values"))
    rows = found.withColumns({"_first": first, "_last": last}).withColumn("_values", values)
    rows = rows.withColumn("_i", F.explode(F.sequence(F.lit(0).cast("bigint"), made - 1)))

    up = F.signum(F.col("_last") - F.col("_first"))
    before, after = F.col(f"{column}_prev"), F.col(f"{column}_next")
    slope = F.abs(after - before) / F.nullif(F.col(f"{column}_next_at") - F.col(f"{column}_prev_at"), F.lit(0)).cast("double")

    def end_of(k: Column) -> Column:
        """Last position whose rounded value has not passed ``k`` in the direction of the line."""
        guess = F.floor(F.col(f"{column}_prev_at") + (up * k + F.lit(0.5) - up * before) / F.nullif(slope, F.lit(0.0)))
        guess = F.greatest(F.least(guess, F.col("_end")), F.col("_start") - 1)
        within = [up * F.bround(_line(column, guess + d)) <= up * k for d in (1, 0)]
        found_end = F.when(within[0], guess + 1).when(within[1], guess).otherwise(guess - 1)
        return F.greatest(F.least(found_end, F.col("_end")), F.col("_start") - 1)

    k = F.col("_first") + up * F.col("_i")
    one_value = F.col("_values").isNull() | (F.col("_values") == 1)
    value = F.when(one_value, F.col("_first")).when(
        few, F.bround(_line(column, F.col("_start") + F.col("_i")))).otherwise(k)
    copies = F.when(one_value, F.col("copies")).when(few, F.lit(1)).otherwise(end_of(k) - end_of(k - up))
    whole = rows.withColumns({"copies": copies.cast("bigint"), column: value.cast("bigint")})
    return whole.groupBy(*keep).agg(F.sum("copies").alias("copies"))


def interpolate(collapsed: DataFrame, column: str = "tool_wear_min", rows: int = ROWS_PER_SLICE,
                extent: tuple | None = None) -> DataFrame:
    return _interpolate(_with_all_neighbours(collapsed, [column], rows, extent), column, _columns(collapsed))


def impute(readings: DataFrame, rows: int = ROWS_PER_SLICE) -> DataFrame:
    """All fills in one pass over the udi slices, plus the medians per type.

    Ends with the regrouping of readings that the fills have made equal.
    """
    extent = range_of(readings, "udi")
    collapsed = fill_group_median(collapse_copies(readings), medians=group_medians(readings))
    found = _with_all_neighbours(collapsed, [*FILLED_FORWARD, "tool_wear_min"], rows, extent)
    found = found.withColumns({c: _filled(c) for c in FILLED_FORWARD})
    return _interpolate(found, "tool_wear_min", _columns(collapsed))


def dedup_exact(counted: DataFrame) -> DataFrame:
    """Keep one of each group of copies; the counting above has done the work."""
    return counted.drop("copies")


def celsius_to_kelvin(readings: DataFrame) -> DataFrame:
    air = F.col("air_temp_k")
    return readings.withColumn("air_temp_k", F.when(air < CELSIUS_BELOW, air + F.lit(KELVIN_OFFSET)).otherwise(air))


def celsius_report(readings: DataFrame) -> DataFrame:
    """Counts of Celsius values before the fix, and the range and check after it."""
    fixed = celsius_to_kelvin(readings.withColumn("_air", F.col("air_temp_k")))
    return fixed.agg(
        count_true(F.col("_air") < CELSIUS_BELOW).alias("air_celsius_rows"),
        count_true(F.col("process_temp_k") < CELSIUS_BELOW).alias("process_celsius_rows"),
        F.min("air_temp_k").alias("air_min_k"), F.max("air_temp_k").alias("air_max_k"),
    ).withColumn("all_kelvin", F.col("air_min_k") > MIN_KELVIN)


def clip_fences(readings: DataFrame, columns: list[str] = CLIPPED) -> dict[str, tuple[float, float]]:
    """Whole-column quartile fences, the lower one not below the physical floor."""
    fences = {}
    for c, quartiles in quantile_row(readings, columns, [0.25, 0.75]).items():
        if quartiles is not None:
            q1, q3 = quartiles
            fences[c] = (max(q1 - CLIP_FENCE * (q3 - q1), CLIP_FLOOR), q3 + CLIP_FENCE * (q3 - q1))
    return fences


def clip_iqr(readings: DataFrame, fences: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    fences = clip_fences(readings) if fences is None else fences
    clipped = {}
    for c, (lo, hi) in fences.items():
        x = F.col(c).cast("double")
        clipped[c] = F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(lo)), F.lit(hi)))
    return readings.withColumns(clipped)


def clip_report(readings: DataFrame) -> DataFrame:
    fences = clip_fences(readings)
    one = readings.agg(*[
        count_true((F.col(c) < F.lit(lo)) | (F.col(c) > F.lit(hi))).alias(c) for c, (lo, hi) in fences.items()])
    rows = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(lo).alias("lower_fence"), F.lit(hi).alias("upper_fence"),
                 F.col(c).alias("clipped")) for c, (lo, hi) in fences.items()]))
    return one.select(rows.alias("r")).select("r.*")


def normalise_type(readings: DataFrame, column: str = "type") -> DataFrame:
    known = [F.when(F.col(column).isin(spellings), F.lit(t)) for t, spellings in TYPE_SPELLINGS.items()]
    return readings.withColumn(column, F.coalesce(*known))


def type_report(readings: DataFrame) -> DataFrame:
    """Each raw spelling, what it becomes and how many readings carry it."""
    counts = readings.groupBy("type").agg(F.count(F.lit(1)).alias("readings")).withColumn("raw_type", F.col("type"))
    return normalise_type(counts).select("raw_type", F.col("type").alias("machine_type"), "readings")


def fix_labels(readings: DataFrame) -> DataFrame:
    """A reading without failure keeps no failure mode."""
    return readings.withColumns({m: F.when(F.col("machine_failure") == 0, 0).otherwise(F.col(m)) for m in MODES})


def label_report(readings: DataFrame) -> DataFrame:
    any_mode = F.greatest(*[F.col(m) for m in MODES]) == 1
    fixed = fix_labels(readings.withColumn("_any", any_mode))
    after = F.greatest(*[F.col(m) for m in MODES]) == 1
    failed = F.col("machine_failure") == 1
    return fixed.agg(
        count_true(~failed & F.col("_any")).alias("contradictions"),
        count_true(~failed & after).alias("contradictions_after"),
        count_true(failed).alias("failures"),
        count_true(failed & ~after).alias("failures_without_mode"))


def to_machines(readings: DataFrame) -> DataFrame:
    """Cleaned readings under the names and types of the machines table, with features."""
    renamed = readings.withColumnRenamed("type", "machine_type").withColumns({
        "machine_failure": F.col("machine_failure").cast("boolean"),
        **{f"failure_{m}": F.col(m).cast("boolean") for m in MODES},
    }).drop(*MODES)
    return with_machine_features(renamed)


def imputed_readings(raw: DataFrame, rows: int = ROWS_PER_SLICE) -> DataFrame:
    """Steps 1 to 4: headers, wear text, fills, copies counted again."""
    return impute(coerce_wear(strip_headers(raw)), rows)


def deduplicated(raw: DataFrame, rows: int = ROWS_PER_SLICE) -> DataFrame:
    """Steps 1 to 4, kept on shared storage: the fences of step 6 need it before the rows do."""
    return written(dedup_exact(imputed_readings(raw, rows)), "cleaned")


def finish(readings: DataFrame) -> DataFrame:
    """Steps 5 to 8 on deduplicated readings, then features."""
    return to_machines(fix_labels(normalise_type(clip_iqr(celsius_to_kelvin(readings)))))


def clean_machines(raw: DataFrame, rows: int = ROWS_PER_SLICE) -> DataFrame:
    return finish(deduplicated(raw, rows))
