"""Machine queries 2.1 to 2.7 over clean readings with features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.numeric import count_true, mean, pct, rnd
from ..operators.order_stats import tile_cutoffs, tile_of
from ..operators.ordered import ROWS_PER_SLICE, block_rows, number_rows, range_of, slice_by_range, with_halo

# Labels and limits of the machine reports.
FAILURE_MODES = {
    "failure_twf": "TWF — Tool Wear Failure",
    "failure_hdf": "HDF — Heat Dissipation Failure",
    "failure_pwf": "PWF — Power Failure",
    "failure_osf": "OSF — Overstrain Failure",
    "failure_rnf": "RNF — Random Failure",
}
TORQUE_BANDS = ["Low (<30 Nm)", "Normal (30–50 Nm)", "High (>50 Nm)"]
SPEED_BANDS = ["Low (<1400 rpm)", "Normal (1400–1700)", "High (>1700 rpm)"]
RISK_ADVICE = [(70, "Immediate attention"), (50, "Schedule maintenance"), (30, "Monitor closely")]
NO_ADVICE = "Normal operation"
WEAR_LIFE = 253.0
RISK_RANKS = 15
TREND_STEP = 50
TREND_FRAMES = (500, 1000)


def _failures() -> Column:
    return count_true("machine_failure")


def failure_by_type(machines: DataFrame) -> DataFrame:
    rate = pct("failure_count", "total_readings")
    risk = F.when(rate > 5, "High risk").when(rate > 2, "Medium risk").otherwise("Low risk")
    return (
        machines.groupBy("machine_type")
        .agg(F.count(F.lit(1)).alias("total_readings"), _failures().alias("failure_count"),
             rnd(mean("torque_nm"), 1).alias("avg_torque_nm"),
             rnd(mean("rotational_speed_rpm"), 0).alias("avg_speed_rpm"),
             rnd(mean("tool_wear_min"), 0).alias("avg_tool_wear_min"))
        .select("machine_type", "total_readings", "failure_count", rnd(rate, 2).alias("failure_rate_pct"),
                "avg_torque_nm", "avg_speed_rpm", "avg_tool_wear_min", risk.alias("risk_category"))
        .orderBy(F.desc("failure_rate_pct"), "machine_type")
    )


def failure_modes(machines: DataFrame) -> DataFrame:
    """All modes from one scan, turned into rows afterwards."""
    one = machines.agg(F.count(F.lit(1)).alias("n"), *[count_true(c).alias(c) for c in FAILURE_MODES])
    rows = F.explode(F.array(*[
        F.struct(F.lit(label).alias("failure_mode"), F.col(c).alias("event_count"))
        for c, label in FAILURE_MODES.items()]))
    return (
        one.select("n", rows.alias("r"))
        .select("r.failure_mode", "r.event_count", rnd(pct("r.event_count", "n"), 3).alias("rate_pct"))
        .orderBy(F.desc("event_count"), "failure_mode")
    )


def wear_stage_risk(machines: DataFrame) -> DataFrame:
    place = F.when(F.col("wear_stage") == "early", 1).when(F.col("wear_stage") == "mid", 2).when(
        F.col("wear_stage") == "late", 3).otherwise(4)
    return (
        machines.groupBy("wear_stage")
        .agg(F.count(F.lit(1)).alias("readings"), _failures().alias("failures"),
             rnd(mean("torque_nm"), 1).alias("avg_torque"), rnd(mean("tool_wear_min"), 0).alias("avg_wear_min"),
             rnd(mean("power_w"), 1).alias("avg_power_w"))
        .select("wear_stage", "readings", "failures", rnd(pct("failures", "readings"), 2).alias("failure_rate_pct"),
                "avg_torque", "avg_wear_min", "avg_power_w")
        .orderBy(place)
    )


def _band(x: Column, low: float, high: float, names: list[str]) -> Column:
    return F.when(x < low, names[0]).when((x >= low) & (x <= high), names[1]).otherwise(names[2])


def envelope(machines: DataFrame) -> DataFrame:
    return (
        machines.groupBy(
            _band(F.col("torque_nm"), 30, 50, TORQUE_BANDS).alias("torque_band"),
            _band(F.col("rotational_speed_rpm"), 1400, 1700, SPEED_BANDS).alias("speed_band"))
        .agg(F.count(F.lit(1)).alias("reading_count"), _failures().alias("failure_count"))
        .withColumn("failure_rate_pct", rnd(pct("failure_count", "reading_count"), 2))
        .orderBy(F.desc("failure_rate_pct"), "torque_band", "speed_band")
    )


def envelope_pivot(machines: DataFrame) -> DataFrame:
    """Failure rate by speed band (rows) and torque band (columns), 0 where empty."""
    return (
        envelope(machines).groupBy("speed_band").pivot("torque_band", TORQUE_BANDS)
        .agg(F.avg("failure_rate_pct")).fillna(0.0)
        .toDF("speed_band", "torque_low", "torque_normal", "torque_high")
        .orderBy("speed_band")
    )


def torque_deciles(machines: DataFrame, tiles: int = 10) -> DataFrame:
    """Failure rate per torque decile, equal torques ordered by udi.

    The nine decile ends are selected exactly; the last pass compares each row
    with them and needs no sort.
    """
    readings = machines.select("udi", "torque_nm", "machine_failure")
    ends = tile_cutoffs(readings, "torque_nm", "udi", tiles)
    return (
        readings.groupBy(tile_of(F.col("torque_nm"), F.col("udi"), ends).alias("torque_decile"))
        .agg(F.count(F.lit(1)).alias("reading_count"), rnd(F.min("torque_nm"), 1).alias("torque_min"),
             rnd(F.max("torque_nm"), 1).alias("torque_max"), _failures().alias("failures"))
        .withColumn("failure_rate_pct", rnd(pct("failures", "reading_count"), 2))
        .orderBy("torque_decile")
    )


def risk_score() -> Column:
    wear = F.col("tool_wear_min") / F.lit(WEAR_LIFE) * F.lit(40.0)
    load = F.when(F.col("torque_nm") > 50, 30).when(F.col("torque_nm") > 40, 15).otherwise(0)
    heat = F.when(F.col("temp_diff_k") < 8.6, 20).otherwise(0)
    # power_w is in kilowatts, so this part always counts; kept as published
    power = F.when((F.col("power_w") > 8000) | (F.col("power_w") < 3500), 10).otherwise(0)
    return rnd(wear + load + heat + power, 1)


def risk_ranking(machines: DataFrame, ranks: int = RISK_RANKS) -> DataFrame:
    """Ranks from the counts of the highest scores, so that equal scores, however many, stay spread.

    A rank of at most ``ranks`` needs no more than the ``ranks`` highest
    different scores; rows are then compared with that short list.
    """
    advice = F.coalesce(*[F.when(F.col("risk_score") >= limit, F.lit(text)) for limit, text in RISK_ADVICE],
                        F.lit(NO_ADVICE))
    scored = machines.filter(~F.col("machine_failure")).withColumn("risk_score", risk_score())
    highest = scored.groupBy(F.col("risk_score").alias("score")).agg(F.count(F.lit(1)).alias("n")).orderBy(
        F.desc_nulls_last("score")).limit(ranks)
    above = Window.orderBy(F.desc_nulls_last("score")).rowsBetween(Window.unboundedPreceding, -1)
    places = highest.select("score", (F.coalesce(F.sum("n").over(above), F.lit(0)) + 1).alias("risk_rank")).filter(
        F.col("risk_rank") <= ranks)
    return (
        scored.select("udi", "product_id", "machine_type", "tool_wear_min", "torque_nm", "power_w", "temp_diff_k", "risk_score")
        .join(F.broadcast(places), F.col("risk_score").eqNullSafe(F.col("score")))  # at most ``ranks`` rows
        .select(F.col("risk_rank").cast("bigint").alias("risk_rank"), "udi", "product_id", "machine_type", "tool_wear_min",
                rnd("torque_nm", 1).alias("torque_nm"), rnd("power_w", 0).alias("power_w"),
                rnd("temp_diff_k", 1).alias("temp_diff_k"), "risk_score", advice.alias("recommendation"))
        .orderBy("risk_rank", "udi")
    )


def cumulative_high_wear(machines: DataFrame, rows: int = ROWS_PER_SLICE) -> DataFrame:
    """How many running machines of the type are worn at least as much, ties by udi.

    Three types would mean three tasks; rows are numbered per (type, wear, udi
    slice) and the slices' totals are added up.
    """
    running = machines.filter(~F.col("machine_failure")).select("udi", "machine_type", "tool_wear_min")
    sliced = slice_by_range(running, "udi", rows)
    numbered = number_rows(
        sliced, ["udi"], ["tool_wear_min", "slice"], ["machine_type"],
        slice_order=[F.desc_nulls_last("tool_wear_min"), F.col("slice")], out="cumulative_high_wear")
    return numbered.select("udi", "machine_type", "tool_wear_min", "cumulative_high_wear")


def rolling_failure_rate(machines: DataFrame, step: int = TREND_STEP, frames: tuple[int, ...] = TREND_FRAMES,
                         rows: int = ROWS_PER_SLICE) -> DataFrame:
    """Moving failure rates along udi over every ``step``-th reading.

    The sampling is part of the question and comes before the frames.
    """
    sampled = machines.filter(F.col("udi") % step == 0).select("udi", "machine_failure")
    extent = range_of(sampled, "udi")
    numbered = number_rows(slice_by_range(sampled, "udi", rows, extent=extent), ["udi"], ["slice"])
    reach = max(frames) - 1
    blocks = with_halo(numbered, "rn", reach, rows=block_rows(sampled, extent[0], reach, rows))
    order = Window.partitionBy("block").orderBy("rn")
    # count and sum of 0/1 flags are exact, so the rate is too
    rates = {}
    for frame in frames:
        last = order.rowsBetween(-(frame - 1), 0)
        hits = F.sum(F.col("machine_failure").cast("int")).over(last)
        rates[f"rolling_{frame}_failure_rate_pct"] = rnd(
            hits.cast("double") / F.count(F.lit(1)).over(last).cast("double") * F.lit(100.0), 2)
    return (
        blocks.withColumns(rates).filter(~F.col("halo"))
        .select("udi", "machine_failure", *rates).orderBy("udi")
    )
