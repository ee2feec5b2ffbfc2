"""Equal-width histograms: one pass for the range, one counting pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.joins import sized


def histograms(df: DataFrame, keys: list[str], value: str, bins: int) -> DataFrame:
    """Per group: every bin with its edges and count, the last bin closed, empty bins included.

    Each group's bins span its own extremes; a group of one value gets bins
    around it. Counts combine before the shuffle, at most bins rows per group.
    """
    rows = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"))
    lo, hi = F.min("_v"), F.max("_v")
    flat = F.when(lo == hi, 0.5).otherwise(0.0)
    spans = sized(rows.groupBy(*keys).agg((lo - flat).alias("_lo"), (hi + flat).alias("_hi"), F.count(F.lit(1)).alias("_n")))
    at = F.floor((F.col("_v") - F.col("_lo")) * F.lit(float(bins)) / (F.col("_hi") - F.col("_lo")))
    joined = rows.join(spans, keys)
    counted = joined.groupBy(*keys, F.least(at, F.lit(bins - 1)).cast("bigint").alias("bin")).agg(
        F.count(F.lit(1)).alias("n"))
    every = spans.withColumn("bin", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(bins - 1).cast("bigint"))))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    return every.join(counted, [*keys, "bin"], "left").select(
        *keys, "bin", (F.col("_lo") + F.col("bin") * width).alias("bin_lo"),
        (F.col("_lo") + (F.col("bin") + 1) * width).alias("bin_hi"),
        F.coalesce("n", F.lit(0).cast("bigint")).alias("n"),
        (F.coalesce("n", F.lit(0)).cast("double") / (F.col("_n").cast("double") * width)).alias("density"))


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    one = histograms(df.withColumn("_all", F.lit(0)), ["_all"], value, bins)
    return one.drop("_all")
