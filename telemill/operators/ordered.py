"""Ordered operations over a whole table, or over groups of any size.

A window without a partition key, or with one hot key, would run in one task.
Here rows are cut into slices along the order key, the window runs inside each
slice, and one summary row per slice carries counts or values across borders.
Where the borders lie never changes a result, only the balance of the tasks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import checkpointed, written

ROWS_PER_SLICE = 1_000_000
BORDERS = 2047


def range_of(df: DataFrame, order: str) -> tuple:
    """Row count and the ``BORDERS`` quantiles of an order key; reads that one column."""
    parts = [i / (BORDERS + 1) for i in range(1, BORDERS + 1)]
    borders = F.percentile_approx(order, parts, 10 * BORDERS)
    return tuple(df.agg(F.count(F.lit(1)), borders).first())


def _borders_up_to(x: Column, borders: list) -> Column:
    """How many of the sorted borders a value reaches: a binary search, one comparison per halving."""
    step = 1 << max(len(borders).bit_length() - 1, 0)
    steps = []
    while step:
        steps.append(step)
        step >>= 1
    listed = F.array(*[F.lit(b) for b in borders])
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]), F.lit(0),
        lambda at, s: F.when((at + s <= len(borders)) & (F.get(listed, at + s - 1) <= x), at + s).otherwise(at))


def slice_by_range(df: DataFrame, order: str, rows: int = ROWS_PER_SLICE, name: str = "slice",
                   extent: tuple | None = None) -> DataFrame:
    """Add a slice number that grows with a numeric order key (nulls first).

    Borders are quantiles of the key, so a far outlier leaves the slices even;
    rows without a key are spread over slices below zero by a hash of the row.
    ``extent`` is ``range_of`` the source, given where ``df`` is costly to compute.
    """
    n, quantiles = extent or range_of(df, order)
    parallelism = df.sparkSession.sparkContext.defaultParallelism
    slices = max(parallelism, math.ceil(n / rows))
    quantiles = quantiles or []
    every = max(1, len(quantiles) // slices)
    borders = sorted(set(quantiles[every - 1::every]))
    without = -1 - F.pmod(F.xxhash64(*df.columns), F.lit(slices))
    number = _borders_up_to(F.col(order), borders) if borders else F.lit(0)
    return df.withColumn(name, F.when(F.col(order).isNull(), without).otherwise(number).cast("bigint"))


def slice_by_order(df: DataFrame, order: list[str], slices: int, name: str = "slice") -> DataFrame:
    """Cut rows into ranges of a composite order, whatever its types and ties.

    Spark samples the borders, so the cut is kept on shared storage: computed
    anew it could fall elsewhere.
    """
    ranged = df.repartitionByRange(slices, *order)
    return written(ranged.withColumn(name, F.spark_partition_id().cast("bigint")), "sliced")


def slice_hot_groups(df: DataFrame, key: str, order: list[str], rows: int = ROWS_PER_SLICE,
                     name: str = "slice") -> tuple[DataFrame, bool]:
    """Cut groups of more than ``rows`` rows into ranges of ``order``; others stay in slice 0.

    Returns the frame and whether any group had to be cut; if none had, a
    plain window per group is balanced enough and the frame is unchanged.
    At most total/rows groups can be hot, so that list is safe to broadcast.
    Ranges over the whole order also split rows that share one time stamp.
    """
    hot = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > rows)
    hot_rows = hot.agg(F.sum("_n")).first()[0]
    if not hot_rows:
        return df, False
    hot = F.broadcast(checkpointed(hot.select(key)))
    slices = max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(hot_rows / rows))
    cut = slice_by_order(df.join(hot, key, "left_semi"), [key, *order], slices, name)
    rest = df.join(hot, key, "left_anti").withColumn(name, F.lit(0).cast("bigint"))
    return rest.unionByName(cut), True


def _totals_before(totals: DataFrame, keys: list[str], slices: list[Column], column: str, out: str) -> DataFrame:
    before = Window.partitionBy(*keys).orderBy(*slices).rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumn(out, F.coalesce(F.sum(column).over(before), F.lit(0)))


def number_rows(df: DataFrame, order: list[str | Column], slices: list[str], keys: list[str] | None = None,
                slice_order: list[Column] | None = None, weight: str | None = None, out: str = "rn") -> DataFrame:
    """Exact 1-based row numbers (or running sums of ``weight``) per key.

    Rows of one slice must be next to each other in the wanted order. The join
    with the slice totals uses the partitioning the window already has.
    """
    keys = keys or []
    by = [*keys, *slices]
    weights = F.col(weight) if weight else F.lit(1)
    inside = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    totals = df.groupBy(*by).agg(F.sum(weights).cast("bigint").alias("_rows"))
    offsets = _totals_before(totals, keys, slice_order or [F.col(s) for s in slices], "_rows", "_before")
    local = df.withColumn("_local", F.sum(weights).over(inside).cast("bigint"))
    joined = local.join(offsets.drop("_rows"), by)
    return joined.withColumn(out, F.col("_local") + F.col("_before")).drop("_local", "_before")


def with_halo(df: DataFrame, rn: str, reach: int, keys: list[str] | None = None,
              rows: int = ROWS_PER_SLICE) -> DataFrame:
    """Re-cut numbered rows into equal blocks, each led by the ``reach`` rows before it.

    Frames of up to ``reach`` preceding rows computed per ``block`` are exact on
    the rows with ``halo`` false; the borrowed rows are then dropped.
    """
    size = max(rows, reach)
    at = F.col(rn) - 1
    own = F.floor(at / F.lit(float(size))).cast("bigint")
    both = F.array(own, own + 1)
    targets = F.when(at - own * size >= size - reach, both).otherwise(F.array(own))
    return (
        df.withColumn("_own", own).withColumn("block", F.explode(targets))
        .withColumn("halo", F.col("block") > F.col("_own")).drop("_own")
    )


def block_rows(df: DataFrame, n: int, reach: int, rows: int = ROWS_PER_SLICE) -> int:
    """Block size that keeps every core busy without blocks shorter than the reach."""
    parallelism = df.sparkSession.sparkContext.defaultParallelism
    return max(4 * reach, min(rows, math.ceil(n / parallelism)))


def with_neighbours(df: DataFrame, order: list[str], columns: list[str], weight: str,
                    slices: str = "slice") -> DataFrame:
    """Row positions, and for each column the nearest non-null value on both sides.

    A row stands for ``weight`` equal rows and takes the positions ``_start`` to
    ``_end`` (1-based). Adds ``<c>_prev``, ``<c>_prev_at``, ``<c>_next`` and
    ``<c>_next_at``; a row with a value is its own neighbour. One window pass per
    slice and one summary row per slice give both positions and neighbours.
    """
    up = Window.partitionBy(slices).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    # The backward look is a forward look over the reversed order: a frame that
    # ends at the last row would be evaluated anew for every row.
    down = Window.partitionBy(slices).orderBy(*[F.col(c).desc() for c in order]).rowsBetween(
        Window.unboundedPreceding, 0)
    local = df.withColumn("_end", F.sum(weight).over(up).cast("bigint"))
    local = local.withColumn("_start", F.col("_end") - F.col(weight) + 1)
    at = {c: (F.when(F.col(c).isNotNull(), F.col("_start")), F.when(F.col(c).isNotNull(), F.col("_end"))) for c in columns}
    local = local.withColumns({k: v for c in columns for k, v in {
        f"{c}_prev": F.last(c, ignorenulls=True).over(up), f"{c}_prev_at": F.max(at[c][1]).over(up)}.items()})
    local = local.withColumns({k: v for c in columns for k, v in {
        f"{c}_next": F.last(c, ignorenulls=True).over(down), f"{c}_next_at": F.min(at[c][0]).over(down)}.items()})

    edges = local.groupBy(slices).agg(F.sum(weight).cast("bigint").alias("_rows"), *[
        x for c in columns for x in (
            F.min_by(c, at[c][0]).alias(f"_{c}_first"), F.min(at[c][0]).alias(f"_{c}_first_at"),
            F.max_by(c, at[c][1]).alias(f"_{c}_last"), F.max(at[c][1]).alias(f"_{c}_last_at"))])
    edges = _totals_before(edges, [], [F.col(slices)], "_rows", "_before")
    earlier = Window.orderBy(slices).rowsBetween(Window.unboundedPreceding, -1)
    later = Window.orderBy(F.col(slices).desc()).rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("_before")
    carried = edges.select(slices, "_before", *[
        x for c in columns for x in (
            F.last(f"_{c}_last", True).over(earlier).alias(f"_{c}_prev"),
            F.last(F.col(f"_{c}_last_at") + before, True).over(earlier).alias(f"_{c}_prev_at"),
            F.last(f"_{c}_first", True).over(later).alias(f"_{c}_next"),
            F.last(F.col(f"_{c}_first_at") + before, True).over(later).alias(f"_{c}_next_at"))])
    found = {f"{c}_{side}{tail}": (F.col(f"{c}_{side}{tail}") + before if tail else F.col(f"{c}_{side}{tail}"))
             for c in columns for side in ("prev", "next") for tail in ("", "_at")}
    joined = local.join(carried, slices)
    return joined.withColumns({
        "_start": F.col("_start") + before, "_end": F.col("_end") + before,
        **{k: F.coalesce(v, F.col(f"_{k}")) for k, v in found.items()},
    }).drop("_before", *[f"_{k}" for k in found])


def rank_desc(df: DataFrame, value: str, out: str, keys: list[str] | None = None,
              rows: int = ROWS_PER_SLICE) -> DataFrame:
    """RANK by descending ``value`` (nulls last) over a table of any size.

    Rows are counted per value first, so equal values, however many, are one
    row of the ranking; the counts of higher values are summed and joined back.
    Beyond ``rows`` different values the summing is cut into slices.
    """
    keys = keys or []
    highest = F.desc_nulls_last(value)
    counts = checkpointed(df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n")))
    if counts.count() <= rows:
        upto = F.sum("_n").over(Window.partitionBy(*keys).orderBy(highest).rowsBetween(Window.unboundedPreceding, 0))
        ranked = counts.withColumn("_upto", upto)
    else:
        ranked = number_rows(slice_by_range(counts, value, rows), [highest], ["slice"], keys, [F.desc("slice")], "_n", "_upto")
    ranked = ranked.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col(value).alias("_value"),
                           (F.col("_upto") - F.col("_n") + 1).cast("bigint").alias(out))
    same = F.col(value).eqNullSafe(F.col("_value"))
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return df.join(ranked, same).drop("_value", *[f"_{k}" for k in keys])
