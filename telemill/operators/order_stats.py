"""Exact order statistics, quantiles and tiles for groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import checkpointed
from .joins import sized

# Counted quantiles sort one row per distinct value of a group in one task.
# Readings of fixed resolution stay far below this; other columns are refined.
DISTINCT_LIMIT = 1_000_000
# Buckets of about equal counts: their borders are quantiles of a mergeable sketch, so
# outliers and gaps leave them even. Borders only balance tasks, they decide no result.
BUCKETS = 512
BORDER_PROBS = [i / BUCKETS for i in range(1, BUCKETS)]
SKETCH = 10 * BUCKETS
# Border arrays of so many groups at most are sent to all tasks (4 kB a group).
BROADCAST_GROUPS = 10_000

# How a quantile between two readings is computed. All are linear; they differ
# in the last bit, which decides ties when the result is rounded or compared.
RULES = {
    "nearer": lambda lo, hi, part: F.when(part >= 0.5, hi - (hi - lo) * (1 - part)).otherwise(lo + (hi - lo) * part),
    "lower": lambda lo, hi, part: lo + (hi - lo) * part,
    "middle": lambda lo, hi, part: F.when(part == 0, lo).otherwise((lo + hi) / 2),
}


def _bucket(value: Column, borders: Column) -> Column:
    """How many of ``BUCKETS`` - 1 sorted borders a value reaches, by halving."""
    steps = [BUCKETS >> i for i in range(1, BUCKETS.bit_length())]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]), F.lit(0),
        lambda at, s: F.when(F.get(borders, at + s - 1) <= value, at + s).otherwise(at))


def _borders(value: str) -> Column:
    return F.percentile_approx(value, BORDER_PROBS, SKETCH)


def select_ranks(df: DataFrame, value: str, ranks: DataFrame, keys: list[str] | None = None,
                 weight: str | None = None) -> DataFrame:
    """The values at given 0-based ranks within each group, nulls left out.

    ``ranks`` holds ``keys`` and a BIGINT ``rank``; with ``weight`` a row stands for so many equal ones. Returns
    ranks with ``value`` and ``below``, the number of smaller values. A sketch cuts each group at borders of
    about equal counts; two counting passes follow, over all buckets first, then only over those that hold a
    wanted rank. All three combine before the shuffle, so a hot group or a hot value costs no more than any
    other, and an outlier does not crowd the rest into one bucket.
    """
    keys = keys or []
    n = F.sum("_w") if weight else F.count(F.lit(1))
    rows = df.select(*keys, F.col(value).alias("_v"), *([F.col(weight).alias("_w")] if weight else [])).filter(
        F.col("_v").isNotNull())
    if not keys:
        rows, ranks = rows.withColumn("_g", F.lit(0)), ranks.withColumn("_g", F.lit(0))
        keys = ["_g"]
    asked = ranks.select(*keys).distinct()
    bounds = sized(rows.groupBy(*keys).agg(_borders("_v").alias("_at")).join(asked, keys, "left_semi"), BROADCAST_GROUPS)
    bucketed = rows.join(bounds, keys).withColumn("_b", _bucket(F.col("_v"), F.col("_at"))).drop("_at")

    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    counts = bucketed.groupBy(*keys, "_b").agg(n.alias("_n"))
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    wanted = sized(
        counts.join(ranks, keys)
        .filter((F.col("rank") >= F.col("_before")) & (F.col("rank") < F.col("_before") + F.col("_n")))
        .drop("_n"))

    inside = bucketed.join(wanted.select(*keys, "_b").distinct(), [*keys, "_b"], "left_semi")
    smaller = Window.partitionBy(*keys, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    values = inside.groupBy(*keys, "_b", "_v").agg(n.alias("_n"))
    values = values.withColumn("_smaller", F.coalesce(F.sum("_n").over(smaller), F.lit(0)))
    at = F.col("rank") - F.col("_before")
    hit = values.join(wanted, [*keys, "_b"]).filter(
        (at >= F.col("_smaller")) & (at < F.col("_smaller") + F.col("_n")))
    return hit.select(
        *[k for k in keys if k != "_g"], "rank", F.col("_v").alias("value"),
        (F.col("_before") + F.col("_smaller")).alias("below"))


def _refined(df: DataFrame, keys: list[str], column: str, probs: list[float], rule: str, weight: str | None) -> DataFrame:
    """Linearly interpolated quantiles of one column through ``select_ranks``."""
    n = F.sum(F.when(F.col(column).isNotNull(), F.col(weight))) if weight else F.count(column)
    sizes = df.groupBy(*keys).agg(n.alias("_n")).filter("_n > 0")
    at = sizes.withColumn("_p", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
    at = checkpointed(at.withColumn("_at", F.col("_p") * (F.col("_n") - 1)))
    ranks = at.select(*keys, F.explode(F.array(F.floor("_at"), F.ceil("_at"))).alias("rank")).distinct()
    found = checkpointed(select_ranks(df, column, ranks, keys, weight).select(*keys, "rank", "value"))
    on = [*keys, "rank"]
    low = at.withColumn("rank", F.floor("_at")).join(found, on).withColumnRenamed("value", "_a").drop("rank")
    both = low.withColumn("rank", F.ceil("_at")).join(found, on)
    part = F.col("_at") - F.floor("_at")
    value = RULES[rule](F.col("_a"), F.col("value"), part)
    picks = [F.max(F.when(F.col("_p") == F.lit(float(p)), value)) for p in probs]
    return both.groupBy(*keys).agg(F.array(*picks).alias(f"{column}_q"), F.max("_n").alias(f"{column}_n"))


def _counted(df: DataFrame, keys: list[str], columns: list[str], probs: list[float], rule: str,
             weight: str | None) -> DataFrame:
    """Quantiles from counts per distinct value: combined before the shuffle, then one running sum per group."""
    n = F.sum(weight) if weight else F.count(F.lit(1))
    wide = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns], *([weight] if weight else []))
    long = wide.unpivot([*keys, *([weight] if weight else [])], columns, "_c", "_v").filter(F.col("_v").isNotNull())
    counts = long.groupBy(*keys, "_c", "_v").agg(n.alias("_n"))
    group = Window.partitionBy(*keys, "_c")
    upto = F.sum("_n").over(group.orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    placed = counts.withColumn("_upto", upto).withColumn("_total", F.sum("_n").over(group))

    def at(rank: Column) -> Column:
        inside = (rank >= F.col("_upto") - F.col("_n")) & (rank < F.col("_upto"))
        return F.max(F.when(inside, F.col("_v")))

    places = [F.lit(float(p)) * (F.col("_total") - 1) for p in probs]
    picks = placed.groupBy(*keys, "_c").agg(
        F.max("_total").alias("_total"), F.array(*[at(F.floor(p)) for p in places]).alias("_lo"),
        F.array(*[at(F.ceil(p)) for p in places]).alias("_hi"))
    values = F.array(*[RULES[rule](F.col("_lo")[i], F.col("_hi")[i], p - F.floor(p)) for i, p in enumerate(places)])
    picks = picks.select(*keys, "_c", "_total", values.alias("_q"))
    return picks.groupBy(*keys).agg(*[x for c in columns for x in (
        F.max(F.when(F.col("_c") == c, F.col("_q"))).alias(f"{c}_q"),
        F.coalesce(F.max(F.when(F.col("_c") == c, F.col("_total"))), F.lit(0)).alias(f"{c}_n"))])


def grouped_quantiles(df: DataFrame, keys: list[str], columns: list[str], probs: list[float],
                      max_distinct: int = DISTINCT_LIMIT, weight: str | None = None,
                      rule: str = "nearer") -> DataFrame:
    """Exact linearly interpolated quantiles per group, and the number of values behind them.

    Adds per column ``<column>_q``, an array along ``probs``, and ``<column>_n``. If a
    group holds more than ``max_distinct`` rows, a sketch of its distinct values
    decides for each column between counting values and the refinement above,
    which never sorts a group in one task. ``weight`` names a column of row
    multiplicities. ``keys`` must not be null; a group without any value is left out.
    """
    small = columns
    if (df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0) > max_distinct:
        sketch = df.groupBy(*keys).agg(*[F.approx_count_distinct(c, 0.05).alias(c) for c in columns])
        most = sketch.agg(*[F.max(c).alias(c) for c in columns]).first()
        small = [c for c in columns if most[c] <= max_distinct]
    out = _counted(df, keys, small, probs, rule, weight) if small else None
    for c in columns:
        if c not in small:
            refined = _refined(df, keys, c, probs, rule, weight)
            out = refined if out is None else out.join(refined, keys, "full")
    return out.select(*keys, *[x for c in columns for x in (f"{c}_q", f"{c}_n")])


def quantile_row(df: DataFrame, columns: list[str], probs: list[float],
                 max_distinct: int = DISTINCT_LIMIT) -> dict[str, list[float]]:
    """Whole-column quantiles, brought to the driver as a few numbers; None for an empty column."""
    with_key = df.select(F.lit(0).alias("_all"), *columns)
    row = grouped_quantiles(with_key, ["_all"], columns, probs, max_distinct).first()
    return {c: list(row[f"{c}_q"]) if row and row[f"{c}_q"] is not None else None for c in columns}


def pick_ranks(df: DataFrame, value: str, wanted: dict, borders: list, key: str | None = None) -> dict:
    """Values at 0-based ranks of a few groups: ``{(group, rank): (value, smaller values)}``.

    Like ``select_ranks`` for groups and ranks known on the driver, which sees
    at most ``BUCKETS`` counts per group and one row per rank. ``borders`` are quantiles of the column.
    """
    group = F.col(key) if key else F.lit(0)
    rows = df.select(group.alias("_g"), F.col(value).alias("_v")).filter(
        F.col("_v").isNotNull() & F.col("_g").isin(list(wanted)))
    bucketed = rows.withColumn("_b", _bucket(F.col("_v"), F.array(*[F.lit(b) for b in borders])))
    before: dict = {}
    hits = []
    for g, b, n in sorted(bucketed.groupBy("_g", "_b").agg(F.count(F.lit(1)).alias("n")).collect()):
        start = before.get(g, 0)
        hits += [(g, b, start, r) for r in wanted[g] if start <= r < start + n]
        before[g] = start + n
    if not hits:
        return {}
    chosen = F.lit(False)
    for g, b in {(g, b) for g, b, _, _ in hits}:
        chosen = chosen | ((F.col("_g") == F.lit(g)) & (F.col("_b") == F.lit(b)))
    upto = Window.partitionBy("_g", "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    values = bucketed.filter(chosen).groupBy("_g", "_b", "_v").agg(F.count(F.lit(1)).alias("_n"))
    values = values.withColumn("_upto", F.sum("_n").over(upto))
    found = {}
    for g, b, start, rank in hits:
        here = (F.col("_g") == F.lit(g)) & (F.col("_b") == F.lit(b))
        inside = (F.lit(rank - start) >= F.col("_upto") - F.col("_n")) & (F.lit(rank - start) < F.col("_upto"))
        found[(g, rank)] = (here & inside, start)
    marks = F.filter(F.array(*[
        F.when(cond, F.struct(F.lit(i).alias("i"), F.col("_v").alias("v"), (F.col("_upto") - F.col("_n")).alias("s")))
        for i, (cond, _) in enumerate(found.values())]), lambda x: x.isNotNull())
    picked = {r["h"]["i"]: (r["h"]["v"], r["h"]["s"]) for r in values.select(F.explode(marks).alias("h")).collect()}
    return {k: (picked[i][0], start + picked[i][1]) for i, (k, (_, start)) in enumerate(found.items())}


def tile_cutoffs(df: DataFrame, value: str, tie: str, tiles: int) -> list[tuple]:
    """Last (value, tie) of each tile but the final one, in the order (value, tie), nulls last.

    Tiles follow NTILE: sizes differ by at most one, larger tiles first. ``tie``
    must tell rows of equal ``value`` apart. Values hold the ends first; the rows
    of those few values are then looked at along ``tie``.
    """
    n, known, by_value, by_tie = df.agg(F.count(F.lit(1)), F.count(value), _borders(value), _borders(tie)).first()
    base, extra = divmod(n, tiles)
    ends = sorted({(i + 1) * base + min(i + 1, extra) - 1 for i in range(tiles - 1)})
    ends = [e for e in ends if 0 <= e < n - 1]
    among_values, among_nulls = [e for e in ends if e < known], [e - known for e in ends if e >= known]
    cutoffs = []
    if among_values:
        within: dict = {}
        for (_, rank), (v, below) in pick_ranks(df, value, {0: among_values}, by_value).items():
            within.setdefault(v, []).append(rank - below)
        cutoffs = sorted((v, t) for (v, _), (t, _) in pick_ranks(df, tie, within, by_tie, value).items())
    if among_nulls:
        blank = df.filter(F.col(value).isNull())
        cutoffs += [(None, t) for t, _ in sorted(pick_ranks(blank, tie, {0: among_nulls}, by_tie).values())]
    return cutoffs


def tile_of(value: Column, tie: Column, cutoffs: list[tuple]) -> Column:
    """1-based tile of a row: one more than the number of cutoffs before it."""
    tile = F.lit(1).cast("bigint")
    for v, t in cutoffs:
        if v is None:
            after = value.isNull() & (tie > F.lit(t))
        else:
            after = value.isNull() | (value > F.lit(v)) | ((value == F.lit(v)) & (tie > F.lit(t)))
        tile = tile + F.when(after, 1).otherwise(0)
    return tile.cast("bigint")
