"""Sliced operations against plain windows, at several slice sizes and partition counts."""

import random

import pytest
from pyspark.sql import Window, functions as F

from telemill.operators.ordered import (
    number_rows, rank_desc, slice_by_range, slice_hot_groups, with_halo, with_neighbours)


def numbers(spark, n=3000, parts=5, seed=1):
    rnd = random.Random(seed)
    keys = sorted(rnd.sample(range(n * 7), n))
    data = [(k, rnd.choice("LMH"), float(rnd.randint(0, 50)) if rnd.random() > 0.4 else None) for k in keys]
    # a long run without values, across slice borders
    data = [(k, t, None if n // 3 < i < n // 2 or i < 4 or i > n - 5 else v) for i, (k, t, v) in enumerate(data)]
    rnd.shuffle(data)
    return spark.createDataFrame(data, "udi bigint, kind string, v double").repartition(parts)


@pytest.mark.parametrize("rows,parts", [(100, 1), (333, 7), (10**6, 3)])
def test_row_numbers(spark, rows, parts):
    df = numbers(spark, parts=parts)
    got = number_rows(slice_by_range(df, "udi", rows), ["udi"], ["slice"])
    want = df.withColumn("w", F.row_number().over(Window.orderBy("udi")))
    assert got.join(want, "udi").filter("rn <> w").count() == 0
    assert got.count() == df.count()
    keyed = number_rows(slice_by_range(df, "udi", rows), ["udi"], ["slice"], ["kind"])
    want = df.withColumn("w", F.row_number().over(Window.partitionBy("kind").orderBy("udi")))
    assert keyed.join(want, "udi").filter("rn <> w").count() == 0


@pytest.mark.parametrize("rows", [64, 500, 10**6])
def test_frames_over_halo(spark, rows):
    df = numbers(spark)
    numbered = number_rows(slice_by_range(df, "udi", rows), ["udi"], ["slice"])
    blocks = with_halo(numbered, "rn", 49, rows=rows)
    frame = Window.partitionBy("block").orderBy("rn").rowsBetween(-49, 0)
    got = blocks.withColumn("s", F.sum("v").over(frame)).withColumn("c", F.count(F.lit(1)).over(frame)).filter("not halo")
    plain = Window.orderBy("udi").rowsBetween(-49, 0)
    want = df.withColumn("s2", F.sum("v").over(plain)).withColumn("c2", F.count(F.lit(1)).over(plain))
    assert got.count() == df.count()
    assert got.join(want, "udi").filter("not (s <=> s2) or c <> c2").count() == 0


@pytest.mark.parametrize("rows", [50, 700, 10**6])
def test_neighbours(spark, rows):
    df = numbers(spark).withColumn("copies", (F.col("udi") % 3 + 1).cast("bigint"))
    got = with_neighbours(slice_by_range(df, "udi", rows), ["udi"], ["v"], "copies")
    up = Window.orderBy("udi").rowsBetween(Window.unboundedPreceding, 0)
    down = Window.orderBy(F.desc("udi")).rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("e", F.sum("copies").over(up)).withColumn("s", F.col("e") - F.col("copies") + 1)
    want = want.withColumns({
        "p": F.last("v", True).over(up), "pa": F.max(F.when(F.col("v").isNotNull(), F.col("e"))).over(up),
        "n": F.last("v", True).over(down), "na": F.min(F.when(F.col("v").isNotNull(), F.col("s"))).over(down)})
    both = got.join(want.drop("kind", "v", "copies"), "udi")
    wrong = both.filter("not (_start <=> s and _end <=> e and v_prev <=> p and v_prev_at <=> pa and v_next <=> n and v_next_at <=> na)")
    assert both.count() == df.count() and wrong.count() == 0


@pytest.mark.parametrize("rows", [40, 10**6])
def test_rank_with_ties(spark, rows):
    df = numbers(spark).select("udi", "kind", "v")
    for keys in ([], ["kind"]):
        got = rank_desc(df, "v", "r", keys, rows=rows)
        want = df.withColumn("w", F.rank().over(Window.partitionBy(*keys).orderBy(F.desc_nulls_last("v"))))
        assert got.join(want.select("udi", "w"), "udi").filter("r <> w").count() == 0
        assert got.count() == df.count()


def test_only_hot_groups_are_cut(spark):
    # a third of the hot rows carries one and the same time
    data = [("hot", i, max(i, 300)) for i in range(900)] + [("cold", i, i) for i in range(30)]
    df = spark.createDataFrame(data, "device string, id bigint, s bigint").withColumn("ts", F.timestamp_seconds("s"))
    cut, is_cut = slice_hot_groups(df, "device", ["ts", "id"], rows=100)
    sizes = {(r["device"], r["slice"]): r["count"] for r in cut.groupBy("device", "slice").count().collect()}
    hot = [n for (d, _), n in sizes.items() if d == "hot"]
    assert is_cut and sizes[("cold", 0)] == 30
    assert len(hot) >= 8 and sum(hot) == 900 and max(hot) <= 250
    numbered = number_rows(cut, ["ts", "id"], ["slice"], ["device"])
    want = df.withColumn("w", F.row_number().over(Window.partitionBy("device").orderBy("ts", "id")))
    assert numbered.join(want.select("device", "id", "w"), ["device", "id"]).filter("rn <> w").count() == 0
    assert slice_hot_groups(df, "device", ["ts", "id"], rows=1000)[1] is False


def test_no_row_level_single_partition(spark):
    """Only slice summaries may meet in one task."""
    df = numbers(spark)
    plan = number_rows(slice_by_range(df, "udi", 100), ["udi"], ["slice"])._jdf.queryExecution().executedPlan().toString()
    for i, line in enumerate(plan.splitlines()):
        if "SinglePartition" in line:
            assert "HashAggregate" in plan.splitlines()[i + 1]


def test_slices_stay_even(spark):
    """One far key and half null keys: no slice holds much more than its share."""
    rows = [(i,) for i in range(4000)] + [(10**15,)] + [(None,)] * 4000
    df = spark.createDataFrame(rows, "udi bigint").withColumn("copy", F.monotonically_increasing_id())
    sizes = {r["slice"]: r["count"] for r in slice_by_range(df, "udi", 500).groupBy("slice").count().collect()}
    assert max(sizes.values()) <= 1000 and sum(sizes.values()) == 8001
    numbered = number_rows(slice_by_range(df, "udi", 500), ["udi"], ["slice"])
    assert sorted(r.rn for r in numbered.collect()) == list(range(1, 8002))
    assert numbered.filter(F.col("udi") == 10**15).first().rn == 8001
