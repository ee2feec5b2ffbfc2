import random

import numpy as np
import pytest
from pyspark.sql import Window, functions as F

from telemill.operators import order_stats as O
from telemill.operators.order_stats import grouped_quantiles, quantile_row, select_ranks, tile_cutoffs, tile_of


def frame(spark, digits, n=1500):
    rnd = random.Random(3)
    data = [("hot" if i % 3 == 0 else f"d{i % 7}", round(rnd.lognormvariate(2, 2), digits) if rnd.random() > 0.05 else None)
            for i in range(n)] + [("empty", None), ("one", 4.5), ("same", 2.0), ("same", 2.0)]
    return data, spark.createDataFrame(data, "k string, x double").repartition(6)


@pytest.mark.parametrize("limit", [10**6, 10])
@pytest.mark.parametrize("digits", [0, 6])
def test_quantiles_equal_numpy(spark, digits, limit):
    data, df = frame(spark, digits)
    probs = [0.25, 0.5, 0.95]
    got = {r["k"]: r for r in grouped_quantiles(df, ["k"], ["x"], probs, max_distinct=limit).collect()}
    for k in {k for k, _ in data} - {"empty"}:
        values = [x for key, x in data if key == k and x is not None]
        assert list(got[k]["x_q"]) == [float(np.quantile(values, p)) for p in probs], k
        assert got[k]["x_n"] == len(values)
    assert "empty" not in got or got["empty"]["x_q"] is None


def test_whole_column_and_weights(spark):
    data, df = frame(spark, 1)
    values = [x for _, x in data if x is not None]
    assert quantile_row(df, ["x"], [0.25, 0.75])["x"] == [float(np.quantile(values, p)) for p in (0.25, 0.75)]
    assert quantile_row(df.filter("false"), ["x"], [0.5])["x"] is None
    weighted = spark.createDataFrame([("a", 1.0, 3), ("a", 5.0, 1), ("b", 2.0, 1), ("b", 4.0, 1)], "k string, x double, w bigint")
    got = {r["k"]: r["x_q"][0] for r in grouped_quantiles(weighted, ["k"], ["x"], [0.5], weight="w", rule="middle").collect()}
    assert got == {"a": 1.0, "b": 3.0}


def test_outliers_and_gaps_leave_buckets_even(spark):
    """Borders of equal counts: with equal widths all but one reading would share a bucket."""
    values = [float(i) / 7 for i in range(20_000)] + [1e12, -1e15] + [5e5 + i for i in range(20_000)]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(5)
    borders = df.agg(O._borders("x")).first()[0]
    sizes = [r["count"] for r in df.groupBy(O._bucket(F.col("x"), F.array(*[F.lit(b) for b in borders])).alias("b")).count().collect()]
    assert len(sizes) > 0.9 * O.BUCKETS and max(sizes) <= 2 * len(values) / O.BUCKETS
    ranks = spark.createDataFrame([(0,), (20_000,), (40_001,)], "rank bigint")
    got = {r["rank"]: r["value"] for r in select_ranks(df, "x", ranks).collect()}
    assert got == {r: sorted(values)[r] for r in got} and len(got) == 3


@pytest.mark.parametrize("limit", [10**6, 5])
def test_weighted_quantiles_are_refined_too(spark, limit):
    rnd = random.Random(4)
    rows = [(rnd.choice("ab"), rnd.choice([None, *[round(rnd.gauss(0, 9), 3) for _ in range(30)]]), rnd.choice([1, 1, 2, 50])) for _ in range(400)]
    df = spark.createDataFrame(rows, "k string, x double, w bigint").repartition(3)
    got = {r["k"]: r for r in grouped_quantiles(df, ["k"], ["x"], [0.1, 0.5], max_distinct=limit, weight="w").collect()}
    for k in "ab":
        values = [x for key, x, w in rows if key == k and x is not None for _ in range(w)]
        assert list(got[k]["x_q"]) == [float(np.quantile(values, p)) for p in (0.1, 0.5)] and got[k]["x_n"] == len(values)


def test_ranks_of_groups(spark):
    data, df = frame(spark, 2)
    wanted = [(k, r) for k in ("hot", "d1", "same") for r in (0, 1)]
    ranks = spark.createDataFrame(wanted, "k string, rank bigint")
    got = {(r["k"], r["rank"]): (r["value"], r["below"]) for r in select_ranks(df, "x", ranks, ["k"]).collect()}
    for k, r in wanted:
        values = sorted(x for key, x in data if key == k and x is not None)
        assert got[(k, r)] == (values[r], sum(v < values[r] for v in values))


@pytest.mark.parametrize("n,distinct", [(23, 5), (1000, 3), (1000, 400), (9, 1), (10, 10), (4, 4)])
def test_tiles_equal_ntile(spark, n, distinct):
    rnd = random.Random(n)
    data = [(i, None if distinct == 400 and i % 3 == 0 else float(rnd.randrange(distinct))) for i in range(n)]
    df = spark.createDataFrame(data, "udi bigint, x double").repartition(4)
    ends = tile_cutoffs(df, "x", "udi", 10)
    got = df.withColumn("t", tile_of(F.col("x"), F.col("udi"), ends))
    want = df.withColumn("w", F.ntile(10).over(Window.orderBy(F.asc_nulls_last("x"), "udi")))
    assert got.join(want, "udi").filter("t <> w").count() == 0
