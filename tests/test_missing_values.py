"""NaN is missing, means are exact, ranks and forests do not depend on size."""

import math

from pyspark.sql import functions as F

from telemill.functions import derive
from telemill.functions.numeric import mean
from telemill.operators import anomaly, iforest
from telemill.operators.ordered import rank_desc

NAN = float("nan")


def test_means(spark):
    def of(*values):
        return spark.createDataFrame([(v,) for v in values], "x double").agg(mean("x")).first()[0]
    assert math.isclose(of(0.00004, 0.00003), 0.000035, rel_tol=1e-12)
    assert of(1.0, NAN, 3.0, None) == 2.0
    assert of(*[9e15] * 20) == 9e15
    assert of(NAN) is None


def readings(spark, odd):
    rows = [(i, "d", float(i % 7), float(i % 5), 40.0 + i % 3, -60 - i % 4) for i in range(40)]
    rows.append((40, "d", odd, 1.0, 41.0, -61))
    return spark.createDataFrame(rows, "id long, device_id string, cpu_pct double, ram_pct double, temperature_c double, signal_dbm int")


def test_one_nan_flags_nothing(spark):
    flags = [anomaly.detect(readings(spark, v), ("zscore", "iqr")).filter("zscore_anomaly OR iqr_anomaly").count() for v in (NAN, None)]
    assert flags == [0, 0]
    classes = spark.createDataFrame([(NAN,)], "x double").select(
        derive.temp_status(F.col("x")), derive.cpu_status(F.col("x")), derive.signal_quality(F.col("x"))).first()
    assert tuple(classes) == ("Normal", "Normal", "Poor")


def test_forest_scores_do_not_depend_on_the_way(spark):
    rows = [(i, "a" if i < 301 else "b", float(i * 37 % 101), None if i == 9 else NAN if i == 5 else float(i % 13)) for i in range(340)]
    df = spark.createDataFrame(rows, "id long, device_id string, x double, y double")
    ways = [sorted(tuple(r) for r in iforest.isolation_scores(df, "device_id", "id", ["x", "y"], **o).select("id", "iforest_score").collect())
            for o in ({}, {"rows_per_task": 100})]
    assert ways[0] == ways[1]
    assert [r[0] for r in ways[0] if r[1] is None] == [5, 9]


def test_forest_of_a_device_beyond_its_samples(spark):
    df = spark.range(3000).select("id", F.lit("a").alias("device_id"), (F.col("id") * 37 % 101).cast("double").alias("x"))
    ways = [sorted(tuple(r) for r in iforest.isolation_scores(df, "device_id", "id", ["x"], **o).select("id", "iforest_score").collect())
            for o in ({}, {"rows_per_task": 400})]
    assert ways[0] == ways[1]


def test_own_detector_joins_the_consensus(spark):
    def hot(df):
        return df.withColumn("hot_anomaly", F.col("cpu_pct") > 5)
    found = anomaly.detect(readings(spark, 99.0), {"hot": hot, "iqr": anomaly.iqr})
    assert [r.id for r in found.filter("consensus_anomaly").collect()] == [40]


def test_equal_values_share_a_rank(spark):
    df = spark.createDataFrame([("a", 1.0)] * 50 + [("a", 2.0), ("a", None), ("b", 1.0), ("b", 1.0)], "k string, v double")
    for rows in (1, 1000):
        ranks = sorted({(r.k, r.v, r.rank) for r in rank_desc(df, "v", "rank", ["k"], rows=rows).collect()}, key=repr)
        assert ranks == sorted([("a", 2.0, 1), ("a", 1.0, 2), ("a", None, 52), ("b", 1.0, 1)], key=repr)
