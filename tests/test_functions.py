import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from telemill.functions import derive
from telemill.functions.histogram import histogram
from telemill.functions.numeric import mean, rnd, rnd_even


def column(spark, values, kind, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("x"))).collect()]


def test_signal_classes_at_the_limits(spark):
    got = column(spark, [-60, -61, -70, -71, -80, -81, None], "int", derive.signal_quality)
    assert got == ["Excellent", "Good", "Good", "Fair", "Fair", "Poor", "Poor"]


def test_temperature_and_cpu_classes(spark):
    assert column(spark, [69.9, 70.0, 79.9, 80.0, None], "double", derive.temp_status) == [
        "Normal", "Warning", "Warning", "Critical", "Normal"]
    assert column(spark, [69.9, 70.0, 84.9, 85.0, None], "double", derive.cpu_status) == [
        "Normal", "High", "High", "Critical", "Normal"]


def test_wear_stage_is_closed_above(spark):
    assert column(spark, [0, 80, 81, 170, 171, 253, 254, None], "int", derive.wear_stage) == [
        "early", "early", "mid", "mid", "late", "late", None, None]


def test_flag_text_ignores_case(spark):
    assert column(spark, ["True", "TRUE", "true", "False", "1", None], "string", derive.flag_text) == [
        True, True, True, False, False, False]


def test_rounding(spark):
    values = [0.285, 1.005, 2.5, 3.5, -2.5, 0.125, 7.345]
    assert column(spark, values, "double", lambda x: rnd_even(x, 2)) == pytest.approx([float(np.round(v, 2)) for v in values], abs=0)
    assert column(spark, [2.5, 3.5, -2.5], "double", lambda x: rnd(x)) == [3.0, 4.0, -3.0]


def test_mean_does_not_depend_on_order_or_partitions(spark):
    rng = np.random.default_rng(5)
    values = [float(v) for v in rng.integers(0, 9900, 5000) / 100]
    got = set()
    for parts, seq in ((1, values), (7, values[::-1]), (13, sorted(values))):
        df = spark.createDataFrame([(v,) for v in seq], "x double").repartition(parts)
        got.add(df.agg(mean("x")).first()[0])
    assert len(got) == 1
    assert spark.createDataFrame([], "x double").agg(mean("x")).first()[0] is None


def test_mean_adds_doubles_and_not_their_decimals(spark):
    """Where the decimal mean is a rounding tie, the doubles decide as they do in any DOUBLE average."""
    for values in ([25.4, 9.7], [0.1] * 6, [2.675, 2.685], [1e-9, 3.0], [-25.4, -9.7], [1e15, 1.0, -1e15], [5e12, 2.5]):
        want = math.fsum(values) / len(values)
        for order in (values, values[::-1]):
            df = spark.createDataFrame([(v,) for v in order], "x double").repartition(3)
            assert df.agg(mean("x")).first()[0] == want, values
    df = spark.createDataFrame([(25.4,), (9.7,)], "x double")
    assert df.agg(rnd(mean("x"), 1)).first()[0] == 17.5
    rng = np.random.default_rng(6)
    values = [float(v) for v in rng.normal(50, 30, 3000)]
    got = spark.createDataFrame([(v,) for v in values], "x double").repartition(5).agg(mean("x")).first()[0]
    assert got == math.fsum(values) / len(values)


def test_histogram_closes_last_bin_and_keeps_empty_bins(spark):
    df = spark.createDataFrame([(v,) for v in [0.0, 0.1, 5.0, 9.9, 10.0, None]], "x double")
    got = {r["bin"]: r["n"] for r in histogram(df, "x", 10).collect()}
    assert got == {0: 2, 5: 1, 9: 2, **{b: 0 for b in (1, 2, 3, 4, 6, 7, 8)}}
    one = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    want, edges = np.histogram([3.0, 3.0], bins=4)
    assert [r["n"] for r in histogram(one, "x", 4).orderBy("bin").collect()] == list(want)
