"""Detectors as table functions: from SQL, in the consensus, on any table."""

import datetime
import math
import random

import pytest
from pyspark.errors import PySparkException

from telemill.operators import anomaly, table_detectors as T

DAY = datetime.datetime(2024, 1, 6)
SCHEMA = ("id long, device_id string, timestamp timestamp, cpu_pct double, ram_pct double, temperature_c double, signal_dbm long")


def readings(spark, values, device="a", first=0):
    rows = [(first + i, device, DAY + datetime.timedelta(minutes=10 * i), 20.0, 30.0, v, -60) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, SCHEMA)


def test_from_sql_on_any_table(spark):
    T.register(spark, "leap", lambda: T.Jump("x", 2.0))
    spark.createDataFrame([("a", 1, 1.0), ("a", 2, 9.0), ("a", 3, None), ("a", 4, math.nan), ("a", 5, 8.0), ("b", 1, 50.0),
                           (None, 1, 1.0), (None, 2, 2.0)], "k string, t int, x double").createOrReplaceTempView("any_table")
    got = spark.sql("SELECT * FROM leap(TABLE(any_table) PARTITION BY k ORDER BY t)").orderBy("k", "t").collect()
    assert [(r.k, r.t, r.leap_score, r.leap_anomaly) for r in got] == [
        (None, 1, None, False), (None, 2, 1.0, False), ("a", 1, None, False), ("a", 2, 8.0, True), ("a", 3, None, False),
        ("a", 4, None, False), ("a", 5, 1.0, False), ("b", 1, None, False)]
    assert spark.sql("SELECT * FROM leap(TABLE(SELECT * FROM any_table WHERE false) PARTITION BY k ORDER BY t)").collect() == []
    for bad in ("SELECT k, t FROM any_table", "SELECT *, 1 AS leap_score FROM any_table"):
        with pytest.raises(PySparkException, match="missing|already"):
            spark.sql(f"SELECT * FROM leap(TABLE({bad}) PARTITION BY k ORDER BY t)").collect()


def test_an_own_detector_takes_part_in_the_consensus_by_name(spark):
    T.register(spark, "jump", T.Jump)
    rng = random.Random(3)
    values = [50 + rng.random() for _ in range(200)]
    values[120] = 99.0
    df = readings(spark, values).unionByName(readings(spark, [20.0] * 5, "b", 1000))
    out = anomaly.detect(df, ("zscore", "jump"))
    assert {r.id for r in out.filter("jump_anomaly").collect()} == {120, 121}
    assert [(r.id, r.method_count) for r in out.filter("consensus_anomaly").collect()] == [(120, 2)]
    # the first reading of a day has none before it
    assert {r.id for r in out.filter("jump_score IS NULL").collect()} == {0, 144, 1000}
    again = anomaly.detect(df.repartition(7), {"zscore": anomaly.zscore, "jump": T.step("jump")})
    assert sorted(again.filter("jump_anomaly").select("id").collect()) == [(120,), (121,)]


def test_an_unknown_name_is_an_error(spark):
    with pytest.raises(PySparkException, match="nobody"):
        anomaly.detect(readings(spark, [1.0]), ("zscore", "nobody"))
