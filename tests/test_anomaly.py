import numpy as np
import pytest
from pyspark.sql import functions as F

from telemill.operators import anomaly, iforest

SCHEMA = "id bigint, device_id string, cpu_pct double, ram_pct double, temperature_c double, signal_dbm int"


def frame(spark, groups):
    """{device: [(cpu, ram, temp, signal)]}"""
    rows, i = [], 0
    for d, values in groups.items():
        for v in values:
            rows.append((i, d, *v))
            i += 1
    return spark.createDataFrame(rows, SCHEMA)


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="ram_pct"):
        anomaly.zscore(spark.createDataFrame([(1, "a", 2.0)], "id int, device_id string, cpu_pct double"))


def test_nine_rows_are_too_few_ten_are_enough(spark):
    nine = [(10.0, 5.0, 40.0, -60)] * 8 + [(99.0, 5.0, 40.0, -60)]
    ten = [(10.0, 5.0, 40.0, -60)] * 9 + [(99.0, 5.0, 40.0, -60)]
    got = anomaly.iqr(anomaly.zscore(frame(spark, {"nine": nine, "ten": ten}))).groupBy("device_id").agg(
        F.max("max_zscore").alias("z"), F.count_if("iqr_anomaly").alias("n"), F.max("iqr_hi_cpu_pct").alias("hi"))
    by = {r["device_id"]: r for r in got.collect()}
    assert by["nine"]["z"] == 0.0 and by["nine"]["n"] == 0 and by["nine"]["hi"] is None
    assert by["ten"]["z"] == pytest.approx(3.0) and by["ten"]["n"] == 1 and by["ten"]["hi"] == 10.0


def test_trigger_is_the_first_feature_with_the_maximum(spark):
    rows = [(10.0, 10.0, 40.0, -60)] * 20 + [(50.0, 50.0, 40.0, -60)]
    got = anomaly.zscore(frame(spark, {"a": rows})).filter("zscore_anomaly").collect()
    assert [(r["cpu_pct"], r["zscore_trigger"]) for r in got] == [(50.0, "CPU %")]
    got = anomaly.iqr(frame(spark, {"a": [(10.0, 10.0, 40.0, -60)] * 20 + [(10.0, 11.0, 41.0, -60)]})).filter("iqr_anomaly").collect()
    assert [r["iqr_trigger"] for r in got] == ["RAM %"]


def test_nulls_and_constant_features(spark):
    rows = [(float(i), None, None, -60) for i in range(12)] + [(None, None, None, None)]
    got = anomaly.consensus(anomaly.iqr(anomaly.zscore(frame(spark, {"a": rows}))), ["zscore", "iqr"])
    blank = got.filter("cpu_pct is null").first()
    assert blank["zscore_anomaly"] is False and blank["zscore_trigger"] == "" and blank["iqr_anomaly"] is False
    assert got.filter("zscore_anomaly is null or iqr_anomaly is null").count() == 0


def planted(n=300):
    rng = np.random.default_rng(8)
    values = [(float(a), float(b), float(c), int(d)) for a, b, c, d in
              zip(rng.normal(30, 3, n).round(1), rng.normal(50, 4, n).round(1), rng.normal(45, 2, n).round(2), rng.integers(-70, -50, n))]
    return values + [(95.0, 99.0, 90.0, -99)]


def test_forest_finds_the_planted_row(spark):
    groups = {"a": planted(), "b": planted(200), "few": planted(18)}
    df = frame(spark, groups)
    got = anomaly.isolation_forest(df)
    for d in ("a", "b"):
        one = got.filter(F.col("device_id") == d)
        assert one.orderBy(F.desc("iforest_score")).first()["cpu_pct"] == 95.0
        share = one.filter("iforest_anomaly").count() / one.count()
        assert 0.005 <= share <= 0.02
    few = got.filter("device_id = 'few'")
    assert few.filter("iforest_anomaly or iforest_score <> 0").count() == 0
    assert got.count() == df.count()


def test_forest_is_the_same_at_any_partitioning_and_for_large_groups(spark):
    with_null = planted() + [(None, 50.0, 45.0, -60)]
    df = frame(spark, {"a": with_null, "b": planted(150), "few": planted(10)})
    def scores(frame, **options):
        out = iforest.isolation_scores(frame, "device_id", "id", list(anomaly.FEATURES), **options)
        return {r["id"]: r["iforest_score"] for r in out.collect()}
    base = scores(df)
    assert base[len(with_null) - 1] is None
    assert scores(df.repartition(7)) == base
    # 100 rows per task: a and b are trained apart and scored in salted parts
    assert scores(df.repartition(3), rows_per_task=100) == base


def test_forest_of_a_device_with_more_rows_than_its_trees_draw(spark):
    """3000 rows: most of the drawn ones are cut again, and repeated row ids share a hash."""
    rnd = np.random.default_rng(11)
    rows = [(int(i % 2900), "hot", float(x)) for i, x in enumerate(rnd.normal(50, 5, 3000))] + [(9999, "hot", 500.0)]
    df = spark.createDataFrame(rows, "id bigint, device_id string, x double")
    ways = [sorted(tuple(r) for r in iforest.isolation_scores(part, "device_id", "id", ["x"], **o).select("id", "x", "iforest_score").collect())
            for part, o in ((df.repartition(5), {}), (df.repartition(2), {"rows_per_task": 700}), (df.repartition(7), {"rows_per_task": 100}))]
    assert ways[0] == ways[1] == ways[2]
    assert max(ways[0], key=lambda r: r[2])[1] == 500.0  # the planted row


def test_samples_equal_a_plain_sampler():
    """Every tree takes the rows of its smallest hashes out of all rows, computed one by one."""
    rnd = np.random.default_rng(12)
    x = rnd.normal(size=(1000, 2))
    hashes = rnd.integers(-2**63, 2**63, 1000)
    mask = 2**64 - 1

    def plain(h, t):
        v = (int(h) + (t + 1) * 0x9E3779B97F4A7C15) & mask
        v = ((v ^ (v >> 30)) * 0xBF58476D1CE4E5B9) & mask
        v = ((v ^ (v >> 27)) * 0x94D049BB133111EB) & mask
        return v ^ (v >> 31)
    got = iforest.tree_samples(x, hashes)
    assert got.shape == (100, 256, 2)
    for t in (0, 1, 50, 99):
        order = sorted(range(1000), key=lambda i: plain(hashes[i], t))[:256]
        assert (got[t] == x[order]).all()
    used = {tuple(r) for r in got.reshape(-1, 2).tolist()}
    assert len(used) == 1000  # no row is left to no tree


def test_consensus_needs_two(spark):
    df = spark.createDataFrame([(True, False, False), (True, True, False), (True, True, True), (False, False, False)],
                               "zscore_anomaly boolean, iqr_anomaly boolean, iforest_anomaly boolean")
    assert [(r["method_count"], r["consensus_anomaly"]) for r in anomaly.consensus(df).collect()] == [
        (1, False), (2, True), (3, True), (0, False)]


def test_average_path():
    assert iforest.average_path(np.array([0, 1, 2])).tolist() == [0.0, 0.0, 1.0]
    assert iforest.average_path(np.array([256]))[0] == pytest.approx(10.244, abs=0.01)
