import numpy as np
import published as P
from pyspark.sql import functions as F

from telemill.plans import eda, machine
from telemill.sources import bindings as B


def test_published_risk_scores(spark):
    data = [(u, f"X{u}", "L", w, t, p, d, False) for u, w, t, p, d, _, _ in P.RISK]
    df = spark.createDataFrame(
        data, "udi bigint, product_id string, machine_type string, tool_wear_min bigint, torque_nm double, power_w double, "
              "temp_diff_k double, machine_failure boolean")
    got = {r["udi"]: (r["risk_score"], r["risk_rank"]) for r in machine.risk_ranking(df).collect()}
    assert got == {u: (s, r) for u, _, _, _, _, s, r in P.RISK}


def test_band_limits(spark):
    data = [(29.9, 1399), (30.0, 1400), (50.0, 1700), (50.1, 1701)]
    df = spark.createDataFrame([(False, t, s) for t, s in data], "machine_failure boolean, torque_nm double, rotational_speed_rpm bigint")
    got = {(r["torque_band"], r["speed_band"]): r["reading_count"] for r in machine.envelope(df).collect()}
    low, normal, high = zip(machine.TORQUE_BANDS, machine.SPEED_BANDS)
    assert got == {low: 1, normal: 2, high: 1}


def test_slices_do_not_change_results(spark, sf_dir):
    m = B.machines(spark, sf_dir)
    for job in (machine.cumulative_high_wear, machine.rolling_failure_rate,
                lambda x, **k: machine.rolling_failure_rate(x, step=1, frames=(5, 40), **k)):
        a, b = job(m), job(m.repartition(7), rows=97)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_equal_scores_stay_spread(spark, sf_dir):
    one = B.machines(spark, sf_dir).filter("NOT machine_failure").limit(1)
    same = one.crossJoin(spark.range(500).select(F.col("id").alias("copy"))).withColumn("udi", F.col("copy")).drop("copy")
    ranked = machine.risk_ranking(same)
    assert {r.risk_rank for r in ranked.collect()} == {1} and ranked.count() == 500
    # only the list of highest scores is ever put in one partition
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" not in plan
    for line in plan.splitlines():
        assert "SinglePartition" not in line or "product_id" not in line


def test_correlations_have_the_same_bits_at_any_partitioning(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(300, 2, 4000)
    rows = [(float(a), float(3 * a + b), None if i % 7 == 0 else float(b), 1.0) for i, (a, b) in enumerate(zip(x, rng.normal(0, 1, 4000)))]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    ways = [sorted(map(tuple, eda.co_moments(part, ["a", "b", "c"]).collect())) for part in (df.repartition(1), df.repartition(7), df.orderBy("b"))]
    assert ways[0] == ways[1] == ways[2] and len(ways[0]) == 6
    got = {(r["x"], r["y"]): r["r"] for r in eda.correlation_matrix(df.repartition(3), ["a", "b", "c", "d"]).collect()}
    m = np.array([[np.nan if v is None else v for v in r] for r in rows])
    whole = ~np.isnan(m[:, 2])
    assert got[("a", "b")] == got[("b", "a")] == round(np.corrcoef(m[:, 0], m[:, 1])[0, 1], 9)
    assert got[("a", "c")] == round(np.corrcoef(m[whole, 0], m[whole, 2])[0, 1], 9)
    assert got[("a", "a")] == 1.0 and got[("a", "d")] is None and len(got) == 16
