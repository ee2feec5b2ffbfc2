"""Cleaning steps on literal rows and against a row-by-row computation."""

import random

import pytest
from pyspark.sql import functions as F

from telemill.operators import cleaning as C

SCHEMA = ("udi bigint, product_id string, type string, air_temp_k double, process_temp_k double, rotational_speed_rpm bigint, "
          "torque_nm double, tool_wear_raw string, machine_failure int, twf int, hdf int, pwf int, osf int, rnf int")


def raw(spark, rows):
    """(udi, type, air, rpm, torque, wear text)"""
    return spark.createDataFrame(
        [(u, f"P{u}", t, a, 310.0, r, q, w, 0, 0, 0, 0, 0, 0) for u, t, a, r, q, w in rows], SCHEMA)


def brute(rows):
    """The whole imputation, one row after the other."""
    rows = sorted(rows, key=lambda r: r[0])
    def numeric(w):
        try:
            return float(w)
        except (TypeError, ValueError):
            return None
    wear = [numeric(r[5]) for r in rows]
    def carried(values):
        out, last = [], None
        for v in values:
            last = v if v is not None else last
            out.append(last)
        first = next((v for v in out if v is not None), None)
        return [first if v is None else v for v in out]
    air, rpm = carried([r[2] for r in rows]), carried([r[3] for r in rows])
    medians = {}
    for t in {r[1] for r in rows if r[1] is not None}:
        known = sorted(r[4] for r in rows if r[1] == t and r[4] is not None)
        n = len(known)
        medians[t] = None if not n else (known[n // 2] if n % 2 else (known[n // 2 - 1] + known[n // 2]) / 2)
    torque = [r[4] if r[4] is not None else medians.get(r[1]) for r in rows]
    known = [i for i, w in enumerate(wear) if w is not None]
    filled = []
    for i, w in enumerate(wear):
        before = [k for k in known if k <= i]
        after = [k for k in known if k >= i]
        if w is None and before and after:
            a, b = before[-1], after[0]
            w = wear[a] + (wear[b] - wear[a]) / float(b - a) * float(i - a)
        elif w is None and before:
            w = wear[before[-1]]
        filled.append(None if w is None else round(w))
    return sorted({(r[0], r[1], air[i], rpm[i], torque[i], filled[i]) for i, r in enumerate(rows)}, key=repr)


def run(spark, rows, per_slice=10**6):
    got = C.dedup_exact(C.imputed_readings(raw(spark, rows).repartition(5), per_slice))
    return sorted((tuple(r) for r in got.select(
        "udi", "type", "air_temp_k", "rotational_speed_rpm", "torque_nm", "tool_wear_min").collect()), key=repr)


@pytest.mark.parametrize("per_slice", [7, 60, 10**6])
@pytest.mark.parametrize("seed", [1, 2])
def test_imputation_equals_brute_force(spark, per_slice, seed):
    rnd = random.Random(seed)
    rows = []
    for u in range(0, 400, 2):
        row = (u, rnd.choice(["L", "low", "M", "H", None]), rnd.choice([None, 300.0, 301.5]), rnd.choice([None, 1400, 1500]),
               rnd.choice([None, 40.0, 41.5, 60.0]), rnd.choice(["N/A", "", "-", str(rnd.randint(0, 250)), None]))
        rows += [row] * rnd.choice([1, 1, 1, 2, 5, 30])
    assert run(spark, rows, per_slice) == brute(rows)


@pytest.mark.parametrize("after", ["9", "200", "0"])
def test_many_copies_of_a_gap(spark, after):
    rows = [(1, "L", 300.0, 1500, 40.0, "5"), *[(2, "L", 300.0, 1500, 40.0, "ERR")] * 1001, (3, "L", 300.0, 1500, 40.0, after)]
    counted = C.interpolate(C.collapse_copies(C.coerce_wear(raw(spark, rows))))
    got = {r["tool_wear_min"]: r["copies"] for r in counted.filter("udi = 2").collect()}
    want = {}
    for i in range(1, 1002):
        w = round(5.0 + (float(after) - 5.0) / 1002.0 * float(i))
        want[w] = want.get(w, 0) + 1
    assert got == want


def test_leading_gap_stays_and_trailing_takes_the_last(spark):
    rows = [(1, "L", None, None, 40.0, "n/a"), (2, "L", 300.0, 1500, 40.0, "10"), (3, "L", None, None, None, "13"), (4, "L", None, None, 40.0, "x")]
    assert [(r[0], r[2], r[3], r[5]) for r in run(spark, rows)] == [(1, 300.0, 1500, None), (2, 300.0, 1500, 10), (3, 300.0, 1500, 13), (4, 300.0, 1500, 13)]


def test_group_with_only_null_torque_stays_null(spark):
    rows = [(1, "L", 300.0, 1500, None, "1"), (2, "M", 300.0, 1500, 50.0, "1"), (3, None, 300.0, 1500, None, "1")]
    assert [r[4] for r in run(spark, rows)] == [None, 50.0, None]


def test_headers_and_sentinels(spark):
    df = spark.createDataFrame([("N/A",), ("n/a",), ("",), ("ERR",), ("-",), ("12",), (" 7 ",), (None,)], "` tool_wear_raw ` string")
    assert C.header_audit(df) == [" tool_wear_raw "]
    clean = C.strip_headers(df)
    assert clean.columns == ["tool_wear_raw"]
    assert {r["sentinel"]: r["readings"] for r in C.wear_sentinels(clean).collect()} == {s: 1 for s in ("N/A", "n/a", "", "ERR", "-")}
    assert sorted(r[0] for r in C.coerce_wear(clean).filter("tool_wear_min is not null").collect()) == [7.0, 12.0]


def test_celsius_limit(spark):
    df = spark.createDataFrame([(99.9, 310.0), (100.0, 310.0), (27.0, 90.0), (300.0, 310.0)], "air_temp_k double, process_temp_k double")
    assert sorted(r[0] for r in C.celsius_to_kelvin(df).collect()) == pytest.approx([100.0, 300.0, 300.15, 373.05])
    one = C.celsius_report(df).first()
    assert (one["air_celsius_rows"], one["process_celsius_rows"], one["all_kelvin"]) == (2, 1, False)


def test_clip_and_floor(spark):
    df = spark.createDataFrame([(float(v), 40.0) for v in [1500, 1510, 1490, 1505, 1495, 99999, -500]], "rotational_speed_rpm double, torque_nm double")
    fences = C.clip_fences(df)
    lo, hi = fences["rotational_speed_rpm"]
    got = sorted(r[0] for r in C.clip_iqr(df, fences).collect())
    assert lo >= 0 and got[0] == lo and got[-1] == hi and got[1:-1] == [1490.0, 1495.0, 1500.0, 1505.0, 1510.0]


def test_type_spellings_and_labels(spark):
    df = spark.createDataFrame([(t,) for t in ["low", "MED", "h", "Medium", "MEDIUM", "L", None]], "type string")
    assert [r[0] for r in C.normalise_type(df).collect()] == ["L", "M", "H", None, None, "L", None]
    labels = spark.createDataFrame([(0, 1, 0, 0, 0, 0), (1, 0, 0, 0, 0, 0), (1, 0, 1, 0, 0, 0), (0, 0, 0, 0, 0, 1)],
                                   "machine_failure int, twf int, hdf int, pwf int, osf int, rnf int")
    assert tuple(C.label_report(labels).first()) == (2, 0, 2, 1)
    assert C.fix_labels(labels).filter("machine_failure = 0").agg(F.sum(F.col("twf") + F.col("rnf"))).first()[0] == 0
