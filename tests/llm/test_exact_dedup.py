import hashlib

import pytest

from telemill.llm import exact_dedup

ROWS = [(5, "a  b"), (2, "a\tb"), (9, "a b"), (1, None), (4, ""), (7, "long " * 400 + "x"), (8, "long " * 400 + "y"),
        (3, "long " * 400 + "x"), (None, "a b"), (None, "only null"), (6, "twice"), (6, "twice"), (6, "other"),
        (10, " lead"), (11, "lead")]


def test_assign_and_filter(spark):
    df = spark.createDataFrame([(i, t, "s") for i, t in ROWS], "doc_id long, text string, sha string")
    got = sorted(map(tuple, exact_dedup.assign(df).collect()), key=repr)
    norm = [" ".join((t or "").replace("\t", " ").replace("  ", " ").split(" ")) for _, t in ROWS]
    want = []
    for (i, _), n in zip(ROWS, norm):
        same = [j for (j, _), m in zip(ROWS, norm) if m == n]
        keep = min((j for j in same if j is not None), default=None)
        want.append((i, keep, len(same), i == keep, hashlib.sha256(n.encode()).hexdigest()))
    assert got == sorted(want, key=repr)
    kept = exact_dedup.filter(df)
    assert kept.columns == df.columns
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(rows) == len(set(norm))
    assert rows.count((6, "twice")) == 1 and (2, "a\tb") in rows and (6, "other") in rows


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert exact_dedup.assign(df).collect() == [] and exact_dedup.filter(df).collect() == []


@pytest.mark.parametrize("few", [exact_dedup.FEW, 0])
def test_both_ways_and_odd_column_names(spark, monkeypatch, few):
    monkeypatch.setattr(exact_dedup, "FEW", few)
    df = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(ROWS)], "`doc.id` long, `te``xt` string, norm int")
    got = {r["text_sha256"]: r["group_size"] for r in exact_dedup.assign(df, "doc.id", "te`xt").collect()}
    assert len(got) == 9 and sum(got.values()) == len(ROWS)
    kept = exact_dedup.filter(df, "doc.id", "te`xt")
    assert kept.columns == df.columns and kept.count() == 9


def test_only_texts_with_a_partner_are_hashed(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    plan = exact_dedup.filter(df)._jdf.queryExecution().optimizedPlan().toString()
    hashes = [line for line in plan.splitlines() if "sha2(" in line]
    assert hashes and all("CASE WHEN several" in line or "Join LeftSemi" in plan[plan.index(line):] for line in hashes)
    counted = exact_dedup.candidates(df)._jdf.queryExecution().optimizedPlan().toString()
    prefix = next(line for line in counted.splitlines() if "xxhash64" in line)
    assert "Join LeftSemi" in counted[counted.index(prefix):]  # lengths come before prefixes


def test_very_long_texts(spark):
    long = "word " * 2_000_000
    df = spark.createDataFrame([(2, long), (1, long.replace(" ", "\t ")), (3, long + "end")], "doc_id long, text string")
    assert sorted((r.doc_id, r.keep_id, r.group_size) for r in exact_dedup.assign(df).collect()) == [(1, 1, 2), (2, 1, 2), (3, 3, 1)]
