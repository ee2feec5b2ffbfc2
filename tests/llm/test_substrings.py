"""Both substring dedups against brute force."""


import random
import re

import pytest

from telemill.llm import suffix_dedup, substring_dedup


def documents():
    rng = random.Random(11)
    def prose(n):
        return " ".join(rng.choice(["alpha", "beta", "gamma", "été", "x", "longer-word"]) + str(rng.randrange(40)) for _ in range(n))
    shared = prose(60)
    texts = [prose(30) + " " + shared[:300] + " " + prose(10), shared, prose(5) + shared[50:] + prose(5), None, "", "short",
             shared + "  " + shared, "a" * 400, "b" + "a" * 250, prose(80)]
    texts += [prose(3) + " " + shared[:140] + " " + prose(3) for _ in range(12)]  # one passage in many contexts
    return [(i * 3 % 97, t, "clash") for i, t in enumerate(texts)]


def brute(rows, length, units, windows_of_same_document):
    rows = sorted(rows)
    first = {}
    for doc, (i, t, _) in enumerate(rows):
        own = units(t)
        for p in range(len(own) - length + 1):
            first.setdefault(tuple(own[p:p + length]), (i, p))
    out = {}
    for i, t, _ in rows:
        own = units(t)
        gone = [False] * len(own)
        for p in range(len(own) - length + 1):
            a = first[tuple(own[p:p + length])]
            if a < (i, p) if windows_of_same_document else a[0] < i:
                gone[p:p + length] = [True] * length
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out[i] = (len(own), sum(gone), spans, [u for u, g in zip(own, gone) if not g])
    return out


@pytest.mark.parametrize("many", [3, 1000])
def test_bytes(spark, many):
    rows = documents()
    df = spark.createDataFrame(rows, "doc_id long, text string, anchor string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.clean(df, many=many).collect()}
    want = brute(rows, 100, lambda t: list((t or "").encode()), True)
    assert got == {i: (n, r, s, bytes(k)) for i, (n, r, s, k) in want.items()}


def test_words(spark):
    rows = documents()
    df = spark.createDataFrame(rows, "doc_id long, text string, seg string")
    got = {r.doc_id: (r.n_words, r.n_removed, r.n_repeats, r.kept) for r in substring_dedup.clean(df).collect()}
    want = brute(rows, 13, lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or ""), False)
    assert got == {i: (n, r, s, " ".join(k)) for i, (n, r, s, k) in want.items()}


def test_odd_ids(spark):
    text = " ".join(f"word{i}" for i in range(40))
    df = spark.createDataFrame([(None, text), (5, text), (5, text), (5, text + " more"), (7, text)], "doc_id int, text string")
    got = sorted(((r.doc_id, r.n_words, r.n_removed) for r in substring_dedup.clean(df).collect()), key=repr)
    # the two texts of id 5 are numbered by hash; the rows that repeat one are one document
    first_is_short = (5, 40, 0) in got
    assert got == sorted([(None, 40, 40), (7, 40, 40)] + (
        [(5, 40, 0), (5, 40, 0), (5, 41, 40)] if first_is_short else [(5, 40, 40), (5, 40, 40), (5, 41, 0)]), key=repr)
    assert substring_dedup.clean(df.limit(0)).collect() == []
