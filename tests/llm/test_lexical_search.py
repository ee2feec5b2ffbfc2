"""Ranked search against a plain loop over all items and documents."""

import math
import random
import re
from collections import Counter

from telemill.llm import lexical_search as L

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, top=10):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    size = [sum(b.values()) for _, b in bags]
    n, total = sum(s > 0 for s in size), sum(size)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in sorted(set(items), key=repr):
        scores = []
        for (i, bag), length in zip(bags, size):
            score = 0
            for t in terms(text):
                if bag[t]:
                    m = 25 + (75 * length * n) // total
                    score += math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 8 * m))
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=repr)


def corpus():
    rng = random.Random(9)
    words = [f"w{i}" for i in range(60)] + ["Ünder", "naïve", "日本", "X9", "a_b", "it's"]
    weights = [1 / (i + 1) for i in range(len(words))]
    docs = [(i * 13 % 997, " ".join(rng.choices(words, weights, k=rng.choice([1, 3, 20, 120])))) for i in range(150)]
    docs += [(5000 + i, docs[0][1]) for i in range(40)]                      # equal scores: ids decide
    docs += [(None, "w50 w51"), (None, "w50 w51"), (7001, None), (7002, ""), (7003, "?! -"), (7004, "W0 w0\x00w0 É")]
    docs += [(7005, "w3 w40 " * 3000), docs[3], docs[3]]                     # long, and repeated rows
    items = [(i, " ".join(rng.choices(words, k=rng.choice([1, 5, 90])))) for i in range(25)]
    items += [(3, "w1 w1 w1 w55"), (99, None), (98, ""), (97, "absent"), (None, "w50 W50"), items[0], items[0]]
    return docs, items


def found(spark, docs, items, **args):
    d = spark.createDataFrame([(*r, "c", 1) for r in docs], "doc_id long, text string, n string, `a.b` int")
    q = spark.createDataFrame([(*r, 2) for r in items], "item_id long, text string, rank int")
    return sorted((tuple(r) for r in L.search(d.repartition(3), q, **args).collect()), key=repr)


def test_search_equals_a_plain_loop(spark, monkeypatch):
    docs, items = corpus()
    want = brute(docs, items)
    assert found(spark, docs, items) == want
    monkeypatch.setattr(L, "STEP", 2)
    monkeypatch.setattr(L, "CELLS", 2000)
    monkeypatch.setattr(L, "ITEM_BYTES", 200)  # several blocks of items
    monkeypatch.setattr(L, "PIECE", 7)
    assert found(spark, docs, items, top=4) == brute(docs, items, 4)


def test_ids_of_other_kinds_and_empty_tables(spark):
    docs = spark.createDataFrame([("b", "one two"), ("a", "one two"), ("c", "two three")], "name string, body string")
    items = spark.createDataFrame([("q", "ONE three")], "q string, t string")
    got = [tuple(r) for r in L.search(docs, items, "name", "body", "q", "t").orderBy("rank").collect()]
    assert [(r[0], r[1], r[2]) for r in got] == [("q", 1, "c"), ("q", 2, "a"), ("q", 3, "b")]
    assert L.search(docs.limit(0), items, "name", "body", "q", "t").collect() == []
    assert L.search(docs, items.limit(0), "name", "body", "q", "t").collect() == []


def test_masks_are_evaluated_only_while_they_can_win():
    """A block of documents that cannot reach the best so far is left out whole."""
    import numpy as np
    own, factor = np.array([0, 1]), np.array([10, 1])
    searcher = L._Searcher([(own, factor)], 2, 100, 1000, 2)
    n = np.full(50, 10)
    searcher.block(list(range(50)), n, np.arange(51), np.zeros(50, np.int64), np.ones(50, np.int64))
    assert searcher.ids == [[0, 1]]
    before = searcher.scores[0].copy()
    searcher.block(list(range(50, 100)), n, np.arange(51), np.ones(50, np.int64), np.ones(50, np.int64))
    assert searcher.ids == [[0, 1]] and (searcher.scores[0] == before).all()
