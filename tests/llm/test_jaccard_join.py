"""The Jaccard join against a comparison of all pairs."""

import random
import re

import pytest

from telemill.llm import jaccard_join as J

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows, words=4, percent=85):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets[i] = {tuple(w[k:k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            if sets[a] and sets[b]:
                n = len(sets[a] & sets[b])
                if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
                    p, q = find(a), find(b)
                    root[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i)) for i in ids}


def documents(seed=4):
    """Bases of many lengths, edited copies around the limit, chains of copies of copies, a large group and shared passages."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]

    def text(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    def edited(words, rate):
        out = []
        for w in words:
            r = rng.random()
            out += [] if r < rate / 3 else [w, rng.choice(vocabulary)] if r < rate / 2 else [rng.choice(vocabulary)] if r < rate else [w]
        return out

    out = [text(rng.choice([1, 2, 3, 4, 5, 8, 13, 30, 80, 200])) for _ in range(60)]
    for base in out[:40]:
        now = base
        for _ in range(rng.choice([0, 1, 3])):
            now = edited(now, rng.choice([0, 0.005, 0.01, 0.02, 0.04]))
            out.append(now)
    hot = text(120)
    out += [edited(hot, rng.choice([0.005, 0.02, 0.05])) for _ in range(60)]
    passage = text(40)
    out += [text(rng.choice([5, 60])) + passage + text(rng.choice([3, 50])) for _ in range(30)]
    texts = [" ".join(t).upper() if rng.random() < 0.2 else "  \n".join(t) for t in out]
    return [(k * 7 % 2003, t) for k, t in enumerate([*texts, None, "", " \t", *texts[:5]])]


@pytest.mark.parametrize("words,percent,tokens", [(4, 85, J.TOKENS), (4, 85, 900), (1, 60, 2000)])
def test_components_equal_a_comparison_of_all_pairs(spark, words, percent, tokens):
    rows = documents(words + percent)
    df = spark.createDataFrame([(*r, "x", 3) for r in rows], "doc_id long, text string, key string, `n.x` int").repartition(3)
    got = {r.id: (r.n_shingles, r.component_id) for r in J.linked(df, words=words, percent=percent, tokens=tokens).collect()}
    assert got == brute(rows, words, percent)


def test_bands_of_linked_sizes_touch():
    at = J.borders(85, 3000)
    band = [sum(b <= n for b in at) - 1 for n in range(3001)]
    for n in range(1, 3001):
        m = -(-n * 85 // 100)  # the smallest compatible size
        assert band[n] - band[m] <= 1


def test_posted_hashes_of_linked_sets_meet(spark):
    """Where two sets just reach the limit, each posts and lists enough for the other to be found."""
    rng = random.Random(8)
    rows, at = [], 0
    for n in [*range(4, 60), 100, 333]:
        words = [f"t{rng.random()}" for _ in range(n + 3)]
        for cut in range(0, n // 4 + 2, max(1, n // 8)):  # the end of a text replaced
            rows.append((at, " ".join(words[:len(words) - cut] + [f"u{at}x{i}" for i in range(cut // 2)])))
            at += 1
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.id: (r.n_shingles, r.component_id) for r in J.linked(df).collect()} == brute(rows)


def test_odd_ids_repeated_rows_long_texts_and_empty_tables(spark):
    text = " ".join(f"word{i}" for i in range(60))
    long = " ".join(f"x{i % 9973}y{i % 97}" for i in range(200_000))
    rows = [("b", text), ("a", text + " more"), ("a", text + " more"), (None, text), ("c", None), (None, None), ("d", long), ("e", long + " end")]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    got = sorted((str(r.id), r.n_shingles, str(r.component_id)) for r in J.linked(df).collect())
    n, m = 57, J.linked(df.filter("doc_id = 'd'")).first().n_shingles
    assert got == sorted([("a", n + 1, "a"), ("a", n + 1, "a"), ("b", n, "a"), ("None", n, "a"), ("c", 0, "c"), ("None", 0, "None"),
                          ("d", m, "d"), ("e", m + 1, "d")])
    assert J.linked(df.limit(0)).collect() == []
