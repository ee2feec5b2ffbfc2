import random
import re

from telemill.llm import minhash_dedup as M
from telemill.llm.components import components


def brute(rows, words, percent=80):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower))
        sets[i] = {tuple(w[k:k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                n = len(sets[a] & sets[b])
                if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def documents():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(300)]
    base = [[rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 5, 30, 80]))] for _ in range(30)]
    out = [" ".join(b) for b in base]
    for b in base:
        for _ in range(rng.choice([0, 1, 4])):
            c = [rng.choice(vocabulary) if rng.random() < 0.04 else w for w in b]
            out.append(" ".join(c).upper() if rng.random() < 0.3 else "  ".join(c))
    hot = [rng.choice(vocabulary) for _ in range(60)]
    out += [" ".join(rng.choice(vocabulary) if rng.random() < 0.05 else w for w in hot) for _ in range(40)]
    return [(k * 7 % 1009, t) for k, t in enumerate([*out, None, "", " \t", *out[:3]])]


def test_links_and_components(spark, monkeypatch):
    rows = documents()
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, key string")
    for words, block, tokens in ((2, 7, 300), (5, 2048, 400_000)):
        monkeypatch.setattr(M, "BLOCK", block)
        monkeypatch.setattr(M, "TOKENS", tokens)
        got = {r.id: (r.n_shingles, r.component_id, r.kept) for r in M.linked(df, words=words).collect()}
        assert got == brute(rows, words)


def test_filter(spark):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(3, text), (1, text + " more"), (2, "other words entirely here now"), (None, text.upper()), (4, None), (5, None), (2, text + " end")]
    df = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, mark string")
    kept = sorted(((r.doc_id, r.text) for r in M.filter(df).collect()), key=repr)
    assert kept == sorted([(1, text + " more"), (2, "other words entirely here now"), (4, None), (5, None)], key=repr)
    assert M.filter(df).columns == df.columns
    assert M.linked(df.limit(0)).collect() == []


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 140)] + [(200, 200), (301, 300), (300, 301)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(31)}, **{i: 100 for i in range(100, 140)}, 300: 300, 301: 300}
