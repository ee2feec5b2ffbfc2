"""Language, quality, personal data, decontamination: brute force, held-out accuracy, edge cases."""

import random
import re

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from telemill.llm import decontamination as D, language as L, pii as P, quality as Q
from telemill.llm.common import table

EDGE = [(1, None), (2, ""), (3, "12 34 !!"), (None, "the and of with this"), (5, "the and of with this")]


def test_automaton_holds_all_substrings_and_no_others():
    rng = random.Random(0)
    texts = ["".join(rng.choice("abc ") for _ in range(40)) for _ in range(6)]
    letters = {c: i + 2 for i, c in enumerate("abc ")}
    step = L.Automaton(texts, letters).step
    for _ in range(3000):
        word = "".join(rng.choice("abc ") for _ in range(rng.randint(1, 8)))
        state = 1
        for c in word:
            state = step[state, letters[c]]
        assert bool(state) == any(word in t for t in texts)


def test_phrases_against_brute_force():
    texts = {"x": ["the cat sat on the mat"], "y": ["le chat est assis"]}
    model = L.Model(texts)
    for text in ("the chat sat", "zzz the", "é" * 300 + " cat", "Le CHAT!"):
        folded, want = L._folded(text), []
        for own in texts.values():
            n = 0
            for lo in range(0, len(folded), L.BLOCK):
                block, i = folded[lo:lo + L.BLOCK], 0
                while i < len(block):
                    k = 1
                    while i + k < len(block) and any(block[i:i + k + 1] in o for o in own):
                        k += 1
                    i, n = i + (k if any(block[i:i + k] in o for o in own) else 1), n + 1
            want.append(n)
        bits = np.array(want) * [np.log2(2 + sum(map(len, own))) for own in texts.values()]
        lang, score, fit = L._label(model, model.letter_of(), [text])
        assert bits[lang[0]] == bits.min() and fit[0] <= 1
        assert np.isclose(score[0], bits.max() / max(bits.sum(), 1))


def test_language_held_out_accuracy_and_edges(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    texts = L.sample(docs.filter(~L.held_out()))
    assert all(len(t) <= L.SAMPLE_BLOCKS and max(map(len, t)) <= L.BLOCK_CHARS for t in texts.values())
    found = L.identify(docs, texts).filter(L.held_out()).select("lang", "lang_pred", "score").collect()
    assert np.mean([r.lang == r.lang_pred for r in found]) > 0.97 and all(0 <= r.score <= 1 for r in found)
    edge = spark.createDataFrame(EDGE, "doc_id long, text string")
    assert [r.lang_pred for r in L.identify(edge.orderBy("doc_id").coalesce(1), texts).orderBy("doc_id").collect()] == ["en", "und", "und", "und", "en"]
    assert {r.lang_pred for r in L.identify(edge, {}).collect()} == {"und"}
    assert L.identify(edge.limit(0), texts).collect() == []


def test_language_of_a_small_sample(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").filter("length(text) > 100")
    texts = L.sample(docs.filter(~L.held_out()))
    for lang in texts:  # one with 4 blocks against 96
        few = {k: own[:4] if k == lang else own for k, own in texts.items()}
        found = L.identify(docs.filter(L.held_out()).filter(docs.lang == lang), few).collect()
        assert found and all(r.lang_pred == lang for r in found)


def test_sample_comes_from_whole_texts(spark):
    text = "0123456789" * 90 + "".join(chr(97 + i % 26) for i in range(1200))
    df = spark.createDataFrame([(text, "x")] * 3 + [(None, "x"), ("abc", None), ("12", "y")], "text string, lang string")
    blocks = [text[i:i + L.BLOCK_CHARS] for i in range(0, len(text), L.BLOCK_CHARS)]
    got = L.sample(df)
    assert set(got) == {"x"} and sorted(got["x"]) == sorted({b for b in blocks if any(c.isalpha() for c in b)})
    assert L.sample(df.limit(0)) == {}


def test_filter_by_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    texts = L.sample(docs.filter(~L.held_out()))
    rows = [(1, "the and of with this", 1), (1, "the and of with this", 1), (2, None, 1), (3, "12 !", 1), (4, "", 1), (5, "q", 1), (None, "of and the", 1),
            (6, "\u4eca\u65e5\u306f\u3068\u3066\u3082\u5929\u6c17\u304c\u3044\u3044\u3067\u3059\u306d" * 40, 1),  # a script nobody learned
            (7, "the and of with this ed er on " * 40000, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, `_lang.a` int").withColumnRenamed("_lang.a", "a.`b")
    kept = L.filter(df, texts)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "1", "5", "7", "None"]
    assert L.filter(df, texts, wanted={"de"}).filter("doc_id = 7").count() == 0
    assert sorted(str(r.doc_id) for r in L.filter(df, {}).collect()) == ["1", "1", "5", "6", "7", "None"]
    assert L.filter(df.limit(0), texts).collect() == []
    assert L.filter(docs, texts).count() == docs.filter(docs.text.rlike(r"\p{L}")).count()  # clean documents stay
    same = L.identify(spark.createDataFrame([(1, "aaaa bbbb")], "doc_id long, text string"), {"y": ["aaaa bbbb"], "x": ["aaaa bbbb"]}).first()
    assert same.lang_pred == "x" and same.score == 0.5  # a tie


def test_quality_held_out_and_edges(spark):
    sf = "/root/testdata/sf0.01"
    out = L.held_out("doc_id", 5, 0)
    model = Q.train(table(spark, sf, "documents"), table(spark, sf, "labels").filter(~out))
    scores = {r.doc_id: r.score for r in Q.scored(table(spark, sf, "documents").filter(out), model).collect()}
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{sf}/labels.parquet").to_pylist() if r["doc_id"] in scores}
    good, bad = ([scores[i] for i, q in labels.items() if q == want] for want in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert np.mean([g >= 0.3 for g in good]) > 0.95
    edge = spark.createDataFrame(EDGE, "doc_id long, text string")
    got = {r.doc_id: r.score for r in Q.scored(edge, model).collect()}
    assert got[1] == got[2] and got[None] == got[5] and all(0 <= s <= 1 for s in got.values())
    none = Q.train(edge, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r.score for r in Q.scored(edge, none).collect()} == {0.5}


def test_gradient_of_the_attention_model():
    rng = np.random.default_rng(1)
    x, per, y = rng.normal(size=(12, Q.WIDTH)), np.array([3, 1, 5, 3]), np.array([1.0, 0, 1, 0])
    model = Q.Model()
    grown = model._gradient(x, per, y)

    def loss():
        q = model._forward(x, per)[-1]
        return -np.mean(y * np.log(q) + (1 - y) * np.log(1 - q))
    for name in model.p:
        at = (0,) * model.p[name].ndim
        model.p[name][at] += 1e-5
        up = loss()
        model.p[name][at] -= 2e-5
        down = loss()
        model.p[name][at] += 1e-5
        assert np.isclose((up - down) / 2e-5, grown[name][at], atol=1e-7)


def test_strict_spans_against_the_patterns():
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    rng = random.Random(2)
    for _ in range(4000):
        t = "".join(rng.choice("ab.@-+ 1é%()") for _ in range(rng.randint(0, 30)))
        assert [(a, b) for k, a, b in P.strict(t) if k == 0] == [m.span() for m in email.finditer(t)]
    t = "é 1.2.3.4 and 1.2.3.4567, 4111 1111 1111 1111, 4111111111111112; 9 4111 1111 1111 1111 1 x +1 (437) 555-0689 +1 2"
    assert [(P.KINDS[k], t[a:b]) for k, a, b in P.strict(t)] == [
        ("ip", "1.2.3.4"), ("card", "4111 1111 1111 1111"), ("phone", "+1 (437) 555-0689")]


def test_labelers_em_and_added_spans(spark):
    rows = [(i, f"write to user{i}@mail.example.com or call phone (212) 555-01{i:02d} about order 4111.1111.1111.1112") for i in range(40)]
    rows += [(100, "contact jo [at] site [dot] org today"), (101, None), (102, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    counted = P.counts(df)
    ballots = np.array([c[1] for c in counted if c[0] == 0])
    p, share = P.reliabilities(ballots, np.array([c[3] for c in counted if c[0] == 0], float))
    assert ((0 <= p) & (p <= 1)).all() and np.allclose(share.sum(2), 1)
    found = {r.doc_id: [(s.kind, s.strict) for s in r.spans] for r in P.detect(df, P.train(counted)).collect()}
    assert found[101] == found[102] == []
    assert ("email", True) in found[3] and ("phone", False) in found[3]
    assert P.detect(df.limit(0), {}).collect() == [] and P.counts(df.limit(0)) == []


ITEM = ("A train leaves Boston at 60 km and meets the slower train from Denver after 3 hours on the way to Boston again today")


def test_decontamination(spark):
    bench = spark.createDataFrame([(1, ITEM), (2, "too short a thing here now"), (3, None), (4, "tiny")], "item_id long, text string")
    same = ITEM.replace("Boston", "Paris").replace("Denver", "Lyon").replace("60", "75").replace("3 ", "9 ")
    mixed = same.replace("way to Paris", "way to Rome")
    rows = [(1, f"x y. {ITEM.upper()} z"), (2, f"x y. {same}. z"), (3, f"x y. {mixed}. z"), (4, "TOO short a! thing HERE, now"),
            (5, None), (6, ""), (7, "tiny things"), (8, "A clean text about a train that leaves at 60 km"), (8, ITEM)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, hits int")
    found = D.matched(df, bench, name="found")
    got = sorted((r.doc_id, [h.item for h in r.found or []]) for r in found.collect())
    assert got == [(1, [1]), (2, [1]), (3, [1]), (4, [2]), (5, []), (6, []), (7, []), (8, []), (8, [1])]
    kept = D.filter(df, bench)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [5, 6, 7, 8]
    assert D.filter(df, bench.limit(0)).count() == len(rows) and D.filter(df.limit(0), bench).collect() == []


def test_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(D, "BLOCK", 1)
    bench = spark.createDataFrame([(1, ITEM), (2, "one two other words stand here")], "item_id long, text string")
    df = spark.createDataFrame([(1, ITEM + ". One two other words stand here.")], "doc_id long, text string")
    assert [[h.item for h in r.hits] for r in D.matched(df, bench).collect()] == [[1, 2]]


def test_passages_of_odd_texts():
    x, per = Q.encode(pa.array([None, "", "one", "word " * 200]))
    assert per.tolist() == [1, 1, 1, 4] and np.isfinite(x).all() and not x[:2].any()


def test_picked_passages_cover_a_text():
    assert Q.picked(5, 32).tolist() == [0, 1, 2, 3, 4] and Q.picked(0, 3).tolist() == []
    for count in (33, 1000, 100_000):
        own = Q.picked(count, 32)
        assert len(set(own.tolist())) == 32 and own[0] >= 0 and own[-1] < count and (np.diff(own) > 0).all()
        assert np.bincount(own * 4 // count, minlength=4).min() >= 1  # from all over the text


def test_quality_of_long_texts_empty_tables_repeats_and_clashing_columns(spark):
    rng = random.Random(2)
    good, bad = "the river runs past quiet fields".split(), "BUY NOW!! $$$ click %% win".split()
    text = lambda words, n: " ".join(rng.choice(words) for _ in range(n))
    rows = [(i, text(good if i % 2 else bad, 20 + i), "x", 0.5) for i in range(60)]
    rows += [(60, text(bad, 60_000), "x", 0.5), (61, text(good, 60_000), "x", 0.5), (62, None, "x", 0.5), (62, "", "x", 0.5)]
    rows += [(63, text(good, 40), "x", 0.5)] * 5 + [(None, text(bad, 40), "x", 0.5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `a.b` string, score double").withColumn("we`ird", F.lit(1))
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(64)] + [(None, 1, None), (5, None, None)],
                                   "doc_id long, quality int, `a.b` int")
    model = Q.train(docs, labels, sample=50, fitted=4)
    found = [(r.doc_id, r.score) for r in Q.scored(docs, model).collect()]
    assert len(found) == len(rows) and all(0 <= s <= 1 for _, s in found)
    by = dict(found)
    assert by[61] > 0.5 > by[60] and len({s for i, s in found if i == 63}) == 1 and len({s for i, s in found if i == 62}) == 1
    assert all((s > 0.5) == (i % 2 == 1) for i, s in found if i is not None and i < 60)
    again = Q.train(docs.repartition(5), labels.repartition(3), sample=50, fitted=4)
    assert np.allclose([again.p[k].sum() for k in again.p], [model.p[k].sum() for k in model.p])
    assert Q.scored(docs.limit(0), model).collect() == []
    assert Q.train(docs.limit(0), labels).constant == 0.5 and Q.train(docs, labels.limit(0)).constant == 0.5
