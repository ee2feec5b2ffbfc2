"""Decontamination: names wherever and however they are written, slots of numbers and names."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa

from telemill.llm import decontamination as D

TOM = "Tom has 3 pens. Ann has 5 pens. Who has more pens?"
PAY = "What will the farmer pay for the apples if Maria sells 40 of them at the market on Sunday morning?"


def found(spark, items, texts):
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id long, text string")
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = sorted((r.doc_id, sorted(h.item for h in r.hits or [])) for r in D.matched(docs, bench).collect())
    return [items for _, items in rows]


def test_names_that_open_a_sentence(spark):
    assert found(spark, [TOM], ["Bob has 4 pens. Eve has 9 pens. Who has more pens?", "Bob has 4 pens. Eve has 9 cups. Who has more pens?",
                                "Bob has 4 pens. Bob has 9 pens. Who has more pens?"]) == [[0], [], []]
    books = "Books cost 5 dollars each in the shop on the corner but 3 in the market"
    assert found(spark, [books], [books.replace("5", "8").lower(), "So " + books.replace("5", "8")]) == [[0], [0]]


def test_text_in_front(spark):
    other = PAY.replace("Maria", "Elena").replace("40", "70")
    fronts = ["Homework 7\n", "Homework 7 ", "(7) ", "Answer this, ", "Start. "]
    assert found(spark, [PAY], [f + other for f in fronts]) == [[0]] * 5
    assert found(spark, [f + PAY for f in fronts], [other]) == [list(range(5))]
    # thirteen words: the only window holds the opening word
    short = "What will the farmer pay if Maria sells 40 apples at the market?"
    other = short.replace("Maria", "Elena").replace("40", "70")
    assert found(spark, [short], [f + other for f in fronts]) == [[0]] * 5


def test_case_of_the_document(spark):
    other = PAY.replace("Maria", "Elena").replace("40", "70")
    assert found(spark, [PAY], [other.lower(), other.upper(), other.title()]) == [[0]] * 3
    assert found(spark, [PAY], [other.replace("apples", "pears").lower()]) == [[]]


def test_readings_of_an_opening_word(spark):
    # the second Boston clashes with the first as a name, but its sentence may also just differ there
    item = "Boston is far from here and the train to Boston takes 4 hours on a good day in the summer."
    text = "Boston is far from here and the train to Paris takes 9 hours on a good day in the summer."
    assert found(spark, [item], [text, text.replace("to Paris", "to home")]) == [[0], [0]]


SHOP = ("a box with 3 red pens and 8 blue pens is sold for 5 coins and the buyer takes 5 of them home before the shop "
        "shuts at 6 so how much is left for all the others who come later")


def windows(spark, item, text):
    bench = spark.createDataFrame([(0, item)], "item_id long, text string")
    docs = spark.createDataFrame([(0, text)], "doc_id long, text string")
    return sum(h.template for h in D.matched(docs, bench).first().hits or [])


def test_two_numbers_may_become_one(spark):
    assert found(spark, [SHOP], [SHOP.replace("3", "7").replace("8", "7")]) == [[0]]
    assert windows(spark, SHOP, SHOP.replace("3", "7").replace("8", "7")) == windows(spark, SHOP, SHOP) > 0


def test_a_clash_of_numbers_clears_its_windows_only(spark):
    # 5 coins and 5 of them stand 6 words apart: 7 of the windows hold both
    item, text = SHOP.split(), SHOP.replace("for 5", "for 9").replace("takes 5", "takes 4").split()
    clash = [item.index("5"), len(item) - 1 - item[::-1].index("5")]
    starts = range(len(item) - 12)
    slots = [{i for i in range(s, s + 13) if item[i].isdigit()} for s in starts]
    good = [s for s in starts if slots[s] and not set(clash) <= slots[s]]
    assert windows(spark, SHOP, SHOP) - len(good) == sum(set(clash) <= own for own in slots) > 0
    assert windows(spark, SHOP, " ".join(text)) == len(good)
    assert found(spark, [SHOP], [" ".join(text[a:b]) for a, b in [(18, 31), (10, 31), (0, 31), (0, 41)]]) == [[0]] * 4
    assert found(spark, [SHOP], [" ".join(text[clash[0] - 3:clash[0] + 10])]) == [[]]  # only windows with both


def test_a_clash_of_names_clears_its_windows_only(spark):
    # the two Boston stand 18 words apart, so no window of 13 holds both; Denver and the second Boston share some
    item = "the train from Boston to the lake stops 3 times on its way so the guests reach Denver after it left Boston for the night"
    text = item.replace("from Boston", "from Paris").replace("left Boston", "left Rome").replace("Denver", "Lyon")
    assert found(spark, [item], [text, text.replace("Lyon", "Rome")]) == [[0], [0]]
    assert windows(spark, item, text) == windows(spark, item, item)
    assert 0 < windows(spark, item, text.replace("Lyon", "Rome")) < windows(spark, item, item)
    near = "the guests who reach Denver before night leave Denver when the sun is up"
    assert found(spark, [near], [near.replace("reach Denver", "reach Lyon").replace("leave Denver", "leave Rome")]) == [[]]


def test_slots_against_each_window():
    rng = random.Random(5)
    size, length = 60, 13
    for _ in range(400):
        pairs = [(j, rng.choice((D.NUM, D.UNIT, D.NAME)), rng.choice("12"), rng.choice("789")) for j in range(size)
                 if rng.random() < 0.15]
        want = 0
        for s in range(size - length + 1):
            own = {(k, a, b) for j, k, a, b in pairs if s <= j < s + length}
            names = [(a, b) for k, a, b in own if k == D.NAME]
            want += len({(k, a) for k, a, _ in own}) == len(own) and len({b for _, b in names}) == len(names)
        assert D._steady(pairs, size - length + 1, length) == want


def test_literal_words_of_a_window(spark):
    five = "in 1 2 3 4 5 6 7 8 the row of numbers"
    six = "in 1 2 3 4 5 6 7 the long row of numbers"
    assert len(five.split()) == len(six.split()) == D.WINDOW
    other = [t.translate(str.maketrans("12345678", "87654321")) for t in (five, six)]
    assert found(spark, [five, six], other) == [[], [1]]
    # an item shorter than a window: five are enough
    assert found(spark, ["in 1 2 3 4 the row of numbers"], ["in 9 8 7 6 the row of numbers"]) == [[0]]


def test_blocks_share_one_step(spark, monkeypatch):
    monkeypatch.setattr(D, "BLOCK", 1)
    items = [TOM, PAY, SHOP]
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id long, text string")
    docs = spark.createDataFrame([(0, f"{SHOP}. {TOM}"), (1, PAY), (2, None)], "doc_id long, text string")
    out = D.matched(docs, bench)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    assert sorted((r.doc_id, [h.item for h in r.hits]) for r in out.collect()) == [(0, [0, 2]), (1, [1]), (2, [])]


def test_columns_of_words_against_single_words(spark, sf_dir):
    texts = [r.text or "" for name in ("documents", "benchmark") for r in spark.read.parquet(f"{sf_dir}/{name}.parquet").collect()]
    words = {w for t in texts for w in re.split(r"[ \t-\r]+", t)} - {""}
    rng = random.Random(1)
    words |= {"".join(rng.choice("aBzÄéßªİǅ日5½.,!?_-$'\u0301") for _ in range(rng.randint(1, 5))) for _ in range(20_000)}
    words |= {mark(w) + end for w in [*D.NUMBERS, *D.UNITS, *D.COMMON] for mark in (str, str.title, str.upper) for end in ("", ".", ",;", "!)")}
    words = sorted(words)
    spelled, number, unit, fits = D._words(pa.array(words))
    want = [D._word(w) for w in words]
    assert spelled.to_pylist() == [w for w, _ in want]
    got = [(1 if n else 0) | (2 if u else 0) | (16 if f else 0) for n, u, f in zip(number, unit, fits)]
    assert got == [b & 19 for _, b in want]
    assert [len(x) for x in D._words(pa.array([], pa.string()))] == [0] * 4


def bare(text):
    return [w for w in (re.sub(r"[\W_]+", "", raw.lower()) for raw in re.split(r"[ \t-\r]+", text or "")) if w]


def test_plain_windows_against_a_loop(spark, sf_dir):
    docs, bench = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "benchmark"))
    held = defaultdict(Counter)
    for r in bench.collect():
        words = bare(r.text)
        n = min(len(words), D.WINDOW)
        for i in range(len(words) - n + 1 if n >= D.LEAST else 0):
            held[tuple(words[i:i + n])][r.item_id] += 1
    sizes = {len(w) for w in held}
    want = {}
    for r in docs.collect():
        words, own = bare(r.text), Counter()
        for n in sizes:
            for i in range(len(words) - n + 1):
                own.update(held.get(tuple(words[i:i + n]), {}))
        want[r.doc_id] = dict(own)
    got = {r.doc_id: {h.item: h.plain for h in r.hits if h.plain} for r in D.matched(docs, bench).collect()}
    assert got == want and any(want.values())
