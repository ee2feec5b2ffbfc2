"""Personal data: every contract column against plain patterns, linear time, learned reliabilities, odd tables."""

import hashlib
import random
import re
import time

import numpy as np

from telemill.llm import pii as P

# The contract's patterns, as they are.
PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def valid(kind, s):
    digits = [int(c) for c in s if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in s.split("."))
    if kind == "card":
        double = [d if i % 2 == 0 else d * 2 // 10 + d * 2 % 10 for i, d in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(double) % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def plain(text):
    return [(k, *m.span()) for k, p in PLAIN.items() for m in re.finditer(p, text or "") if valid(k, m.group())]


def listed(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def test_query_against_the_patterns(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    found = P.op4(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in found) == sorted(texts) and any(plain(t) for t in texts.values())
    for r in found:
        base = plain(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, _, _ in base) for kind in PLAIN]
        assert r.base_sha256 == hashlib.sha256(listed(base).encode()).hexdigest()
        assert set(listed(base).split(",")) <= set(r.spans.split(","))


def test_strict_spans_of_random_texts():
    rng = random.Random(4)
    for alphabet in ("12.5 ", "0123456789.. ", "41 -1", "+(1) 2.3-", "a.@1-+%2 "):
        for _ in range(3000):
            t = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))
            assert [(P.KINDS[k], a, b) for k, a, b in P.strict(t)] == plain(t)
    for _ in range(300):  # valid and invalid cards of all lengths, written with blanks and hyphens
        digits = "".join(rng.choice("0123456789") for _ in range(rng.randint(14, 20)))
        t = "x " + "".join(d + rng.choice(["", "", " ", "-"]) for d in digits) + "x"
        assert [(P.KINDS[k], a, b) for k, a, b in P.strict(t)] == plain(t)


def test_loose_spans_against_all_pairs():
    rng = random.Random(6)
    parts = ["jo [at] site [dot] org", "4111.1111.1111.1112", "(212) 555-0123", "1:2:3:4:5:6:7:8", "a@b.org", "1.2.3.4", "+1 212 555 0123",
             "212-555-0123", "x", "4111 1111 1111 1111", "[at] 212 555 4111.1111.1111.1111"]
    for _ in range(500):
        t = rng.choice([" ", ", ", "."]).join(rng.choice(parts) for _ in range(rng.randint(1, 12)))
        taken = P.strict(t)
        busy, want = [(a, b) for _, a, b in taken], []
        for k, kind in enumerate(P.KINDS):
            for m in P.LOOSE[kind].finditer(t):
                if P.SIGN[kind].search(t) and all(m.end() <= a or b <= m.start() for a, b in busy):
                    busy.append(m.span())
                    want.append((k, *m.span()))
        assert P.loose(t, taken) == want


def test_long_texts_take_linear_time():
    units = ["1", "a@b.org ", "+1 212 555 0123 ", "1.2.3.4 ", "(212) 555-0123 ", "1.", "a@", "jo [at] x [dot] org ", "4111 1111 1111 1111, ", "+1 ", "a.", "[at]"]
    for unit in units:
        took = []
        for size in (100_000, 800_000):
            text = unit * (size // len(unit))
            start = time.process_time()
            P._candidates(text)
            took.append(time.process_time() - start)
        assert took[1] < 30 * max(took[0], 0.02)  # eight times as long; a square would take 64 times


def test_reliabilities_of_planted_labelers():
    rng = np.random.default_rng(7)
    n, true_rate, right = 20_000, 0.4, [0.95, 0.8, 0.7, 0.9]
    truth = rng.random(n) < true_rate
    ballots = np.array([np.where(rng.random(n) < r, truth, ~truth) for r in right]).T * 2 - 1
    kinds, weight = np.unique(ballots, axis=0, return_counts=True)
    p, share = P.reliabilities(kinds, weight.astype(float), rounds=500)
    for k, r in enumerate(right):
        assert abs(share[1, k, 2] - r) < 0.03 and abs(share[0, k, 0] - r) < 0.03
    assert abs(weight @ p / n - true_rate) < 0.03


def test_added_spans_of_planted_text(spark):
    rows = [(i, f"mail me: user{i}@site.org now") for i in range(60)]
    rows += [(100 + i, f"please contact jo{i} [at] site [dot] org today") for i in range(60)]
    rows += [(200 + i, f"see figure x{i}x [at] tmp{i}.png8 here") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: [(s.kind, s.strict) for s in r.spans] for r in P.detect(df, P.train(P.counts(df))).collect()}
    assert all(found[i] == [("email", True)] for i in range(60))
    assert all(found[100 + i] == [("email", False)] for i in range(60))


def test_odd_tables(spark):
    mail = "write to a@b.org"
    rows = [(1, mail, "x"), (1, mail, "x"), (None, mail, "y"), (2, None, None), (3, "", None), (4, "w " * 1_000_000 + mail, None)]
    df = spark.createDataFrame(rows, "`a.b` long, text string, spans string").withColumnRenamed("a.b", "n`o")
    found = P.detect(df, P.train(P.counts(df)), "n`o").collect()
    got = sorted((str(r[0]), [(s.start, s.end) for s in r.spans]) for r in found)
    assert got == [("1", [(9, 16)]), ("1", [(9, 16)]), ("2", []), ("3", []), ("4", [(2_000_009, 2_000_016)]), ("None", [(9, 16)])]
    assert P.detect(df.limit(0), P.train([]), "n`o").collect() == []
