"""Personal data by weak supervision.

Four labelers (strict pattern, gazetteer, context, boundary) vote on each candidate span.
Expectation-maximisation estimates from the agreement of the votes alone how reliable each
labeler is for each kind; the resulting probabilities train a logistic span classifier.
Spans of the strict patterns always stay; the classifier adds looser ones
(addresses with written-out "at" or "dot", phone numbers without a plus, numbers with dots between
their groups, IPv6).

Votes and features are counted over all documents, and counts are all the driver sees: at most
kinds x 3^4 votes x 2^5 features rows, whatever the input.

Time is linear in a text's length: every pattern is anchored or possessive, spans are swept in order.
Texts are taken in slices of ``SLICE`` bytes, one whole text at least.

Edge cases: null or empty text has no spans. Offsets are code points, end exclusive. Strict spans of a kind
never overlap; added ones overlap no span of any kind, and of added ones that overlap the one of the kind listed first stays.
Rows with null ids keep them; repeated rows give equal lines. An empty table gives no
rows and trains nothing. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import ipaddress
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import named, query, row_slices, table

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("pattern", "gazetteer", "context", "boundary")
#: Probability from which a looser span is added.
ADD_FROM = 0.8
#: Bytes of text that a task holds as Python strings at once.
SLICE = 1 << 20

# The strict patterns.
EMAIL_REST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# the same matches as without the lookbehind: one that begins inside a run of digits could begin at the run's start
IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Looser candidates.
LOOSE = {
    "email": re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?[(\[]at[)\]] ?[A-Za-z0-9-]{1,63}"
                        r"(?: ?(?:\.|[(\[]dot[)\]]) ?[A-Za-z0-9-]{2,63}){1,4}"),
    "ip": re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"),
    "card": re.compile(r"(?<![0-9.])[0-9]{4}(?:[.][0-9]{4}){3}(?![0-9.])"),
    "phone": re.compile(r"(?<![0-9A-Za-z+.(-])(?:00[1-9][0-9]{0,2}[ .-]?)?\(?[0-9]{3}\)?[ .-][0-9]{3,4}[ .-][0-9]{4}(?![0-9A-Za-z-])"),
}
#: A cheap sign that a loose pattern may match at all.
SIGN = {"email": re.compile(r"[(\[]at[)\]]"), "ip": re.compile(r":[0-9A-Fa-f]{1,4}:"), "card": re.compile(r"[0-9]\.[0-9]{4}\."),
        "phone": re.compile(r"[0-9]\)?[ .-][0-9]{3}")}

# Gazetteers and context words.
DOMAINS = frozenset("com org net edu gov io co uk de fr es it nl eu info biz us ca au jp ch at be se".split())
FILES = frozenset("png jpg gif js css html htm pdf py txt zip".split())
COUNTRIES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 52 54 55 61 62 63 64 65 66 81 82 86 90 91".split())
CONTEXT = {
    "email": frozenset("email mail e-mail contact write correo courriel kontakt".split()),
    "ip": frozenset("ip address host server client adresse dirección".split()),
    "card": frozenset("card visa mastercard amex credit payment karte carte tarjeta".split()),
    "phone": frozenset("phone tel telephone call fax mobile cell telefon téléphone teléfono".split()),
}
AGAINST = frozenset("version release order invoice isbn chapter section page id commit build figure".split())
WORD = re.compile(r"[^\W\d_][\w-]*")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _is_ip(s: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in s.split("."))


def strict(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the strict patterns: leftmost, not overlapping per kind, failing ones dropped."""
    out = []
    at, free = text.find("@"), 0
    while at >= 0:
        lo = at
        while lo > free and text[lo - 1] in LOCAL_CHARS:
            lo -= 1
        m = EMAIL_REST.match(text, at) if lo < at else None
        if m:
            out.append((0, lo, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    if re.search("[0-9]", text):
        out += [(1, m.start(), m.end()) for m in IP.finditer(text) if _is_ip(m.group())]
        for m in CARD.finditer(text):
            d = _digits(m.group())
            if 16 <= len(d) <= 19 and luhn(d):
                out.append((2, m.start(), m.end()))
        if "+" in text:
            out += [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= len(_digits(m.group())) <= 15]
    return out


def loose(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Looser candidates that overlap nothing taken, nor one of a kind listed before."""
    out: list[tuple[int, int, int]] = []
    busy = sorted((a, b) for _, a, b in taken)
    for k, kind in enumerate(KINDS):
        if SIGN[kind].search(text):
            own = []
            at, reach = 0, 0  # spans in front of the candidate's end, and how far they reach
            for m in LOOSE[kind].finditer(text):
                lo, hi = m.span()
                while at < len(busy) and busy[at][0] < hi:
                    reach = max(reach, busy[at][1])
                    at += 1
                if reach <= lo:
                    own.append((lo, hi))
            out += [(k, lo, hi) for lo, hi in own]
            busy = sorted(busy + own)
    return out


def votes(text: str, span: tuple[int, int, int], is_strict: bool) -> tuple[int, int, int, int]:
    """One vote per labeler: 1 for, -1 against, 0 abstains."""
    k, lo, hi = span
    kind, s = KINDS[k], text[lo:hi]
    d = _digits(s)
    if kind == "email":
        pattern = 1 if is_strict or len(s) >= 8 else 0
        last = re.split(r"[.\])\s]+", s)[-1].lower()
        gazetteer = 1 if last in DOMAINS else -1 if last in FILES else 0
    elif kind == "ip":
        pattern = 1 if is_strict or s.count(":") == 7 else -1
        gazetteer = 0
        try:
            gazetteer = -1 if ipaddress.ip_address(s).is_unspecified else 1
        except ValueError:
            pass
    elif kind == "card":
        pattern = 1 if luhn(d) and len(d) >= 13 else -1
        gazetteer = 1 if d[:1] in "3456" else -1
    else:
        pattern = 1 if 8 <= len(d) <= 15 else -1
        code = d[2:] if d.startswith("00") else d
        if s.startswith("+") or d.startswith("00"):
            gazetteer = 1 if any(code[:n] in COUNTRIES for n in (1, 2)) else -1
        else:
            gazetteer = 1 if "2" <= code[:1] <= "9" else -1
    near = {w.lower() for w in WORD.findall(text[max(0, lo - 40):lo])[-4:]}
    context = 1 if near & CONTEXT[kind] else -1 if near & AGAINST else 0
    before, after = text[lo - 1:lo], text[hi:hi + 1]
    boundary = -1 if before.isalnum() or after.isalnum() or before in ("#", "$", "/") and before else 1
    return pattern, gazetteer, context, boundary


def features(text: str, span: tuple[int, int, int]) -> int:
    """Five bits that the final classifier sees beside the votes."""
    _, lo, hi = span
    s = text[lo:hi]
    around = text[max(0, lo - 1):lo] + text[hi:hi + 1]
    return (any(c in s for c in " -()") | (any(c in s for c in ".:") << 1) | ((hi - lo >= 14) << 2)
            | (any(c.isspace() for c in around) << 3) | (any(c.isalpha() for c in s) << 4))


def _candidates(text: str):
    taken = strict(text)
    return [(s, True) for s in taken] + [(s, False) for s in loose(text, taken)]


def _slices(column: pa.Array):
    """Number of the first row, and texts, of slices of bounded size; null is empty."""
    whole = pc.fill_null(column, "")
    size = np.concatenate([[0], np.cumsum(np.asarray(pc.binary_length(whole), np.int64))])
    for lo, hi in row_slices(len(whole), size, SLICE):
        yield lo, whole.slice(lo, hi - lo).to_pylist()


def counts(docs: DataFrame, text_col: str = "text") -> list[tuple[int, tuple, int, int]]:
    """(kind, votes, features, candidates) over all documents."""
    def run(batches):
        for batch in batches:
            seen: dict[tuple, int] = {}
            for _, texts in _slices(batch.column(0)):
                for text in texts:
                    for span, is_strict in _candidates(text):
                        key = (span[0], sum((v + 1) * 3 ** i for i, v in enumerate(votes(text, span, is_strict))),
                               features(text, span))
                        seen[key] = seen.get(key, 0) + 1
            columns = list(zip(*[(*k, n) for k, n in seen.items()])) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["kind", "votes", "features", "n"])

    found = docs.select(named(text_col).cast("string").alias("text")).mapInArrow(
        run, "kind long, votes long, features long, n long").groupBy("kind", "votes", "features").agg(F.sum("n").alias("n"))
    return [(r.kind, tuple(r.votes // 3 ** i % 3 - 1 for i in range(len(LABELERS))), r.features, r.n)
            for r in found.orderBy("kind", "votes", "features").collect()]


def reliabilities(ballots: np.ndarray, weight: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """EM over votes: the probability that each ballot is personal data, and each labeler's vote shares.

    Shares are (true or not) x labeler x vote, with one pseudo-count per cell; labelers
    start better than chance, which fixes the meaning of the two classes.
    """
    onehot = ballots[:, :, None] == np.array([-1, 0, 1])
    p = 1 / (1 + np.exp(-ballots.sum(1).astype(float)))
    share = np.zeros((2, ballots.shape[1], 3))
    for _ in range(rounds):
        for t, w in enumerate((weight * (1 - p), weight * p)):
            cell = (onehot * w[:, None, None]).sum(0) + 1
            share[t] = cell / cell.sum(1, keepdims=True)
        prior = (weight @ p + 1) / (weight.sum() + 2)
        odds = np.log(prior / (1 - prior)) + (onehot * np.log(share[1] / share[0])).sum((1, 2))
        p = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return p, share


def _inputs(ballot: tuple, bits: int) -> list[float]:
    return [1.0, *map(float, ballot), *[float(bits >> k & 1) for k in range(5)]]


def train(counted: list[tuple[int, tuple, int, int]]) -> dict[int, np.ndarray]:
    """Weights of the span classifier per kind: logistic regression on the EM probabilities (Newton steps)."""
    out = {}
    for kind in sorted({c[0] for c in counted}):
        own = [c for c in counted if c[0] == kind]
        ballots = np.array([c[1] for c in own])
        n = np.array([c[3] for c in own], float)
        p, _ = reliabilities(ballots, n)
        x = np.array([_inputs(c[1], c[2]) for c in own])
        w = np.zeros(x.shape[1])
        for _ in range(25):
            q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            gradient = x.T @ (n * (p - q)) - w
            curve = (x * (n * q * (1 - q))[:, None]).T @ x + np.eye(len(w))
            w += np.linalg.solve(curve, gradient)
        out[kind] = w
    return out


def detect(docs: DataFrame, weights: dict[int, np.ndarray], id_col: str = "doc_id", text_col: str = "text",
           add_from: float = ADD_FROM) -> DataFrame:
    """id and spans (kind, start, end, strict, score), by kind as listed and start."""
    id_type = docs.select(named(id_col)).schema[0].dataType.simpleString()
    spans = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("strict", pa.bool_()),
                                ("score", pa.float64())]))

    def score(text, span, is_strict) -> float:
        w = weights.get(span[0])
        if w is None:
            return 1.0 if is_strict else 0.0
        return float(1 / (1 + np.exp(-np.dot(_inputs(votes(text, span, is_strict), features(text, span)), w))))

    def run(batches):
        for batch in batches:
            for lo, texts in _slices(batch.column(1)):
                found = []
                for text in texts:
                    own = [(*s, is_strict, score(text, s, is_strict)) for s, is_strict in _candidates(text)]
                    found.append([{"kind": KINDS[k], "start": a, "end": b, "strict": t, "score": p}
                                  for k, a, b, t, p in sorted(own) if t or p >= add_from])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, len(texts)), pa.array(found, spans)], ["id", "spans"])

    return docs.select(named(id_col).alias("id"), named(text_col).cast("string").alias("text")).mapInArrow(
        run, f"id {id_type}, spans array<struct<kind:string,start:long,end:long,strict:boolean,score:double>>"
    ).withColumnRenamed("id", id_col)


def _listed(spans: str) -> str:
    return f"concat_ws(',', transform({spans}, s -> concat_ws(':', s.kind, s.start, s.end)))"


@query("op4_pii")
def op4(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = detect(docs, train(counts(docs)))
    base = "filter(spans, s -> s.strict)"
    columns = [F.expr(f"cast(size(filter(spans, s -> s.strict AND s.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *columns, F.sha2(F.expr(_listed(base)), 256).alias("base_sha256"),
                        F.expr(_listed("spans")).alias("spans"))
