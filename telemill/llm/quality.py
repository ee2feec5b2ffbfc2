"""Quality scores by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words. Every passage is encoded (shares
of letters, marks, repeats, and hashed words, then a learned layer); gated attention weights,
learned from document labels alone, say how much each passage counts; the weighted
representation is scored.

The model is fitted on a bounded sample: the ``SAMPLE`` labelled training documents with the smallest hash of their id (should
ids repeat, the ``SAMPLE`` rows of them with the smallest hash of their encoding), and of a text with more than
``FITTED`` passages that many, picked by hash all over the text. What reaches the driver is at most
``SAMPLE * FITTED`` vectors of ``WIDTH`` floats (18 MB), whatever the lengths of the texts. Scores cover all
passages of all documents.

Edge cases: a null, empty or wordless text is one empty passage and is scored as such. Labels
that are null are no labels; of several labels of one document the smallest counts. Without
labels of both kinds every score is the share of label 1 (0.5 without any). Repeated rows get equal scores. Texts of any length are
scored whole, an empty table gives no rows. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import anchors, segment_join as S
from .common import named, query, stored, table
from .language import held_out

PASSAGE = 64
SAMPLE = 4000
FITTED = 32
HASHED = 16
MARKS = b"!#$%&*|?:;-_/\\\"'()[]{}<>=+@^~`"
SINGLE = b"!#$%&*|"
WIDTH = 13 + len(SINGLE) + HASHED


def encode(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages (float32), and how many each text has (one at least)."""
    raw, offsets = anchors.text_buffers(texts)
    start, end, word, first = anchors.words(raw, offsets)
    count = np.diff(first)
    per = np.maximum(-(-count // PASSAGE), 1)
    out = np.zeros((int(per.sum()), WIDTH), np.float32)
    base = np.cumsum(per) - per
    if not len(word):
        return out, per
    text = np.repeat(np.arange(len(count)), count)
    place = np.arange(len(word)) - first[text]
    passage = base[text] + place // PASSAGE
    head = np.flatnonzero(np.concatenate([[True], passage[1:] != passage[:-1]]))
    own = passage[head]
    tail = np.concatenate([head[1:], [len(word)]])
    n = (tail - head).astype(np.float64)
    lo, hi = start[head], end[tail - 1]

    def share(of: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(of, dtype=np.int64)])
        return (total[hi] - total[lo]).astype(np.float64)

    letters = np.maximum(share(((raw | 32) >= 97) & ((raw | 32) <= 122) | (raw >= 128)), 1)
    size = (hi - lo).astype(np.float64)
    new = np.zeros(len(word), bool)  # first of its word in the passage, in the text
    order = np.lexsort((np.arange(len(word)), word, text))
    seen = np.ones(len(word), bool)
    seen[1:] = (word[order][1:] != word[order][:-1]) | (text[order][1:] != text[order][:-1])
    new_in_text = np.zeros(len(word), bool)
    new_in_text[order] = seen
    here = seen.copy()
    here[1:] |= passage[order][1:] != passage[order][:-1]
    new[order] = here
    twin = np.zeros(len(word), bool)
    twin[1:] = (word[1:] == word[:-1]) & (passage[1:] == passage[:-1])

    def per_word(of: np.ndarray) -> np.ndarray:
        return np.add.reduceat(of.astype(np.float64), head) / n

    marks = np.isin(raw, np.frombuffer(MARKS, np.uint8))
    in_text = np.add.reduceat(new_in_text.astype(np.float64), first[:-1][count > 0]) / count[count > 0]
    of_text = np.zeros(len(count))
    of_text[count > 0] = in_text
    columns = [
        size / n / 10, share((raw >= 65) & (raw <= 90)) / letters, share((raw >= 48) & (raw <= 57)) / size,
        share(marks) / size, share((raw == 46) | (raw == 44)) / n, share(raw == 10) / n, per_word(new), per_word(twin),
        share(raw >= 128) / size, np.log1p(n) / 5, per_word(new_in_text), of_text[text[head]],
        np.log1p(count[text[head]]) / 10,
        *[share(raw == c) / n for c in SINGLE]]
    out[own, :len(columns)] = np.stack(columns, 1)
    bucket = (word & np.uint64(HASHED - 1)).astype(np.int64)
    sign = np.where(word & np.uint64(HASHED), 1.0, -1.0)
    flat = np.bincount(passage * HASHED + bucket, sign, minlength=len(out) * HASHED)
    out[own, len(columns):] = (flat.reshape(-1, HASHED)[own] / np.sqrt(n)[:, None]) * 0.3
    return out, per


def picked(count: int, most: int) -> np.ndarray:
    """Places of at most ``most`` of ``count`` passages, in order: those with the smallest hash of their place."""
    if count <= most:
        return np.arange(count)
    mixed = np.arange(1, count + 1, dtype=np.uint64) * np.uint64(anchors.BASE)
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(anchors.BASE)
    return np.sort(np.argsort(mixed, kind="stable")[:most])


class Model:
    """Gated attention over passages, fitted by Adam on the log loss of document labels."""

    HIDDEN, GATE, EPOCHS, BATCH, RATE, DECAY = 16, 8, 40, 256, 0.01, 1e-4

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        h, a = self.HIDDEN, self.GATE
        self.p = {"w": rng.normal(0, WIDTH ** -0.5, (WIDTH, h)), "b": np.zeros(h), "v": rng.normal(0, h ** -0.5, (h, a)),
                  "u": rng.normal(0, h ** -0.5, (h, a)), "g": rng.normal(0, a ** -0.5, a), "c": rng.normal(0, h ** -0.5, h),
                  "c0": np.zeros(1)}
        self.mean, self.scale, self.constant = np.zeros(WIDTH), np.ones(WIDTH), None

    def _forward(self, x: np.ndarray, per: np.ndarray):
        p = self.p
        start = np.cumsum(per) - per
        bag = np.repeat(np.arange(len(per)), per)
        hidden = np.tanh(x @ p["w"] + p["b"])
        t, s = np.tanh(hidden @ p["v"]), 1 / (1 + np.exp(-(hidden @ p["u"])))
        e = (t * s) @ p["g"]
        e = np.exp(e - np.maximum.reduceat(e, start)[bag])
        a = e / np.add.reduceat(e, start)[bag]
        z = np.add.reduceat(hidden * a[:, None], start)
        return start, bag, hidden, t, s, a, z, 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["c0"][0], -30, 30)))

    def _gradient(self, x: np.ndarray, per: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        start, bag, hidden, t, s, a, z, q = self._forward(x, per)
        d = (q - y) / len(y)
        dz = d[:, None] * p["c"]
        da = (dz[bag] * hidden).sum(1)
        de = a * (da - np.add.reduceat(a * da, start)[bag])
        dts = de[:, None] * p["g"]
        dt, ds = dts * s * (1 - t * t), dts * t * s * (1 - s)
        dh = a[:, None] * dz[bag] + dt @ p["v"].T + ds @ p["u"].T
        dx = dh * (1 - hidden * hidden)
        return {"w": x.T @ dx, "b": dx.sum(0), "v": hidden.T @ dt, "u": hidden.T @ ds, "g": (t * s).T @ de,
                "c": z.T @ d, "c0": np.array([d.sum()])}

    def fit(self, x: np.ndarray, per: np.ndarray, y: np.ndarray, seed: int = 11) -> "Model":
        if len(y) == 0 or y.min() == y.max():
            self.constant = float(y.mean()) if len(y) else 0.5
            return self
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-3
        x = (x - self.mean) / self.scale
        start = np.cumsum(per) - per
        rng = np.random.default_rng(seed)
        m = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        step = 0
        for _ in range(self.EPOCHS):
            order = rng.permutation(len(y))
            for lo in range(0, len(y), self.BATCH):
                some = order[lo:lo + self.BATCH]
                rows = np.concatenate([np.arange(start[i], start[i] + per[i]) for i in some])
                step += 1
                for k, g in self._gradient(x[rows], per[some], y[some]).items():
                    g = g + self.DECAY * self.p[k]
                    one, two = m[k]
                    one += 0.1 * (g - one)
                    two += 0.001 * (g * g - two)
                    self.p[k] = self.p[k] - self.RATE * (one / (1 - 0.9 ** step)) / (np.sqrt(two / (1 - 0.999 ** step)) + 1e-8)
        return self

    def score(self, x: np.ndarray, per: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(per), self.constant)
        return self._forward((x - self.mean) / self.scale, per)[-1]


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          sample: int = SAMPLE, fitted: int = FITTED) -> Model:
    """Fit on at most ``sample`` labelled documents and ``fitted`` passages of each; only their features reach the driver."""
    some = labels.select(named(id_col).alias("id"), named(label_col).cast("int").alias("label")).filter(
        "id IS NOT NULL AND label IS NOT NULL").groupBy("id").agg(F.min("label").alias("label"))
    some = some.orderBy(F.xxhash64("id"), "id").limit(sample)
    rows = docs.select(named(id_col).alias("id"), F.coalesce(named(text_col).cast("string"), F.lit("")).alias("text")).join(
        F.broadcast(some), "id")

    def run(batches):
        for batch in batches:
            for lo, texts in S.slices(batch.column("text")):
                x, per = encode(texts)
                ends = np.cumsum(per)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(lo, len(texts)), batch.column("label").slice(lo, len(texts)),
                     pa.array([x[b - n + picked(n, fitted)].tobytes() for b, n in zip(ends, per)], pa.binary())],
                    ["id", "label", "passages"])

    kind = rows.schema["id"].dataType.simpleString()
    encoded = rows.select("id", "label", "text").mapInArrow(run, f"id {kind}, label int, passages binary")
    bounded = stored(encoded.orderBy(F.xxhash64("id", "passages"), "id", "passages").limit(sample), "fit")
    found = sorted(bounded.collect(), key=lambda r: (r.id, r.passages))
    bags = [np.frombuffer(r.passages, np.float32).reshape(-1, WIDTH) for r in found]
    x = np.concatenate(bags).astype(np.float64) if bags else np.zeros((0, WIDTH))
    return Model().fit(x, np.array([len(b) for b in bags], np.int64), np.array([float(r.label > 0) for r in found]))


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and score (0 to 1) of every document."""
    kind = docs.select(named(id_col)).schema[0].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for lo, texts in S.slices(batch.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, len(texts)), pa.array(model.score(*encode(texts)).astype(np.float64))],
                    ["id", "score"])

    return docs.select(named(id_col).alias("id"), named(text_col).cast("string").alias("text")).mapInArrow(
        run, f"id {kind}, score double").withColumnRenamed("id", id_col)


@query("op7_quality")
def op7(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = held_out("doc_id", 5, 0)
    model = train(docs, table(spark, sf_dir, "labels").filter(~out))
    return scored(docs, model).select(
        "doc_id", out.alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))
