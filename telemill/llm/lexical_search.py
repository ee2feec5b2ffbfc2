"""Ranked lexical search by presence masks.

Terms are runs of ASCII letters and digits and of all other characters, with A to Z lower-cased. One pass over the
documents keeps of each its number of terms and the frequencies of terms that some item holds (``hits``); the
counts N, L and df come from all documents. A second pass scores: a task takes the documents of its
part in blocks, sets a bit for each term of an item that a document holds, and groups the documents by this
mask. A mask's maximum score adds up, over its terms, the best weight any document of the block reaches. Masks are
evaluated from the highest maximum down, and an item is finished in the block as soon as the next maximum is below
the score of the last of its best documents so far (an equal maximum is still evaluated: a smaller id may win).
The best of the blocks before carry over to the next, so later blocks are finished sooner. A task hands on at most
``TOP`` documents of an item; no pair of item and document is ever formed otherwise.

Items come to the tasks in blocks of about ``ITEM_BYTES`` of text, whatever the number of items.

Edge cases: null or wordless texts have no terms, are in no count and match nothing. An item without terms, or whose
terms all weigh 0, has no rows. Every row of ``documents`` is a document of its own, repeated rows too; equal
scores go by id, nulls last. Items equal in id and text are one item. Empty tables give no rows. Other columns
are not read, whatever their names.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .anchors import text_buffers
from .common import query, stored, table

TOP = 10
#: Bytes of item texts that are searched for in one go; a longer item is a block of its own.
ITEM_BYTES = 1 << 17
#: Bytes of text split into terms at once.
PIECE = 1 << 22
#: Cells of a block: documents times terms.
CELLS = 1 << 24
#: Documents that are scored at once, in the order of their masks' maximum.
STEP = 128

_TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def terms(text: bytes):
    """Terms of a text (UTF-8), a list at a time; bytes.lower folds A to Z only."""
    at = 0
    while at < len(text):
        to = min(len(text), at + PIECE)
        if to < len(text) and (inside := _TERM.match(text, to)):
            to = inside.end()
        yield _TERM.findall(text[at:to].lower())
        at = to


def hits(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """id, n (terms), term and tf (arrays: terms of the vocabulary that the document holds) of documents with terms."""
    narrow = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")).filter(
        "text IS NOT NULL AND text != ''")
    kind = narrow.schema["id"].dataType.simpleString()
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        number = known.value.get
        for batch in batches:
            raw, offsets = text_buffers(batch.column("text"))
            n, at, term, tf = [], [], [], []
            for i in range(batch.num_rows):
                held: Counter = Counter()
                size = 0
                for some in terms(raw[offsets[i]:offsets[i + 1]].tobytes()):
                    size += len(some)
                    held.update(map(number, some))
                held.pop(None, None)
                if size:
                    at.append(i)
                    n.append(size)
                    term.append(list(held.keys()))
                    tf.append(list(held.values()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(at, pa.int64())), pa.array(n, pa.int64()), pa.array(term, pa.list_(pa.int32())),
                 pa.array(tf, pa.list_(pa.int64()))], ["id", "n", "term", "tf"])

    return narrow.mapInArrow(run, f"id {kind}, n long, term array<int>, tf array<long>")


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def _best(score: np.ndarray, ids: list, top: int) -> list[int]:
    """Positions of the highest scores in order, equal ones by id, null ids last."""
    some = np.arange(len(score))
    if len(score) > top:
        some = np.flatnonzero(score >= np.partition(score, len(score) - top)[len(score) - top])
    return heapq.nsmallest(top, some.tolist(), key=lambda i: (-score[i], ids[i] is None, 0 if ids[i] is None else ids[i]))


class _Searcher:
    """Scores blocks of documents for some items and keeps the best of each item."""

    def __init__(self, items: list[tuple[np.ndarray, np.ndarray]], words: int, documents: int, length: int, top: int):
        self.items, self.words, self.top = items, words, top
        self.documents, self.length = documents, length
        self.scores = [np.empty(0, np.int64) for _ in items]
        self.ids: list[list] = [[] for _ in items]

    def gain(self, n: np.ndarray, row: np.ndarray, tf: np.ndarray) -> np.ndarray:
        """What a term of weight 1 adds to the score, for each hit."""
        if 75 * self.documents * int(n.max()) < 1 << 62:
            m = 25 + (75 * n * self.documents) // self.length
        else:
            m = np.array([25 + (75 * int(x) * self.documents) // self.length for x in n], np.int64)
        return (1_000_000_000 * tf) // (1000 * tf + 8 * m[row])

    def block(self, ids: list, n: np.ndarray, offsets: np.ndarray, term: np.ndarray, tf: np.ndarray) -> None:
        row = np.repeat(np.arange(len(n)), np.diff(offsets))
        held, gain = np.zeros((len(n), self.words), bool), np.zeros((len(n), self.words), np.int32)
        held[row, term] = True
        gain[row, term] = self.gain(n, row, tf)
        reach = gain.max(0).astype(np.int64)
        for k, (own, factor) in enumerate(self.items):
            bits = held[:, own]
            mask = np.packbits(bits, axis=1)
            if mask.shape[1] <= 8:
                wide = np.zeros((len(n), 8), np.uint8)
                wide[:, :mask.shape[1]] = mask
                _, first, group = np.unique(wide.view(np.uint64)[:, 0], return_index=True, return_inverse=True)
            else:
                _, first, group = np.unique(mask, axis=0, return_index=True, return_inverse=True)
            most = (bits[first] @ (factor * reach[own]))[group.ravel()]
            least = self.scores[k][-1] if len(self.scores[k]) == self.top else 1
            order = np.flatnonzero(most >= least)
            order = order[np.argsort(-most[order], kind="stable")]
            for lo in range(0, len(order), STEP):
                least = self.scores[k][-1] if len(self.scores[k]) == self.top else 1
                if most[order[lo]] < least:
                    break
                rows = order[lo:lo + STEP]
                score = gain[rows][:, own].astype(np.int64) @ factor
                good = score >= least
                if good.any():
                    score = np.concatenate([self.scores[k], score[good]])
                    names = self.ids[k] + [ids[i] for i in rows[good]]
                    best = _best(score, names, self.top)
                    self.scores[k], self.ids[k] = score[best], [names[i] for i in best]


def search_block(found: DataFrame, items: list[tuple[object, np.ndarray, np.ndarray]], words: int, documents: int,
                 length: int, item_kind: str, top: int) -> DataFrame:
    """at (number of the item), item, id, score: the best documents of each part of ``hits``."""
    kind = found.schema["id"].dataType.simpleString()
    rows_at_once = max(16, CELLS // max(words, 1))
    shared = found.sparkSession.sparkContext.broadcast(items)

    def run(batches):
        own = shared.value
        searcher = _Searcher([(t, f) for _, t, f in own], words, documents, length, top)
        id_type = None
        for batch in batches:
            id_type = batch.column("id").type
            for lo in range(0, batch.num_rows, rows_at_once):
                part = batch.slice(lo, rows_at_once)
                term, tf = part.column("term"), part.column("tf")
                offsets = np.concatenate([[0], np.cumsum(np.asarray(term.value_lengths()))])
                searcher.block(part.column("id").to_pylist(), np.asarray(part.column("n")), offsets,
                               np.asarray(term.flatten()), np.asarray(tf.flatten()))
        for k, (item, _, _) in enumerate(own):
            if len(searcher.scores[k]):
                size = len(searcher.scores[k])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k] * size, pa.int32()), pa.array([item] * size, _arrow(item_kind)),
                     pa.array(searcher.ids[k], id_type), pa.array(searcher.scores[k])], ["at", "item", "id", "score"])

    return found.mapInArrow(run, f"at int, item {item_kind}, id {kind}, score long")


def _arrow(kind: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "tinyint": pa.int8(), "string": pa.string()}[kind]


def _item_blocks(items: DataFrame, id_col: str, text_col: str):
    """Lists of (item, text) of about ``ITEM_BYTES`` each."""
    kind = dict(items.dtypes)[id_col]
    item = F.col(f"`{id_col}`")
    if kind not in ("bigint", "int", "smallint", "tinyint", "string"):
        item = item.cast("string")
    narrow = items.select(item.alias("item"), F.col(f"`{text_col}`").cast("string").alias("text")).filter(
        "text IS NOT NULL").distinct()
    narrow = stored(narrow, "items")
    size = narrow.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = math.ceil(size / ITEM_BYTES)
    dealt = narrow.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(max(blocks, 1))))
    for b in range(blocks):
        yield [(r["item"], r["text"]) for r in dealt.filter(F.col("block") == b).orderBy("item", "text").collect()]


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
           item_text_col: str = "text", top: int = TOP) -> DataFrame:
    """item, rank, id, score: the ``top`` best documents of each item."""
    spark = docs.sparkSession
    item_kind = dict(items.dtypes)[item_id_col]
    item_kind = item_kind if item_kind in ("bigint", "int", "smallint", "tinyint") else "string"
    kind = docs.select(f"`{id_col}`").schema[0].dataType.simpleString()
    best = None
    for b, block in enumerate(_item_blocks(items, item_id_col, item_text_col)):
        counts = [(item, Counter(t for some in terms(text.encode()) for t in some)) for item, text in block]
        vocabulary = {t: i for i, t in enumerate(dict.fromkeys(t for _, c in counts for t in c))}
        found = stored(hits(docs, vocabulary, id_col, text_col), "hits")
        documents, length = found.agg(F.count("*"), F.sum("n")).first()
        # one row for each term of the block
        holding = dict(map(tuple, found.select(F.explode("term").alias("term")).groupBy("term").count().collect()))
        weights = np.array([weight(documents, holding.get(i, 0)) for i in range(len(vocabulary))], np.int64)
        own = []
        for item, c in counts:
            places = np.array([vocabulary[t] for t in c], np.int64)
            factor = np.array(list(c.values()), np.int64) * weights[places]
            own.append((item, places[factor > 0], factor[factor > 0]))
        own = [x for x in own if len(x[1])]
        if not documents or not own:
            continue
        part = search_block(found, own, len(vocabulary), documents, length, item_kind, top).withColumn("block", F.lit(b))
        best = part if best is None else best.unionByName(part)
    if best is None:
        return spark.createDataFrame([], f"item {item_kind}, rank int, id {kind}, score long")
    order = Window.partitionBy("block", "at").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).select(
        "item", F.col("rank").cast("int").alias("rank"), "id", "score")


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPLIT = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
SQL = rf"""
WITH d AS (SELECT doc_id, {_SPLIT} AS terms FROM documents),
k AS (SELECT doc_id, len(terms) AS size FROM d WHERE len(terms) > 0),
c AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(size) AS BIGINT) AS total FROM k),
h AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(terms) AS term FROM d) x GROUP BY ALL),
q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_SPLIT}) AS term FROM benchmark) x GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight
      FROM h, c WHERE term IN (SELECT term FROM q) GROUP BY term, docs),
s AS (SELECT item_id, doc_id, CAST(sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * size * docs) // total)))) AS BIGINT)
        AS score FROM q JOIN h USING (term) JOIN w USING (term) JOIN k USING (doc_id), c GROUP BY ALL),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""


@query("op13_lexical_search", SQL)
def op13(spark, sf_dir):
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")
