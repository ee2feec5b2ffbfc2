"""Substring dedup over words by seed and extend.

Seeds are winnowed anchors of ``GRAM`` words: any repeat of ``LENGTH`` words holds
one at the same place in all its copies. Documents are joined on shared seeds; equal surroundings of a seed are one class.
A class takes as partners, one for each of its few windows, the first classes whose hashes promise a match, and from the seed the
words of both are compared to the left and to the right, one by one, until they differ. What is at
least ``LENGTH`` words long is kept; the kept matches of a document join to maximal repeats. A window counts if its words also
begin in a document with a smaller id; all is judged on the input.

Words are runs of anything but blank and tab to carriage return, compared unchanged. Hashes pick classes and
partners (copies of a class are told by 128 bits: seed and content); the words themselves decide what partners share.

Edge cases: null or wordless text has no words and keeps the empty string's
hash. Documents shorter than a window keep all. Ids that are null, repeated or
not whole numbers are ordered as ``common.keyed`` states; rows that repeat both id and
text are one document and get the same line. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import anchors, segment_join as S
from .common import keyed, query, stored, table

LENGTH = 13
GRAM = 4


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
            gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """Keyed documents, and per key the windows that begin in an earlier document."""
    rows = keyed(docs, id_col, text_col)
    found = S.occurrences(rows, "words", gram, length)
    occurring = S.shared(found, F.min("key") < F.max("key"))
    kinds = S.classes(occurring)
    seeds = kinds.filter("kinds > 1")
    masks = stored(extended(surroundings(rows, seeds, length), length), "masks", "zstd")
    return rows, stored(S.marks(occurring, kinds, masks, F.col("key") > F.col("first_key")), "marks", "zstd")


def surroundings(rows: DataFrame, seeds: DataFrame, length: int) -> DataFrame:
    """Per class: anchor, seg, key, n windows, and its first place's text from the first word to the last."""
    def cut(keys, texts, lists):
        raw, offsets = anchors.text_buffers(texts)
        start, end, _, first = anchors.words(raw, offsets)
        out = [(p["anchor"], p["seg"], key, p["n"], raw[start[at]:end[at + p["n"] + length - 2]].tobytes())
               for key, f, own in zip(keys, first, lists) for p in own for at in [f + p["pos"]]]
        columns = list(zip(*out)) or [[]] * 5
        return [*[pa.array(c, pa.int64()) for c in columns[:4]], pa.array(columns[4], pa.binary())]

    return stored(S.contents(rows, seeds, cut, "anchor long, seg long, key long, n long, words binary"), "surroundings", "zstd")


def extended(around: DataFrame, length: int) -> DataFrame:
    """(anchor, seg, mask): the windows of each class that lie in a match with a class of an earlier document."""
    def hashed(batches):
        for batch in batches:
            texts = batch.column("words").cast(pa.string())
            for lo, some in S.slices(texts):
                values, first = S.tokens("words", some)
                own = batch.slice(lo, len(some))
                n = np.asarray(own.column("n"))
                bit = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                hashes = anchors.windows_at(values, np.repeat(first[:-1], n) + bit, length)
                spread = [pa.array(np.repeat(np.asarray(own.column(c)), n)) for c in ("anchor", "seg", "key")]
                yield pa.RecordBatch.from_arrays([*spread, pa.array(bit), pa.array(hashes)],
                                                 ["anchor", "seg", "key", "bit", "hash"])

    windows = around.mapInArrow(hashed, "anchor long, seg long, key long, bit long, hash long")
    first = windows.groupBy("anchor", "hash").agg(
        F.min(F.struct("key", "seg", "bit")).alias("least"), F.max("key").alias("most")).filter("least.key < most")
    # the seed stands at one place of both classes, so all their common windows have one shift
    # written, as the masks and marks are: shuffle files of one step go before those of the next come
    pairs = stored(windows.join(first, ["anchor", "hash"]).filter("key > least.key").groupBy(
        "anchor", "seg", F.col("least.seg").alias("other")).agg(F.min(F.expr("least.bit - bit")).alias("shift")), "pairs", "zstd")
    mine = around.select("anchor", "seg", "n", "words")
    theirs = around.select("anchor", F.col("seg").alias("other"), F.col("words").alias("their_words"))
    both = pairs.join(theirs, ["anchor", "other"]).join(mine, ["anchor", "seg"]).select(
        "anchor", "seg", "shift", "n", "words", "their_words")

    def extend(batches):
        for batch in batches:
            masks = [_extension(a.split(), b.split(), shift, n, length) for a, b, shift, n in zip(
                *(batch.column(c).to_pylist() for c in ("words", "their_words", "shift", "n")))]
            yield pa.RecordBatch.from_arrays([batch.column("anchor"), batch.column("seg"), pa.array(masks, pa.int64())],
                                             ["anchor", "seg", "mask"])

    return both.mapInArrow(extend, "anchor long, seg long, mask long").groupBy("anchor", "seg").agg(
        F.bit_or("mask").alias("mask")).filter("mask != 0")


def _extension(words: list[bytes], theirs: list[bytes], shift: int, n: int, length: int) -> int:
    """Windows (bits) inside the match that grows from the seed; word i of the one stands against i + shift of the other.

    All ``n`` windows hold the words from n - 1 to length, the seed among them: these must agree.
    """
    lo, hi = n - 1, length
    if lo + shift < 0 or words[lo:hi] != theirs[lo + shift:hi + shift]:
        return 0
    while lo > 0 and lo + shift > 0 and words[lo - 1] == theirs[lo - 1 + shift]:
        lo -= 1
    while hi < len(words) and hi + shift < len(theirs) and words[hi] == theirs[hi + shift]:
        hi += 1
    return ((1 << max(hi - lo - length + 1, 0)) - 1) << lo


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
          gram: int = GRAM) -> DataFrame:
    """id, n_words, n_removed, n_repeats (maximal), kept (words that stay, joined by blanks) per document."""
    rows, gone = repeats(docs, id_col, text_col, length, gram)
    both = rows.join(gone, "key", "left").select("id", "text", "gone")
    kind = both.schema["id"].dataType.simpleString()

    def cut(batches):
        for batch in batches:
            for lo, texts in S.slices(batch.column("text")):
                raw, offsets = anchors.text_buffers(texts)
                start, end, _, first = anchors.words(raw, offsets)
                lists = batch.column("gone").slice(lo, len(texts)).to_pylist()
                size, removed, runs, kept = [], [], [], []
                for i, places in enumerate(lists):
                    a, b = first[i], first[i + 1]
                    off = S.covered(b - a, places, length)
                    size.append(b - a)
                    removed.append(int(off.sum()))
                    runs.append(int((off & ~np.concatenate([[False], off[:-1]])).sum()))
                    kept.append(b" ".join(raw[s:e].tobytes() for s, e in zip(start[a:b][~off], end[a:b][~off])))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(lo, len(texts)), pa.array(size, pa.int64()), pa.array(removed, pa.int64()),
                     pa.array(runs, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                    ["id", "n_words", "n_removed", "n_repeats", "kept"])

    return both.mapInArrow(cut, f"id {kind}, n_words long, n_removed long, n_repeats long, kept string").withColumnRenamed(
        "id", id_col)


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(w) - 11)) AS i, w FROM d WHERE len(w) >= 13),
k AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 12], ' ')) AS mark FROM p),
f AS (SELECT mark, min(doc_id) AS first FROM k GROUP BY mark),
g AS (SELECT DISTINCT doc_id, i + s AS i FROM (SELECT doc_id, i FROM k JOIN f USING (mark) WHERE first < doc_id),
      (SELECT unnest(range(0, 13)) AS s)),
e AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
j AS (SELECT e.doc_id, e.i, e.word, g.i IS NOT NULL AS gone FROM e LEFT JOIN g ON e.doc_id = g.doc_id AND e.i = g.i),
s AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed,
             coalesce(string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone), '') AS kept FROM j GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN s USING (doc_id)
"""


@query("op3_substring_dedup", SQL)
def op3(spark, sf_dir):
    return clean(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
