"""Substring dedup over bytes with suffix arrays.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts earlier:
in a document with a smaller id, or further left in the same one. Matches never
cross documents; all is judged on the input.

Strings are dealt out by winnowed anchors, so that all equal ones meet in one
task. There the different segments of an anchor are set one after another and
their suffixes sorted in two stages (``suffixes``); neighbours with a common
prefix of ``LENGTH`` bytes are equal strings, of which the earliest stays.
Copies of a whole segment are counted into one before they move. An anchor with
more than ``MANY`` different segments (a short line in very many contexts) would
fill one task: its strings are compared by hash instead, dealt out one by one.

Edge cases: null text is empty: 0 bytes, the empty string's hash. Texts shorter
than ``LENGTH`` lose nothing. Ids that are null, repeated or not whole numbers are
ordered as ``common.keyed`` states; rows that repeat both id and text are one
document and get the same line. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import anchors, segment_join as S
from .common import keyed, query, stored, table
from .suffixes import common_prefix_reaches, suffix_array

LENGTH = 100
GRAM = 38
MANY = 1000
#: Bytes whose suffixes are sorted at once.
SORTED = 1 << 20


def _repeated(contents: list[bytes], windows: np.ndarray, keys: np.ndarray, pos: np.ndarray, length: int) -> np.ndarray:
    """Per content the windows (bits) that some other place has earlier."""
    text = np.frombuffer(b"\0".join(contents) + bytes(length + 8), np.uint8)
    size = np.array([len(c) + 1 for c in contents], np.int64)
    base = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(contents)), windows)
    bit = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    window_of = np.full(len(text), -1, np.int64)
    window_of[base[owner] + bit] = np.arange(len(owner))
    order = suffix_array(text, length)
    order = order[window_of[order] >= 0]
    same = common_prefix_reaches(text, order, length)
    group = np.concatenate([[0], np.cumsum(~same)]) if len(order) else np.empty(0, np.int64)
    which = window_of[order]
    by = np.lexsort((pos[owner[which]] + bit[which], keys[owner[which]], group))
    later = np.zeros(len(order), bool)
    later[1:] = group[by][1:] == group[by][:-1]
    gone = which[by][later]
    masks = np.zeros(len(contents), np.int64)
    np.bitwise_or.at(masks, owner[gone], np.left_shift(np.int64(1), bit[gone]))
    return masks


def _suffix_masks(rows: DataFrame, found: DataFrame, length: int) -> DataFrame:
    """(anchor, seg, mask) of segments with windows that another segment of their anchor has earlier."""
    def cut(keys, texts, lists):
        raw, offsets = anchors.text_buffers(texts)
        each = [(k, o, p) for k, o, own in zip(keys, offsets, lists) for p in own]
        return [pa.array([p["anchor"] for _, _, p in each], pa.int64()), pa.array([p["seg"] for _, _, p in each], pa.int64()),
                pa.array([k for k, _, _ in each], pa.int64()), pa.array([p["pos"] for _, _, p in each], pa.int64()),
                pa.array([p["n"] for _, _, p in each], pa.int64()),
                pa.array([raw[o + p["pos"]:o + p["pos"] + p["n"] + length - 1].tobytes() for _, o, p in each], pa.binary())]

    pieces = S.contents(rows, found, cut, "anchor long, seg long, key long, pos long, n long, content binary")

    def solve(own: pa.Table) -> pa.RecordBatch:
        own = own.combine_chunks()
        masks = _repeated(own["content"].to_pylist(), np.asarray(own["n"]), np.asarray(own["key"]),
                          np.asarray(own["pos"]), length)
        hit = masks != 0
        return pa.RecordBatch.from_arrays([pa.array(np.asarray(own["anchor"])[hit]), pa.array(np.asarray(own["seg"])[hit]),
                                           pa.array(masks[hit])], ["anchor", "seg", "mask"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            at = 0
            anchor = np.asarray(batch.column("anchor"))
            ends = np.append(np.flatnonzero(anchor[1:] != anchor[:-1]) + 1, len(anchor))
            if held and len(anchor) and size >= SORTED and held[-1].column("anchor")[-1].as_py() != anchor[0]:
                yield solve(pa.Table.from_batches(held))
                held, size = [], 0
            lengths = np.cumsum(np.asarray(batch.column("n")) + length)
            for end in ends[:-1]:  # whole anchors only; the last may go on in the next batch
                here = size + lengths[end - 1] - (lengths[at - 1] if at else 0)
                if here >= SORTED:
                    yield solve(pa.Table.from_batches([*held, batch.slice(at, end - at)]))
                    held, size, at = [], 0, end
            if at < len(anchor):
                held.append(batch.slice(at))
                size += lengths[-1] - (lengths[at - 1] if at else 0)
        if held:
            yield solve(pa.Table.from_batches(held))

    return pieces.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, "anchor long, seg long, mask long")


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM,
            many: int = MANY) -> tuple[DataFrame, DataFrame]:
    """Keyed documents, and per key the windows (bytes) that start earlier."""
    rows = keyed(docs, id_col, text_col)
    found = S.occurrences(rows, "bytes", gram, length)
    occurring = S.shared(found, F.count("*") > 1)
    kinds = S.classes(occurring)
    masks = _suffix_masks(rows, kinds.filter(F.col("kinds").between(2, many)), length).unionByName(
        S.window_masks(rows, kinds.filter(F.col("kinds") > many), "bytes", length, ["key", "pos"]))
    masks = stored(masks, "masks")  # ends the job that moved texts to the sorters: their shuffle files can go
    copy = F.struct("key", "pos") != F.struct(F.col("first_key").alias("key"), F.col("first_pos").alias("pos"))
    return rows, stored(S.marks(occurring, kinds, masks, copy), "gone", "zstd")


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM,
          many: int = MANY) -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept (the bytes that stay) per document."""
    rows, gone = repeats(docs, id_col, text_col, length, gram, many)
    both = rows.join(gone, "key", "left").select("id", "text", "gone")
    kind = both.schema["id"].dataType.simpleString()

    def cut(batches):
        for batch in batches:
            for lo, texts in S.slices(batch.column("text")):
                raw, offsets = anchors.text_buffers(texts)
                lists = batch.column("gone").slice(lo, len(texts)).to_pylist()
                size, removed, spans, kept = [], [], [], []
                for i, places in enumerate(lists):
                    own = raw[offsets[i]:offsets[i + 1]]
                    off = S.covered(len(own), places, length)
                    size.append(len(own))
                    removed.append(int(off.sum()))
                    spans.append(int((off & ~np.concatenate([[False], off[:-1]])).sum()))
                    kept.append(own[~off].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(lo, len(texts)), pa.array(size, pa.int64()), pa.array(removed, pa.int64()),
                     pa.array(spans, pa.int64()), pa.array(kept, pa.binary())], ["id", "n_bytes", "n_removed", "n_spans", "kept"])

    return both.mapInArrow(cut, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept binary").withColumnRenamed(
        "id", id_col)


SQL = r"""
WITH d AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS h FROM documents),
b AS (SELECT doc_id, unnest(x) AS x, unnest(range(0, len(x))) AS i
      FROM (SELECT doc_id, regexp_extract_all(h, '..') AS x FROM d)),
k2 AS (SELECT *, x || lead(x, 1) OVER w AS k2 FROM b WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
k4 AS (SELECT *, k2 || lead(k2, 2) OVER w AS k4 FROM k2 WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
k8 AS (SELECT *, k4 || lead(k4, 4) OVER w AS k8 FROM k4 WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
k16 AS (SELECT *, k8 || lead(k8, 8) OVER w AS k16 FROM k8 WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
k32 AS (SELECT doc_id, i, x, k4, md5(k16 || lead(k16, 16) OVER w) AS k32 FROM k16
        WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
k64 AS (SELECT *, md5(k32 || lead(k32, 32) OVER w) AS k64 FROM k32 WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
k AS (SELECT doc_id, i, x, md5(k64 || lead(k32, 64) OVER w || lead(k4, 96) OVER w) AS mark FROM k64
      WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
f AS (SELECT doc_id, i, x, mark IS NOT NULL AND row_number() OVER (PARTITION BY mark ORDER BY doc_id, i) > 1 AS later
      FROM k),
c AS (SELECT doc_id, i, x, coalesce(max(CASE WHEN later THEN i END) OVER (PARTITION BY doc_id ORDER BY i), -100) > i - 100
             AS gone FROM f),
e AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS opens FROM c),
s AS (SELECT doc_id, count(*) AS n_bytes, count(*) FILTER (WHERE gone) AS n_removed,
             count(*) FILTER (WHERE opens) AS n_spans,
             coalesce(string_agg(x, '' ORDER BY i) FILTER (WHERE NOT gone), '') AS kept FROM e GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_bytes, 0) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN s USING (doc_id)
"""


@query("op1_suffix_dedup", SQL)
def op1(spark, sf_dir):
    return clean(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
