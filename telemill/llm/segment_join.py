"""Segments that several places of a corpus share, joined by their anchors.

A window is ``length`` consecutive tokens of one text; a segment is a run of
windows that select the same anchor (see ``anchors``). Equal segments form a
class: its first place decides for all others at once, so copies are counted
before they move and never paired. What remains are anchors with several
classes; a resolver (suffix sorting, or extension around the seed) says which
windows of a class begin elsewhere first.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from . import anchors
from .common import row_slices, stored

#: Bytes of text a task works on at once.
SLICE = 2 << 20
#: Windows of a segment are the bits of a long.
MOST_WINDOWS = 63


def tokens(unit: str, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token values of all texts and the offset of each text in them."""
    raw, offsets = anchors.text_buffers(texts)
    if unit == "bytes":
        return anchors.byte_values()[raw], offsets
    _, _, hashes, first = anchors.words(raw, offsets)
    return hashes, first


def slices(texts: pa.Array):
    """Slices of texts of bounded size, each with the number of its first row."""
    _, offsets = anchors.text_buffers(texts)
    for lo, hi in row_slices(len(texts), offsets, SLICE):
        yield lo, texts.slice(lo, hi - lo)


def occurrences(rows: DataFrame, unit: str, gram: int, length: int) -> DataFrame:
    """Segments of all texts: anchor, seg (content hash), key, place (first token and windows in one number)."""
    assert length - gram + 1 <= MOST_WINDOWS

    def find(batches):
        for batch in batches:
            keys = batch.column(0)
            for lo, texts in slices(batch.column(1)):
                values, offsets = tokens(unit, texts)
                for anchor, seg, text, pos, n in anchors.segments(values, offsets, gram, length):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(anchor), pa.array(seg), keys.take(pa.array(text + lo)), pa.array(pos << 6 | n)],
                        ["anchor", "seg", "key", "place"])

    return rows.select("key", "text").mapInArrow(find, "anchor long, seg long, key long, place long")


def _place() -> tuple[Column, Column]:
    """First token and number of windows of a place."""
    return F.shiftright("place", 6), F.col("place").bitwiseAND(63)


def shared(found: DataFrame, several: Column) -> DataFrame:
    """Occurrences of the anchors whose group fulfils ``several``; groups are combined before the shuffle."""
    common = found.groupBy("anchor").agg(several.alias("several")).filter("several").select("anchor")
    return stored(found.join(common, "anchor", "left_semi"), "segments", "zstd")


def classes(occurring: DataFrame) -> DataFrame:
    """One row per different segment: anchor, seg, its first place and windows, and the classes of its anchor."""
    pos, windows = _place()
    first = F.min(F.struct("key", "place")).alias("first")
    each = stored(occurring.groupBy("anchor", "seg").agg(first).select(
        "anchor", "seg", F.col("first.key").alias("key"), F.col("first.place").alias("place")).select(
        "anchor", "seg", "key", pos.alias("pos"), windows.alias("n")), "classes", "zstd")
    several = each.groupBy("anchor").agg(F.count("*").alias("kinds")).filter("kinds > 1")
    return each.join(several, "anchor", "left")


def contents(rows: DataFrame, found: DataFrame, cut: Callable, schema: str) -> DataFrame:
    """Run ``cut`` over the texts that hold given places.

    Places are gathered per text (a text's own places, so the text bounds them)
    and joined to it; ``cut(text, places)`` yields tuples for ``schema``.
    """
    places = found.groupBy("key").agg(F.collect_list(F.struct("anchor", "seg", "pos", "n")).alias("places"))
    both = rows.select("key", "text").join(places, "key")
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches):
        for batch in batches:
            for lo, texts in slices(batch.column("text")):
                keys = batch.column("key").slice(lo, len(texts)).to_pylist()
                lists = batch.column("places").slice(lo, len(texts)).to_pylist()
                yield pa.RecordBatch.from_arrays(cut(keys, texts, lists), names)

    return both.mapInArrow(run, schema)


def window_masks(rows: DataFrame, found: DataFrame, unit: str, length: int, place: list[str]) -> DataFrame:
    """Extension around the seed: (anchor, seg, mask) of classes with windows that begin elsewhere first.

    Each window of a class is one way to extend the anchor to both sides until ``length``. Windows
    are told apart by anchor and window hash; the least ``place`` of each is found with combining
    before the shuffle, and joined back to the windows.
    """
    def cut(keys, texts, lists):
        values, offsets = tokens(unit, texts)
        sums_of = [(i, p) for i, own in enumerate(lists) for p in own]
        if not sums_of:
            return [pa.array([], pa.int64())] * 6
        n = np.array([p["n"] for _, p in sums_of])
        pos = np.array([p["pos"] for _, p in sums_of])
        text = np.array([i for i, _ in sums_of])
        bit = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        start = np.repeat(offsets[text] + pos, n) + bit
        hashes = anchors.windows_at(values, start, length)
        def spread(x):
            return pa.array(np.repeat(np.asarray(x, np.int64), n))
        return [spread([p["anchor"] for _, p in sums_of]), spread([p["seg"] for _, p in sums_of]),
                spread(np.asarray(keys)[text]), pa.array(np.repeat(pos, n) + bit), pa.array(bit), pa.array(hashes)]

    windows = stored(contents(rows, found, cut, "anchor long, seg long, key long, pos long, bit long, hash long"), "windows", "zstd")
    where = F.struct(*place)
    least = windows.groupBy("anchor", "hash").agg(F.min(where).alias("least"), F.max(where).alias("most")).filter(
        "least < most").select("anchor", "hash", "least")
    later = windows.join(least, ["anchor", "hash"]).filter(where > F.col("least"))
    return later.groupBy("anchor", "seg").agg(F.bit_or(F.expr("shiftleft(1L, cast(bit as int))")).alias("mask"))


def marks(occurring: DataFrame, kinds: DataFrame, masks: DataFrame, copy: Column) -> DataFrame:
    """Per text, the windows to remove: key, and places (pos, mask) in the text.

    ``copy`` says whether an occurrence repeats its class's first place
    (columns key, pos against first_key, first_pos); then all its windows go.
    """
    each = kinds.select("anchor", "seg", F.col("key").alias("first_key"), F.col("pos").alias("first_pos")).join(
        masks, ["anchor", "seg"], "left")
    all_bits = F.expr("shiftrightunsigned(-1L, cast(64 - n as int))")
    mask = F.when(copy, all_bits).otherwise(F.coalesce("mask", F.lit(0)))
    pos, windows = _place()
    named = occurring.join(each, ["anchor", "seg"]).withColumns({"pos": pos, "n": windows})
    gone = named.select("key", "pos", mask.alias("gone")).filter("gone != 0").withColumnRenamed("gone", "mask")
    return gone.groupBy("key").agg(F.collect_list(F.struct("pos", "mask")).alias("gone"))


def covered(size: int, places: list[dict] | None, length: int) -> np.ndarray:
    """Which of ``size`` tokens lie in a window to remove."""
    step = np.zeros(size + 1, np.int32)
    for p in places or ():
        mask, at = p["mask"], p["pos"]
        while mask:
            low = (mask & -mask).bit_length() - 1
            run = (~(mask >> low) & ((mask >> low) + 1)).bit_length() - 1  # windows in a row
            step[at + low] += 1
            step[at + low + run - 1 + length] -= 1
            mask &= ~(((1 << run) - 1) << low)
    return np.cumsum(step[:-1]) > 0
