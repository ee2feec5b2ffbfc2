"""Winnowed anchors over arrays of tokens (bytes or word hashes), whole batches at a time.

Every window of ``length`` tokens selects the ``gram`` tokens in it whose hash is
smallest. Equal windows select the same anchor at the same place, so whoever groups by
anchors sees all of their equal windows together. A run of windows that share one anchor is a segment.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Tokens worked on at once; arrays of this size stay in the caches.
CHUNK = 1 << 16
#: Fixed odd multiplier of the polynomial hashes, and its inverse modulo 2^64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


@functools.cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def of(x: int) -> np.ndarray:
        out = np.full(n, x, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)
    with np.errstate(over="ignore"):
        return of(BASE), of(INVERSE)


@functools.cache
def byte_values() -> np.ndarray:
    """A random value for each byte."""
    return np.random.default_rng(20200101).integers(1, 1 << 63, 256).astype(np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread all bits (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Sums from which ``span_hash`` takes the hash of any span; one longer than ``values``."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers(_room(len(values)))[0][:len(values)], out=out[1:])
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hash of tokens start to end, the same wherever they stand."""
    return (sums[end] - sums[start]) * _powers(_room(len(sums)))[1][start]


def _room(n: int) -> int:
    return max(1 << 18, 1 << int(n).bit_length())


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, nulls empty, and the offset of each in them."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, at, data = texts.buffers()
    offsets = np.frombuffer(at, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def words(raw: np.ndarray, offsets: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words between white space (tab to carriage return, blank): starts, ends, hashes, first word of each text.

    ``lower`` folds A to Z. Chunks are cut at word ends, so a word is never split.
    """
    values = byte_values()
    if lower:
        values = values.copy()
        values[65:91] = values[97:123]
    starts, ends, hashes = [], [], []
    at = 0
    while at < len(raw):
        to = min(len(raw), at + CHUNK)
        blank = (raw[at:to] == 32) | ((raw[at:to] >= 9) & (raw[at:to] <= 13))
        if to < len(raw):
            gaps = np.flatnonzero(blank)
            while not len(gaps):  # a word longer than a chunk
                if to == len(raw):
                    break
                to = min(len(raw), to + CHUNK)
                blank = (raw[at:to] == 32) | ((raw[at:to] >= 9) & (raw[at:to] <= 13))
                gaps = np.flatnonzero(blank)
            if len(gaps) and to < len(raw):
                to = at + int(gaps[-1]) + 1
                blank = blank[:to - at]
        n = to - at
        edge = np.zeros(n + 1, bool)
        inside = offsets[np.searchsorted(offsets, at):np.searchsorted(offsets, to, "right")] - at
        edge[inside] = True
        edge[0] = edge[n] = True
        word = ~blank
        first = np.flatnonzero(word & (edge[:-1] | np.concatenate([[True], blank[:-1]])))
        last = np.flatnonzero(word & (edge[1:] | np.concatenate([blank[1:], [True]]))) + 1
        sums = prefix_sums(values[raw[at:to]])
        hashes.append(mixed(span_hash(sums, first, last) + (last - first).astype(np.uint64)))
        starts.append(first + at)
        ends.append(last + at)
        at = to
    if not starts:
        none = np.empty(0, np.int64)
        return none, none, np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    s = np.concatenate(starts)
    return s, np.concatenate(ends), np.concatenate(hashes), np.searchsorted(s, offsets)


def segments(values: np.ndarray, offsets: np.ndarray, gram: int, length: int):
    """Segments of all texts, a chunk at a time.

    ``values`` are token hashes of all texts one after another, ``offsets`` where
    each begins. Yields arrays: anchor hash, content hash, text, first token in the text, windows.
    """
    width = length - gram + 1
    low = np.uint64(2 * CHUNK - 1)
    for at in range(0, max(len(values) - length + 1, 0), CHUNK):
        to = min(len(values), at + CHUNK + length - 1)
        n = to - at
        sums = prefix_sums(values[at:to])
        place = np.arange(n - gram + 1)
        grams = mixed((sums[gram:] - sums[:-gram]) * _powers(_room(n))[1][:n - gram + 1])
        key = (grams & ~low) | (low - place.astype(np.uint64))  # of equal hashes the last counts
        size = 1
        least = key
        while 2 * size <= width:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        windows = n - length + 1
        least = np.minimum(least[:windows], least[width - size:width - size + windows])
        anchor = (low - (least & low)).astype(np.int64)
        valid = np.ones(windows, bool)
        lo, hi = np.searchsorted(offsets, at, "right"), np.searchsorted(offsets, to, "left")
        for end in offsets[lo:hi + 1] - at:  # windows that would cross the end of a text
            valid[max(0, end - length + 1):max(0, end)] = False
        new = valid.copy()
        new[1:] &= ~valid[:-1] | (anchor[1:] != anchor[:-1])
        first = np.flatnonzero(new)
        if not len(first):
            continue
        stop = np.flatnonzero(np.concatenate([(new | ~valid)[1:], [True]]) & valid) + 1
        content = mixed(span_hash(sums, first, stop + length - 1) ^ np.uint64(BASE))
        text = np.searchsorted(offsets, first + at, "right") - 1
        yield grams[anchor[first]].view(np.int64), content.view(np.int64), text, first + at - offsets[text], stop - first


def windows_at(values: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Hashes of the windows of ``length`` tokens that begin at ``starts``, the same in whatever array they stand."""
    sums = prefix_sums(values)
    return mixed(span_hash(sums, starts, starts + length)).view(np.int64)
