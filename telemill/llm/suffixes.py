"""Suffix arrays by two-stage sorting, in whole-array steps."""

from __future__ import annotations

import numpy as np


def _packed(text: np.ndarray) -> np.ndarray:
    """At each place the next eight symbols (bytes, 0 past the end) as one number that sorts like them."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    out = np.zeros(len(text) + 1, np.uint64)
    for k in range(8):
        out |= padded[k:k + len(text) + 1] << np.uint64(8 * (7 - k))
    return out


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """For each suffix whether it is smaller than the one that starts a place later.

    Symbols decide, and in a run of equal symbols the symbol after it. The last suffix is greater
    than the empty one.
    """
    n = len(text)
    change = np.flatnonzero(text[1:] != text[:-1])
    rises = np.append(text[change] < text[change + 1], False)
    ends = np.append(change, n - 1)
    return np.repeat(rises, np.diff(np.concatenate([[-1], ends])))


def _sorted_directly(places: np.ndarray, packed: np.ndarray, depth: int) -> np.ndarray:
    """``places`` in the order of their first ``depth`` symbols: eight at a time, and only ties go on."""
    last = len(packed) - 1
    order = places[np.argsort(packed[places], kind="stable")]
    first = packed[order]
    tied = np.zeros(len(order), bool)
    same = first[1:] == first[:-1]
    tied[1:] |= same
    tied[:-1] |= same
    group = np.concatenate([[0], np.cumsum(~same)])
    at = np.flatnonzero(tied)
    for done in range(8, depth, 8):
        if not len(at):
            break
        own, g = order[at], group[at]
        nxt = packed[np.minimum(own + done, last)]
        by = np.lexsort((nxt, g))
        order[at] = own[by]
        nxt, g = nxt[by], g[by]
        same = (nxt[1:] == nxt[:-1]) & (g[1:] == g[:-1])
        keep = np.zeros(len(at), bool)
        keep[1:] |= same
        keep[:-1] |= same
        group[at] = np.concatenate([[0], np.cumsum(~same)])
        at = at[keep]
    return order


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Places of ``text`` (bytes) in the order of their suffixes, exact for the first ``depth`` symbols.

    Only suffixes smaller than their successors are sorted directly. Then the
    buckets of first symbols are scanned upwards: each suffix that comes up
    puts the one before it at the next free place of that one's bucket, if that one is greater
    than its successor. Suffixes alike in ``depth`` symbols stand together, in any order;
    past its end the text counts as going on with zeros.
    """
    n = len(text)
    if not n:
        return np.empty(0, np.int64)
    small = smaller_than_next(text)
    packed = _packed(text)
    direct = _sorted_directly(np.flatnonzero(small), packed, depth)
    direct_at = np.searchsorted(text[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[text[n - 1]].append(np.array([n - 1]))  # its successor is the empty suffix, the least of all
    out = []
    for c in range(256):
        induced = []
        wave = np.concatenate(waiting[c]) if waiting[c] else np.empty(0, np.int64)
        while len(wave):  # the suffix before may be in this bucket too
            induced.append(wave)
            before = wave[wave > 0] - 1
            wave = before[(text[before] == c) & ~small[before]]
        bucket = np.concatenate([*induced, direct[direct_at[c]:direct_at[c + 1]]])
        if len(bucket):
            out.append(bucket)
            before = bucket[bucket > 0] - 1
            before = before[(text[before] > c) & ~small[before]]
            symbol = text[before]
            by = np.argsort(symbol, kind="stable")
            before, symbol = before[by], symbol[by]
            cuts = np.flatnonzero(np.diff(symbol)) + 1
            for part in np.split(before, cuts):
                if len(part):
                    waiting[text[part[0]]].append(part)
    return np.concatenate(out)


def common_prefix_reaches(text: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """For neighbours in ``order`` (places with ``length`` symbols left) whether they share that many."""
    packed = _packed(text)
    same = np.ones(max(len(order) - 1, 0), bool)
    at = np.arange(len(same))
    for k in [*range(0, length - 7, 8), *([length - 8] if length % 8 and length > 8 else [])]:
        a, b = order[at] + k, order[at + 1] + k
        alike = packed[a] == packed[b]
        same[at[~alike]] = False
        at = at[alike]
    if length < 8:
        for k in range(length):
            same &= text[order[:-1] + k] == text[order[1:] + k]
        return same
    return same
