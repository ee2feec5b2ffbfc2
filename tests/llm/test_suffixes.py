import numpy as np
from hypothesis import given, settings, strategies as st

from telemill.llm import anchors, suffixes
import pyarrow as pa
import re


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([0, 1, 97, 98, 255]), min_size=1, max_size=120), st.booleans(), st.sampled_from([8, 10, 30]))
def test_order_and_common_prefixes(symbols, doubled, depth):
    text = np.array(symbols * (1 + doubled), np.uint8)
    data = text.tobytes()
    assert suffixes.smaller_than_next(text).tolist() == [data[i:] < data[i + 1:] for i in range(len(data))]
    order = suffixes.suffix_array(text, depth)
    assert sorted(order.tolist()) == list(range(len(data)))
    heads = [data[i:i + depth].ljust(depth, b"\0") for i in order]
    assert heads == sorted(heads)
    whole = order[order + depth <= len(data)]
    same = suffixes.common_prefix_reaches(text, whole, depth)
    assert same.tolist() == [data[a:a + depth] == data[b:b + depth] for a, b in zip(whole, whole[1:])]


def test_words_and_segments(monkeypatch):
    monkeypatch.setattr(anchors, "CHUNK", 64)
    rng = np.random.default_rng(3)
    texts = ["".join(rng.choice(list("ab \t\ncdé"), n)) for n in (0, 1, 5, 40, 300, 300)] + ["x" * 500, None, "  "]
    raw, offsets = anchors.text_buffers(pa.array(texts))
    start, end, hashes, first = anchors.words(raw, offsets)
    want = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for t in texts]
    assert [raw[a:b].tobytes() for a, b in zip(start, end)] == sum(want, [])
    assert first.tolist() == np.cumsum([0] + [len(w) for w in want]).tolist()
    by_word = dict(zip(sum(want, []), hashes.tolist()))
    assert [by_word[w] for w in sum(want, [])] == hashes.tolist() and len(set(by_word.values())) == len(by_word)
    seen, anchor_of = set(), {}
    for anchor, _, text, pos, n in anchors.segments(anchors.byte_values()[raw], offsets, 3, 8):
        for a, t, p, k in zip(anchor, text, pos, n):
            for w in range(p, p + k):
                assert (t, w) not in seen
                seen.add((t, w))
                window = raw[offsets[t] + w:offsets[t] + w + 8].tobytes()
                assert anchor_of.setdefault(window, a) == a
    assert len(seen) == sum(max(0, offsets[i + 1] - offsets[i] - 7) for i in range(len(texts)))
