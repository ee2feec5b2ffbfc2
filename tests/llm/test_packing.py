import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from telemill.llm import packing, tokens

ODD = ["it's dog's.'s x", "a<|endoftext|>b <|ENDOFTEXT|>", "J̌. É, é.́", "", "  ", "10,000 3.5%!! ---",
       "ΣΑΣ. ΣΑΣ", "don't!can't 't.", "x≠ a b\x1cc", "İI. ǅ!", "WORD!! word!! Word,###"]


def test_word_ids_are_the_tokenizers():
    import pyarrow as pa
    whole = Tokenizer.from_file(tokens.default_path())
    ids, at = tokens.WordTokenizer(tokens.default_path()).ids(pa.array(ODD))
    for k, text in enumerate(ODD):
        assert ids[at[k]:at[k + 1]].tolist() == whole.encode(text, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.sampled_from([12, 30, 100, 4096]), st.dictionaries(st.integers(1, 4096), st.integers(1, 40), max_size=50))
def test_plan_fills_without_gaps(capacity, counts):
    counts = {n % capacity + 1: c for n, c in counts.items()}
    places = packing.plan(counts, capacity)
    used: dict = {}
    for n, c in counts.items():
        own = places[places[:, 0] == n]
        for rank in range(c):
            _, first, seq, times, offset = own[np.searchsorted(own[:, 1], rank, "right") - 1]
            nth = rank - first
            used.setdefault(seq + nth // times, []).append((offset + nth % times * n, n))
    for items in used.values():
        at = 0
        for offset, n in sorted(items):
            assert offset == at
            at += n
        assert at <= capacity
        assert sum(3 * n > capacity for _, n in items) <= 2
    bins: list = []
    for n in sorted((n for n, c in counts.items() for _ in range(c)), reverse=True):
        fit = [i for i, gap in enumerate(bins) if gap >= n]
        if fit:
            bins[min(fit, key=lambda i: bins[i])] -= n
        else:
            bins.append(capacity - n)
    assert len(used) <= len(bins) + 1


def test_pieces_and_places(spark, monkeypatch):
    rows = [(1, "one two three " * 20), (2, None), (3, ""), (4, "a b"), (4, "a b"), (None, "x"), (5, "w " * 33)]
    df = spark.createDataFrame([(i, t, 7) for i, t in rows], "doc_id long, text string, rank int")
    got = packing.pack_documents(df, capacity=16, with_ids=True).collect()
    whole = Tokenizer.from_file(tokens.default_path())
    want = []
    for i, t in rows:
        ids = [*whole.encode(t or "", add_special_tokens=False).ids, 1]
        for k, at in enumerate(range(0, len(ids), 16)):
            data = np.array(ids[at:at + 16], "<u4").tobytes()
            want.append((i, k, at, len(ids[at:at + 16]), zlib.crc32(data), data))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)) for r in got), key=repr) == sorted(want, key=repr)
    places = sorted((r.sequence_id, r.offset, r.length) for r in got)
    for (s, o, n), (s2, o2, _) in zip(places, places[1:]):
        assert (s2 == s and o2 == o + n) or (s2 > s and o2 == 0)


@pytest.mark.parametrize("block", [1, 2, 1000])
def test_hot_length_is_ranked_in_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(packing, "BLOCK", block)
    df = spark.createDataFrame([(i, "same text") for i in range(50)] + [(99, "a longer one here")], "doc_id long, text string")
    got = packing.pack_documents(df, capacity=12).collect()
    assert len({(r.sequence_id, r.offset) for r in got}) == 51
    assert packing.pack_documents(df.limit(0)).collect() == []
