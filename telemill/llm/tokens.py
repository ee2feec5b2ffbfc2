"""Token ids of whole texts with a public tokenizer, a word at a time."""

from __future__ import annotations

import functools
import string

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words whose ids a worker remembers; the memory is emptied when full, which changes no id.
REMEMBERED = 500_000
#: Words sent to the tokenizer in one call, and the token between them.
JOINED = 500
BETWEEN, BETWEEN_ID = "<|endoftext|>", 49407
#: A letter before one of these always ends a token; the apostrophe may go on in a contraction.
MARKS = string.punctuation.replace("'", "")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordTokenizer:
    """Ids of texts for a tokenizer that drops white space and never joins across it.

    Such a text's ids are those of its ASCII-blank separated words one after
    another, so equal words are encoded once and looked up a batch at a time.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._forget()

    def _forget(self) -> None:
        self.stems: dict[str, list[int]] = {"": []}
        self.words = pa.array([], pa.string())
        self.size = np.empty(0, np.int64)
        self.flat = np.empty(0, np.uint32)

    def _encode(self, words: list[str]) -> None:
        plain = [w for w in words if "<|" not in w]
        for lo in range(0, len(plain), JOINED):
            some = plain[lo:lo + JOINED]
            own: list[int] = []
            found = [own]
            for x in self.tokenizer.encode_batch_fast([BETWEEN.join(some)], add_special_tokens=False)[0].ids:
                if x == BETWEEN_ID:
                    own = []
                    found.append(own)
                else:
                    own.append(x)
            self.stems.update(zip(some, found))
        for w in words:
            if "<|" in w:
                self.stems[w] = self.tokenizer.encode(w, add_special_tokens=False).ids

    def _parts(self, word: str) -> tuple[str, str]:
        """A word as its letters in lower case and the marks after them, where that changes no id."""
        if "<|" in word:
            return word, ""
        stem = word.rstrip(MARKS)
        if stem and stem[-1].isalpha():
            return (stem.lower() if stem.isascii() else stem), word[len(stem):]
        return word, ""

    def _learn(self, words: pa.Array) -> None:
        parts = [self._parts(w) for w in words.to_numpy(zero_copy_only=False)]
        self._encode(sorted({p for pair in parts for p in pair if p not in self.stems}))
        each = [self.stems[stem] + self.stems[marks] for stem, marks in parts]
        self.words = pa.concat_arrays([self.words, words])
        self.size = np.concatenate([self.size, np.fromiter(map(len, each), np.int64, len(each))])
        self.flat = np.concatenate([self.flat, np.fromiter((x for e in each for x in e), np.uint32)])

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts, and the offsets of each text in them."""
        words = pc.ascii_split_whitespace(texts)
        bounds = np.asarray(words.offsets)
        bounds = bounds - bounds[0]
        distinct = words.flatten().dictionary_encode()
        if len(self.words) > REMEMBERED:
            self._forget()
        found = pc.index_in(distinct.dictionary, value_set=self.words)
        if found.null_count:
            had = len(self.words)
            self._learn(distinct.dictionary.filter(pc.is_null(found)))
            found = np.asarray(pc.fill_null(found, -1))
            found = np.where(found < 0, had + np.cumsum(found < 0) - 1, found)
        at = np.asarray(found)[np.asarray(distinct.indices)]
        n = self.size[at]
        end = np.cumsum(n)
        total = int(end[-1]) if len(end) else 0
        start = np.cumsum(self.size) - self.size
        out = self.flat[np.repeat(start[at] - (end - n), n) + np.arange(total)] if total else self.flat[:0]
        return out, np.concatenate([[0], end])[bounds]


@functools.cache
def word_tokenizer(path: str) -> WordTokenizer:
    """One per worker process, so that its memory of words serves all its tasks."""
    return WordTokenizer(path)
