"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built over a bounded sample of its
labelled text. A text is then parsed greedily: each phrase is the longest match
in the sample. A phrase is worth the logarithm of the sample's length in bits (its place in
the sample), so that a language with little labelled text is not at a disadvantage, and the language that
needs the fewest bits per character wins.

The sample is the documented bound of this classifier: ``SAMPLE_BLOCKS`` different blocks of
``BLOCK_CHARS`` characters per language, those with the smallest hash among the blocks with a letter of
all labelled texts, wherever in a text they stand. The model grows with the number of languages, not with the texts.
Every text that is classified is parsed whole, in stretches of ``BLOCK`` characters whose
phrases add up, so that thousands of stretches step through the automata at once. A phrase ends with its
stretch, for all languages alike: where the next stretch's first phrase would begin otherwise is only known once
the one before is parsed, and would cost the same steps one after the other.

``fit`` is one less the phrases per letter that the predicted language needs: near 0.8 for a text in a learned language,
0 where no phrase is longer than a letter, as in an unknown script. It depends on the size of the samples but little.

Edge cases: null text, or one without a letter, is ``und`` with score 0 and no fit. Ties go to the
language that sorts first. Without any labelled text every text is ``und``, and ``filter`` then keeps every text with a
letter, as nothing speaks against it. Empty tables give no rows. Repeated rows are
labelled alike. Other columns pass through ``identify`` and ``filter`` unchanged; columns that have the names of
new ones are replaced by ``identify``, whose caller names them.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import named, own_names, plain_names, query, row_slices, table

SAMPLE_BLOCKS = 96
BLOCK_CHARS = 300
BLOCK = 256
#: Bytes of text that a task parses at once.
SLICE = 1 << 19
UNKNOWN = "und"
#: Fit that a text must exceed to be kept: phrases of more than 4/3 letters. Texts of a learned language stay far above
#: even if half of them is codes or quotations.
LEAST_FIT = 0.25
UNNAMED = "_fit_not_asked_for"


def sample(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", blocks: int = SAMPLE_BLOCKS,
           chars: int = BLOCK_CHARS) -> dict[str, list[str]]:
    """Up to ``blocks`` different blocks of ``chars`` characters per language, chosen by hash out of the whole texts."""
    rows = labelled.select(named(lang_col).alias("lang"), named(text_col).cast("string").alias("text")).filter(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    cut = rows.select("lang", F.explode(F.expr(
        f"transform(sequence(1, length(text), {chars}), i -> substring(text, i, {chars}))")).alias("text")).filter(
        F.col("text").rlike(r"\p{L}")).withColumn("mark", F.xxhash64("text"))
    # equal blocks are one; the limit per language applies before the shuffle as well
    marks = cut.groupBy("lang", "mark").agg(F.lit(1).alias("one"))
    first = marks.withColumn("nth", F.row_number().over(Window.partitionBy("lang").orderBy("mark"))).filter(
        F.col("nth") <= blocks).select("lang", "mark")
    chosen = cut.join(F.broadcast(first), ["lang", "mark"]).groupBy("lang", "mark").agg(F.min("text").alias("text"))
    out: dict[str, list[str]] = {}
    for r in chosen.orderBy("lang", "mark").collect():
        out.setdefault(r.lang, []).append(r.text)
    return out


@functools.cache
def _lower() -> np.ndarray:
    """Of each code point: its lower-case letter, 0 where it is no letter."""
    out = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        if chr(c).isalpha():
            low = chr(c).lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _folded(text: str) -> str:
    """Lower case; anything but letters becomes one blank."""
    low = _lower()[_codes(text)]
    low[low == 0] = ord(" ")
    return " ".join(low.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").split())


class Automaton:
    """Suffix automaton: ``step[state, letter]`` is the next state, 0 if the match ends; state 1 is the start."""

    def __init__(self, texts: list[str], letters: dict[str, int]):
        width = len(letters) + 2
        link, size, step = [0, 0], [0, 0], [dict(), dict()]
        for text in texts:
            last = 1
            for c in text:
                k = letters[c]
                if k in step[last]:
                    to = step[last][k]
                    last = to if size[to] == size[last] + 1 else self._split(link, size, step, last, k)
                    continue
                new = len(size)
                link.append(1)
                size.append(size[last] + 1)
                step.append({})
                at, last = last, new
                while at and k not in step[at]:
                    step[at][k] = new
                    at = link[at]
                if at:
                    to = step[at][k]
                    link[new] = to if size[to] == size[at] + 1 else self._split(link, size, step, at, k)
        self.step = np.zeros((len(size), width), np.int32)
        for state, to in enumerate(step):
            for k, s in to.items():
                self.step[state, k] = s


    @staticmethod
    def _split(link: list, size: list, step: list, at: int, k: int) -> int:
        """A copy of the state reached from ``at`` by ``k`` for the shorter strings that end here."""
        to, copy = step[at][k], len(size)
        link.append(link[to])
        size.append(size[at] + 1)
        step.append(dict(step[to]))
        while at and step[at].get(k) == to:
            step[at][k] = copy
            at = link[at]
        link[to] = copy
        return copy


class Model:
    """Automata of all languages over one alphabet; letter 0 ends a block, letter 1 is one never seen."""

    def __init__(self, texts: dict[str, list[str]]):
        folded = {lang: [t for t in map(_folded, own) if t] for lang, own in sorted(texts.items())}
        seen = sorted({c for own in folded.values() for t in own for c in t} | {" "})
        self.letters = {c: i + 2 for i, c in enumerate(seen)}
        self.languages = list(folded)
        self.width = len(self.letters) + 2
        self.steps = [Automaton(own, self.letters).step.ravel() for own in folded.values()]
        #: Bits of a phrase per language.
        self.phrase_bits = np.log2([2 + sum(map(len, own)) for own in folded.values()])

    def letter_of(self) -> np.ndarray:
        """Letter of each code point: 1 for letters never seen, a blank for what is no letter."""
        own = np.ones(0x110000, np.uint16)
        for c, k in self.letters.items():
            own[ord(c)] = k
        own[0] = self.letters[" "]
        return own[_lower()]

    def phrases(self, blocks: np.ndarray) -> np.ndarray:
        """Phrases per block (row) and language of letters (one column per block, letters 0 at the end)."""
        out = np.zeros((blocks.shape[1], len(self.languages)), np.int32)
        for k, step in enumerate(self.steps):
            # states are rows of the flat table, times its width; row 0 matches nothing, so a new phrase starts
            state = np.zeros(blocks.shape[1], np.int64)
            start = step[self.width:2 * self.width].astype(np.int64) * self.width
            count = np.zeros(blocks.shape[1], np.int32)
            for letters in blocks:
                to = step[state + letters]
                starts = to == 0
                count += starts
                state = np.where(starts, start[letters], to.astype(np.int64) * self.width)
            out[:, k] = count
        return out


def identify(docs: DataFrame, texts: dict[str, list[str]], text_col: str = "text", lang_name: str = "lang_pred",
             score_name: str = "score", fit_name: str | None = None) -> DataFrame:
    """All columns of ``docs`` with the predicted language, a score from 0 to 1 and, if named, the fit after them.

    Columns that already have one of the names are replaced.
    """
    model = Model(texts)
    new = [n for n in (lang_name, score_name, fit_name) if n is not None]
    docs = docs.drop(*new)
    columns = docs.columns
    plain = plain_names(docs)
    plain_columns = plain.columns
    schema = ", ".join(f"{c} {t}" for c, t in plain.dtypes) + ", lang string, score double, fit double"
    names = np.array([*model.languages, UNKNOWN], object)
    at = columns.index(text_col)

    def label(batches):
        letter_of = model.letter_of()
        for batch in batches:
            whole = pc.fill_null(batch.column(at), "")
            size = np.concatenate([[0], np.cumsum(np.asarray(pc.binary_length(whole), np.int64))])
            for lo, hi in row_slices(len(whole), size, SLICE):
                lang, score, fit = _label(model, letter_of, whole.slice(lo, hi - lo).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(lo, hi - lo).columns, pa.array(names[lang], pa.string()), pa.array(score),
                     pa.array(fit, mask=np.isnan(fit))], [*plain_columns, "lang", "score", "fit"])

    found = own_names(plain.mapInArrow(label, schema), [*columns, lang_name, score_name, fit_name or UNNAMED])
    return found if fit_name else found.drop(UNNAMED)


def filter(docs: DataFrame, texts: dict[str, list[str]], text_col: str = "text", wanted: set[str] | None = None,
           least_fit: float = LEAST_FIT) -> DataFrame:
    """The rows of ``docs`` whose predicted language is wanted (by default any learned one) and fits, all columns as they are."""
    if not texts:
        return docs.filter(F.coalesce(named(text_col).rlike(r"\p{L}"), F.lit(False)))
    names = [f"_{n}" + "_" * max(map(len, docs.columns)) for n in ("lang", "score", "fit")]
    lang, _, fit = map(F.col, names)
    keep = (lang != UNKNOWN) & (fit > least_fit)
    if wanted is not None:
        keep &= lang.isin(*wanted)
    return identify(docs, texts, text_col, *names).filter(keep).drop(*names)


def _label(model: Model, letter_of: np.ndarray, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Language (index), score and fit (nan without a letter) of each text."""
    blank = model.letters[" "]
    letters = letter_of[_codes("".join(texts))]
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(size)
    doc = np.repeat(np.arange(len(texts)), size)
    # one blank between words, none at the ends of a text
    is_blank = letters == blank
    before = np.ones(len(letters), bool)
    before[1:] = is_blank[:-1] | (doc[1:] != doc[:-1])
    keep = ~(is_blank & before)
    letters, doc = letters[keep], doc[keep]
    keep = (letters != blank) | ~np.append(doc[1:] != doc[:-1], True)[:len(doc)]
    letters, doc = letters[keep], doc[keep]
    n = np.bincount(doc, minlength=len(texts))
    found = np.bincount(doc[letters != blank], minlength=len(texts)) > 0
    total = np.zeros((len(texts), len(model.languages)))
    if len(model.languages) and len(letters):
        first = np.cumsum(n) - n
        place = np.arange(len(letters)) - first[doc]
        per = -(-n // BLOCK)
        base = np.cumsum(per) - per
        block = base[doc] + place // BLOCK
        grid = np.zeros((BLOCK, int(per.sum())), np.int64)
        grid[place % BLOCK, block] = letters
        owner = np.repeat(np.arange(len(texts)), per)
        for k, counts in enumerate(model.phrases(grid).T):
            total[:, k] = np.bincount(owner, counts, minlength=len(texts))
        total -= (per * BLOCK - n)[:, None]  # each letter of the padding counted as a phrase
    lang = np.full(len(texts), len(model.languages))
    score, fit = np.zeros(len(texts)), np.full(len(texts), np.nan)
    if len(model.languages):
        bits = total * model.phrase_bits
        lang = np.where(found, bits.argmin(1), lang)
        best = np.sort(bits, 1)
        second = best[:, 1] if best.shape[1] > 1 else best[:, 0] * 2
        score = np.where(found, second / np.maximum(best[:, 0] + second, 1), 0.0)
        # phrases that ended before their stretch did: the last one of a stretch may have gone on
        ended = total - -(-n // BLOCK)[:, None]
        fit = np.where(found, 1 - ended[np.arange(len(texts)), bits.argmin(1)] / np.maximum(n, 1), np.nan)
    return lang, score, fit


def held_out(id_col: str = "doc_id", parts: int = 3, part: int = 1) -> Column:
    """Whether a row belongs to the part that is kept from learning: crc32 of the id as text."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % parts == part, F.lit(False))


@query("op6_language_id")
def op6(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    texts = sample(docs.filter(~held_out()))
    return identify(docs.select("doc_id", held_out().alias("held_out"), "text"), texts).drop("text")
