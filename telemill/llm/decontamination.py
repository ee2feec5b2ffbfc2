"""Benchmark decontamination by template canonicalisation.

Words lose case and punctuation. In templates, numbers, names and units after numbers
become typed placeholders. The item alone decides which words are names: those it shows
capitalised inside a sentence. Its other capitalised words may be names too: both readings are
tried. In documents any word but numbers and small common words fits a name, whatever its case and
place. Windows of ``WINDOW`` words of every document are looked up among the windows of the
benchmark, both as plain words and as templates. A template match must keep its slots consistent, so
that re-parameterised questions are found and mere lookalikes are not: within a window each number
and unit of the question stands for one of the document (several may come to the same), and each
name for one name and the other way round. Every window is judged by itself, so a longer copy is never
let through for what stands elsewhere in it.

An item with fewer words than a window is one window; items with fewer than
``LEAST`` words are no evidence and are not searched.

This is no join: documents outnumber benchmark windows by far and are not moved. The benchmark is
collected in blocks of ``BLOCK`` items, and all blocks go to every Python worker, where a text is
split into words once and looked up in one block after the other. So the whole benchmark must fit
the driver and each worker; README gives the memory an item takes.

Edge cases: null or wordless texts match nothing, nor do null benchmark texts. Every row is
judged by itself, so repeated rows and ids get the same answer. Empty tables give no rows, an
empty benchmark leaves all documents clean. ``filter`` keeps all columns, whatever their names.
"""

from __future__ import annotations

import functools
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from . import anchors
from .common import named, numbered, own_names, plain_names, query, row_slices, table

WINDOW = 13
LEAST = 5
#: Words of a template window that must not be placeholders, and of an item shorter than a window.
LITERAL, SHORT_LITERAL = 6, 5
BLOCK = 2000
SLICE = 1 << 20

# Spelled numbers and units.
NUMBERS = frozenset("zero one two three four five six seven eight nine ten eleven twelve twenty thirty forty fifty hundred "
                    "thousand million half double twice dozen".split())
UNITS = frozenset("mm cm m km in ft yd mi mg g kg lb lbs oz ml l s sec secs second seconds min mins minute minutes h hr hrs hour "
                  "hours day days week weeks month months year years percent pct usd eur gbp dollar dollars cent cents euro euros "
                  "pound pounds mph kmh kph hz khz mhz ghz w kw v kb mb gb tb c f k meters metres meter metre miles mile inches "
                  "feet grams gram liters litres liter".split())
NUMBER = re.compile(r"[\d.,:/%$€£+-]*\d[\d.,:/%$€£+-]*")
# Words that are no names, however written.
COMMON = frozenset("a about add after all also an and any are as at be because been before both but by calculate can choose compute "
                   "consider could describe determine did do does during each either evaluate every explain express few find first "
                   "for from give given had has have he her here his how however i if in into is it its last let list many more most "
                   "must my name next no not now of on one only or other our out over please select she should show simplify since so "
                   "solve some state suppose that the their them then there these they this those through to under until up was we "
                   "were what when where whether which while who whom whose why with would write yes you your "
                   "aber als am an auf aus bei berechne bis das dem den der des die doch ein eine einem einen einer es finde für gib "
                   "hat im ist jede jeder jedes man mit nach nur oder sie sind über um und von vor wann war warum was welche welcher "
                   "welches wenn wer wie wieviel wo zu zum zur al calcula como cómo con cual cuál cuando cuándo cuántas cuántos de "
                   "del donde dónde el en entre es la las lo los no para pero por qué que quién se si sin su un una y au aux avec "
                   "calculez ce ces cette combien comment dans des du elle est et il ils le les mais on où par pas pour pourquoi "
                   "quand quel quelle quels qui quoi sont sur trouvez une".split())
#: A MAYBE opens a sentence in capitals, or is a name elsewhere in its item: a name, or just the word it is.
PLAIN, NUM, NAME, UNIT, MAYBE = range(5)
#: Names of the document, looked at from their side.
BACK = 5
#: Seeds of template windows: words at these places, from a run of up to eight, or any three of seven.
RUNS = [tuple(range(n)) for n in (8, 6, 4, 3)]
TRIPLES = [(0, a, b) for b in range(2, 7) for a in range(1, b)]
#: Candidates compared at once.
CHUNK = 1 << 18
BITS = 20


@functools.lru_cache(maxsize=200_000)
def _word(raw: str) -> tuple[str, int]:
    """The bare word, and bits: 1 number, 2 unit, 4 capitalised, 8 ends a sentence, 16 fits a name."""
    if raw.isalpha() and raw.islower():
        return raw, 1 if raw in NUMBERS else (2 if raw in UNITS else 0) | (0 if raw in COMMON else 16)
    bare = re.sub(r"[\W_]+", "", raw.lower())
    bits = 0
    if bare and (NUMBER.fullmatch(raw) or bare in NUMBERS or bare.isdigit()):
        bits |= 1
    elif bare in UNITS:
        bits |= 2
    elif bare and bare[0].isdigit() and re.sub(r"^\d+", "", bare) in UNITS:
        bits |= 1
    letters = [c for c in raw if c.isalpha()]
    if len(letters) > 1 and letters[0].isupper() and not all(c.isupper() for c in letters):
        bits |= 4
    if re.search(r"[.!?:]\W*$", raw):
        bits |= 8
    if not bits & 1 and (bits & 4 or bare not in COMMON):
        bits |= 16
    return bare, bits


def _typed(text: str) -> list[tuple[str, int]]:
    """The words of an item and their kinds. A line break ends a sentence."""
    out = []
    after_number = False
    for line in re.split(r"[\n\v\f\r]+", text):
        opens = True
        for raw in re.findall(r"[^ \t]+", line):
            bare, bits = _word(raw)
            if bare:
                kind = PLAIN
                if bits & 1:
                    kind = NUM
                elif bits & 2 and after_number:
                    kind = UNIT
                elif bits & 4 and opens != (bare in COMMON):
                    kind = MAYBE
                elif bits & 4 and not opens:
                    kind = NAME
                out.append((bare, kind))
            opens = bool(bits & 8) or opens and not bare
            after_number = bool(bits & 1)
    names = {w for w, kind in out if kind == NAME}
    return [(w, MAYBE if kind == PLAIN and w in names else kind) for w, kind in out]


def _words(raw: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Bare words of an array, and which are numbers, units and fit a name, as ``_word`` has it.

    Lower-case words, and ASCII ones with a mark behind, are told by whole columns; only the rest one by one.
    """
    cut = pc.ascii_rtrim(raw, characters=".,;:!?")
    low = pc.and_(pc.utf8_is_alpha(raw), pc.utf8_is_lower(raw))
    plain = pc.ascii_is_alpha(cut)
    bare = pc.if_else(low, raw, pc.if_else(plain, pc.ascii_lower(cut), pa.scalar(None, raw.type)))
    odd = pc.is_null(bare)
    known = [_word(w) for w in raw.filter(odd).to_pylist()]
    bare = pc.replace_with_mask(bare, odd, pa.array([w for w, _ in known], raw.type))

    def among(words: frozenset) -> np.ndarray:
        return np.asarray(pc.is_in(bare, value_set=pa.array(sorted(words), raw.type)))

    capital = np.asarray(pc.and_(pc.ascii_is_upper(pc.utf8_slice_codeunits(cut, 0, 1)), pc.and_(
        pc.invert(pc.ascii_is_upper(cut)), pc.greater(pc.binary_length(cut), 1))))
    number = among(NUMBERS)
    unit = among(UNITS) & ~number
    fits = ~number & (capital & np.asarray(plain) & ~np.asarray(low) | ~among(COMMON))
    one_by_one, bits = np.asarray(odd), np.array([b for _, b in known], np.uint8)
    for of, bit in ((number, 1), (unit, 2), (fits, 16)):
        of[one_by_one] = bits & bit > 0
    return bare, number, unit, fits


class Words:
    """Words of some texts: spelled (different bare words), at (index into them), text of each, and what they may stand for."""

    def __init__(self, texts: pa.Array):
        self.texts = len(texts)
        split = pc.ascii_split_whitespace(texts)
        bounds = np.asarray(split.offsets)
        coded = split.flatten().dictionary_encode()
        self.spelled, number, unit, fits = _words(coded.dictionary)
        filled = np.asarray(pc.greater(pc.binary_length(self.spelled), 0))
        at = np.asarray(coded.indices)
        keep = filled[at]
        self.at = at[keep]
        self.text = np.repeat(np.arange(len(bounds) - 1, dtype=np.int32), np.diff(bounds))[keep]
        self.number, self.unit, self.fits = number[self.at], unit[self.at], fits[self.at]


def _shape_hash(values: np.ndarray, sums: np.ndarray, shape: tuple[int, ...]) -> np.ndarray:
    """Hash of the words at ``shape`` from each place on."""
    n = max(len(values) - shape[-1], 0)
    if len(shape) > 3:
        start = np.arange(n)
        return anchors.span_hash(sums, start, start + len(shape))
    out = np.zeros(n, np.uint64)
    for k, o in enumerate(shape):
        out += values[o:o + n] * np.uint64(pow(anchors.BASE, k + 1, 1 << 64))
    return out


class Seeds:
    """Places of the items that share a shape, sorted by hash: where the window begins and how long it is."""

    def __init__(self, hashes: np.ndarray, begin: np.ndarray, offset: np.ndarray, length: np.ndarray):
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.begin, self.offset, self.length = hashes[order], begin[order], offset[order], length[order]
        self.some = np.zeros(1 << BITS, bool)
        self.some[hashes >> np.uint64(64 - BITS)] = True

    def candidates(self, own: np.ndarray):
        """Pairs of a place with hash ``own`` and a seed, a bounded number at a time."""
        at = np.flatnonzero(self.some[own >> np.uint64(64 - BITS)])
        lo = np.searchsorted(self.hashes, own[at])
        count = np.searchsorted(self.hashes, own[at], "right") - lo
        at, lo, count = at[count > 0], lo[count > 0], count[count > 0]
        total = np.concatenate([[0], np.cumsum(count)])
        for a in range(0, total[-1], CHUNK):
            pair = np.arange(a, min(a + CHUNK, total[-1]))
            which = np.searchsorted(total, pair, "right") - 1
            yield at[which], lo[which] + pair - total[which]


class Items:
    """A block of benchmark items: their words, and seeds by which their windows are found.

    Seeds hold only words that a match must repeat, with marks for numbers and units. A window with enough of them beside
    its names is found by its best seed, one that needs some of its MAYBEs to be repeated by each triple of seven places:
    of five words in 13 places three always stand that close.
    """

    def __init__(self, ids: list, texts: list[str]):
        self.ids = ids
        typed = [_typed(t) for t in texts]
        flat = [w for words in typed for w in words]
        self.spelled = [w for w, _ in flat]
        self.kind = np.array([k for _, k in flat], np.int64)
        self.item = np.repeat(np.arange(len(typed)), [len(words) for words in typed])
        self.vocabulary: dict[str, int] = {}
        self.word = np.array([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in self.spelled], np.int64)
        # of each word, then number, unit, unknown
        self.values = np.random.default_rng(20200109).integers(1, 1 << 63, len(self.vocabulary) + 3).astype(np.uint64)
        fixed = np.where(self.kind == NUM, -3, np.where([w in UNITS for w in self.spelled], -2, self.word)) if flat else self.word
        self.plain, found = {}, {}
        first = 0
        for words in typed:
            length = min(len(words), WINDOW)
            for begin in range(first, first + len(words) - length + 1 if length >= LEAST else first):
                self.plain.setdefault(tuple(range(length)), []).append((begin, 0, length))
                for shape, offset in self._seeds(tuple(k for _, k in words[begin - first:begin - first + length])):
                    found.setdefault(shape, []).append((begin, offset, length))
            first += len(words)
        self.plain = {shape: self._table(shape, rows, self.values[self.word]) for shape, rows in self.plain.items()}
        self.found = {shape: self._table(shape, rows, self.values[fixed]) for shape, rows in found.items()}

    @staticmethod
    @functools.lru_cache(maxsize=100_000)
    def _seeds(kind: tuple[int, ...]) -> list[tuple[tuple[int, ...], int]]:
        """Shapes and places of the seeds of a template window; none if it cannot have the literal words."""
        sure, least = kind.count(PLAIN), LITERAL if len(kind) == WINDOW else SHORT_LITERAL
        if sure == len(kind) or sure + kind.count(MAYBE) < least:
            return []
        triples = [(t, o) for t in TRIPLES for o in range(len(kind) - t[-1])]
        if sure < least:
            return [(t, o) for t, o in triples if all(kind[o + k] in (PLAIN, MAYBE) for k in t)]
        runs = [(t, o) for t in RUNS for o in range(len(kind) - t[-1]) if all(kind[o + k] not in (NAME, MAYBE) for k in t)]
        able = runs + [(t, o) for t, o in triples if all(kind[o + k] == PLAIN for k in t)]
        return [max(able, key=lambda s: (sum(kind[s[1] + k] == PLAIN for k in s[0]), -s[0][-1]))]

    @staticmethod
    def _table(shape: tuple[int, ...], rows: list, values: np.ndarray) -> Seeds:
        begin, offset, length = np.array(rows, np.int64).T
        return Seeds(_shape_hash(values, anchors.prefix_sums(values), shape)[begin + offset], begin, offset, length)


class Lookup:
    """Windows of the items among the words of some texts."""

    def __init__(self, items: Items, words: Words):
        self.items, self.words = items, words
        known = pc.index_in(words.spelled, value_set=pa.array(list(items.vocabulary), words.spelled.type))
        self.word = np.asarray(pc.fill_null(known, -1))[words.at]
        self.fits = {NUM: words.number, UNIT: words.unit, NAME: words.fits, MAYBE: words.fits}
        self.plain = items.values[self.word]
        self.fixed = items.values[np.where(words.number, -3, np.where(words.unit, -2, self.word))]

    def windows(self, tables: dict, values: np.ndarray, template: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matching windows, each pair once: begin among the words, begin among the items' words, length."""
        sums = anchors.prefix_sums(values)
        out = [np.zeros((3, 0), np.int64)]
        for shape, seeds in tables.items():
            for at, seed in seeds.candidates(_shape_hash(values, sums, shape)):
                here, there, length = at - seeds.offset[seed], seeds.begin[seed], seeds.length[seed]
                keep = (here >= 0) & (here + length <= len(values))
                here, there, length = here[keep], there[keep], length[keep]
                keep = self.words.text[here] == self.words.text[here + length - 1]
                out.append(self._alike(here[keep], there[keep], length[keep], template))
        here, there, length = np.concatenate(out, 1)
        _, once = np.unique(here * len(self.items.word) + there, return_index=True)
        return here[once], there[once], length[once]

    def _alike(self, here: np.ndarray, there: np.ndarray, length: np.ndarray, template: bool) -> np.ndarray:
        """Those windows whose words are alike: the words themselves, not only their hash."""
        literal, slots = np.zeros((2, len(here)), np.int64)
        for j in range(WINDOW):
            inside = j < length
            h, t = np.where(inside, here + j, here), np.where(inside, there + j, there)
            same = self.word[h] == self.items.word[t]
            if template:
                kind = self.items.kind[t]
                slot = (kind != PLAIN) & ~((kind == MAYBE) & same)
                literal += inside & ~slot
                slots += inside & slot
                for k, fits in self.fits.items():
                    same = np.where((kind == k) & fits[h], True, same & ((kind != k) | (k in (NAME, MAYBE))))
            keep = same | ~inside
            here, there, length, literal, slots = (x[keep] for x in (here, there, length, literal, slots))
        if template:
            keep = (slots > 0) & (literal >= np.where(length == WINDOW, LITERAL, SHORT_LITERAL))
            here, there, length = here[keep], there[keep], length[keep]
        return np.array([here, there, length], np.int64)

    def slots(self, here: int, there: int, size: int) -> list[tuple[int, int, str, str]]:
        """Filled slots of a span: place, kind, value in the item, value in the document."""
        kind = self.items.kind[there:there + size]
        same = self.items.word[there:there + size] == self.word[here:here + size]
        return [(int(j), NAME if kind[j] == MAYBE else int(kind[j]), self.items.spelled[there + j],
                 self.words.spelled[int(self.words.at[here + j])].as_py()) for j in np.flatnonzero((kind != PLAIN) & ~((kind == MAYBE) & same))]

    def counted(self, here: int, there: int, count: int, length: int) -> int:
        """Windows with consistent slots in a run of ``count`` matching ones."""
        return _steady(self.slots(here, there, count + length - 1), count, length)


def _steady(slots: list[tuple[int, int, str, str]], count: int, length: int) -> int:
    """Windows of a run within which each slot value of the item stands for one of the document, and for names the other way round."""
    last: dict[tuple[int, str], tuple[int, str, int]] = {}  # place and value of the latest, place of the latest other value
    clash = np.full(count + length, -1)  # per place of a window's last word: a place it must not reach back to
    for place, k, a, b in slots:
        for key, value in [((k, a), b)] + [((BACK, b), a)] * (k == NAME):
            at, before, other = last.get(key, (-1, value, -1))
            if before != value:
                other = at
            last[key] = place, value, other
            clash[place] = max(clash[place], other)
    clash = np.maximum.accumulate(clash)
    begin = np.arange(count)
    return int((clash[begin + length - 1] < begin).sum())


def _hits(items: Items, words: Words) -> list[dict[int, list[int]]]:
    """Per text: item -> [plain windows, template windows]."""
    out: list[dict[int, list[int]]] = [{} for _ in range(words.texts)]
    if not len(words.at):
        return out
    found = Lookup(items, words)
    here, there, _ = found.windows(items.plain, found.plain, False)
    for text, item in zip(words.text[here], items.item[there]):
        out[text].setdefault(int(item), [0, 0])[0] += 1
    here, there, length = found.windows(items.found, found.fixed, True)
    shift = here - there
    order = np.lexsort((here, items.item[there], shift))
    here, there, length, shift = here[order], there[order], length[order], shift[order]
    cut = (np.diff(here) != 1) | (np.diff(shift) != 0)  # the next window of the same item at the same shift
    cut |= np.diff(items.item[there]) != 0
    for run in np.split(np.arange(len(here)), np.flatnonzero(cut) + 1):
        if len(run):
            i = run[0]
            count = found.counted(int(here[i]), int(there[i]), len(run), int(length[i]))
            if count:
                out[words.text[here[i]]].setdefault(int(items.item[there[i]]), [0, 0])[1] += count
    return out


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> list[Items]:
    rows = benchmark.select(named(id_col).cast(_id_kind(benchmark, id_col)).alias("id"), named(text_col).alias("text")).filter(
        "text IS NOT NULL")
    order = numbered(rows, [F.col("id").asc_nulls_last(), F.col("text").asc()], "nth")
    count = order.count()
    out = []
    for lo in range(0, count, BLOCK):
        some = order.filter(F.col("nth").between(lo, lo + BLOCK - 1)).orderBy("nth").collect()
        out.append(Items([r.id for r in some], [r.text for r in some]))
    return out


def _id_kind(benchmark: DataFrame, id_col: str) -> str:
    """Item ids stay whole numbers; all others are taken as text."""
    return "long" if dict(benchmark.dtypes)[id_col] in ("bigint", "int", "smallint", "tinyint") else "string"


def matched(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", name: str = "hits", item_id: str = "item_id",
            item_text: str = "text") -> DataFrame:
    """``docs`` with one more column: the items each document holds, with matching plain and template windows.

    A column that already has its name is replaced.
    """
    item_kind = _id_kind(benchmark, item_id)
    kind = pa.list_(pa.struct([("item", pa.int64() if item_kind == "long" else pa.string()), ("plain", pa.int64()), ("template", pa.int64())]))
    hits_kind = f"array<struct<item:{item_kind},plain:long,template:long>>"
    docs = docs.drop(name)
    columns = docs.columns
    at = columns.index(text_col)
    plain = plain_names(docs)
    schema = ", ".join(f"{c} {t}" for c, t in plain.dtypes) + f", hits {hits_kind}"
    plain_columns = plain.columns
    blocks = _blocks(benchmark, item_id, item_text)
    if not blocks:
        return docs.withColumn(name, F.lit(None).cast(hits_kind))

    def look(batches):
        for batch in batches:
            texts = pc.fill_null(batch.column(at), "")
            size = np.concatenate([[0], np.cumsum(np.asarray(pc.binary_length(texts), np.int64))])
            for lo, hi in row_slices(len(texts), size, SLICE):
                words = Words(texts.slice(lo, hi - lo))
                hits: list[list[dict]] = [[] for _ in range(hi - lo)]
                for items in blocks:
                    for mine, own in zip(hits, _hits(items, words)):
                        mine += [{"item": items.ids[w], "plain": p, "template": t} for w, (p, t) in sorted(own.items())]
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(hits, kind)], [*plain_columns, "hits"])
        _word.cache_clear()  # the worker goes on to other stages

    return own_names(plain.mapInArrow(look, schema), [*columns, name])


def filter(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no window of the benchmark, all columns as they are."""
    name = "_hits" + "_" * max(map(len, docs.columns))
    found = matched(docs, benchmark, text_col, name)
    return found.filter(F.coalesce(F.size(name), F.lit(0)) <= 0).drop(name)


@query("op9_decontamination")
def op9(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = matched(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", (F.coalesce(F.size("hits"), F.lit(0)) > 0).alias("contaminated"),
        F.expr("array_join(transform(hits, h -> h.item), ',')").alias("item_ids"),
        F.expr("coalesce(aggregate(hits, 0L, (s, h) -> s + h.plain), 0L)").alias("plain_windows"),
        F.expr("coalesce(aggregate(hits, 0L, (s, h) -> s + h.template), 0L)").alias("template_windows"))
