import itertools
import math
import re
import zlib
from collections import defaultdict

import tokenizers

import corpus_pipeline as C
from telemill.llm import decontamination, language, tokens

from .test_decontamination import bare


def test_stages_work_on_what_is_left(spark, sf_dir):
    text = " ".join(f"der die und{i} von" for i in range(30))
    rows = [(1, text), (2, text.replace(" ", "  ")), (3, text + " noch"), (4, None), (5, "1234"), (6, "Ein anderer Text, der bleibt.")]
    docs = spark.createDataFrame([(i, t, "de" if i % 2 else None, "s", 0) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    seen = []
    for name, stage in C.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        seen.append(sorted(r.doc_id for r in docs.collect()))
    assert seen == [[1, 2, 3, 6], [1, 3, 6], [1, 6], [1, 6]]
    pieces = C.STAGES[-1][1](spark, docs, sf_dir)
    assert sorted(r.doc_id for r in pieces.collect()) == [1, 6]


def plain_fit(samples, text):
    """Fit of the language that needs the fewest bits, by searching every phrase in the samples."""
    folded, costs = language._folded(text), []
    for own in samples:
        whole = ended = 0
        for lo in range(0, len(folded), language.BLOCK):
            stretch, i = folded[lo:lo + language.BLOCK], 0
            while i < len(stretch):
                k = 1
                while i + k < len(stretch) and stretch[i:i + k + 1] in own:
                    k += 1
                i += k
                whole, ended = whole + 1, ended + (i < len(stretch))
        costs.append((whole * math.log2(2 + len(own.replace("\n", ""))), ended))
    return 1 - min(costs)[1] / len(folded)


def test_run_against_plain_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    # language
    samples = language.sample(docs.filter(~language.held_out()))
    joined = ["\n".join(map(language._folded, own)) for _, own in sorted(samples.items())]
    left = {i: t for i, t in texts.items() if t and any(c.isalpha() for c in t) and plain_fit(joined, t) > language.LEAST_FIT}
    # exact copies
    first = {}
    for i in sorted(left):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", left[i]), i)
    left = {i: left[i] for i in first.values()}
    # near copies
    sets = {}
    for i, t in left.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t))
        sets[i] = {tuple(words[k:k + 5]) for k in range(max(len(words) - 4, 1))} if words else set()
    least = {i: i for i in left}
    for a, b in itertools.combinations(sorted(left), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and least[a] != least[b]:
            lo, hi = sorted((least[a], least[b]))
            least = {i: lo if c == hi else c for i, c in least.items()}
    near = {i: t for i, t in left.items() if least[i] == i}
    # benchmark: 13 bare words, or a whole shorter item
    held = set()
    for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect():
        words = bare(r.text)
        n = min(len(words), decontamination.WINDOW)
        held |= {tuple(words[k:k + n]) for k in range(len(words) - n + 1 if n >= decontamination.LEAST else 0)}
    sizes = {len(w) for w in held}
    dirty = {i for i, t in near.items() for words in [bare(t)] for n in sizes for k in range(len(words) - n + 1) if tuple(words[k:k + n]) in held}
    clean = near.keys() - dirty
    assert len(texts) > len(left) > len(near) > len(clean)  # every later stage has work here
    # packing
    rows = C.run(spark, sf_dir).collect()
    assert {r.doc_id for r in rows} == clean
    tokenizer = tokenizers.Tokenizer.from_file(tokens.default_path())
    total = 0
    for i, own in itertools.groupby(sorted(rows, key=lambda r: (r.doc_id, r.piece)), key=lambda r: r.doc_id):
        ids = tokenizer.encode(texts[i] or "", add_special_tokens=False).ids + [1]
        want = [(k, at, ids[at:at + 4096]) for k, at in enumerate(range(0, len(ids), 4096))]
        assert [(r.piece, r.start, r.length, r.ids_crc32) for r in own] == [
            (k, at, len(p), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in p))) for k, at, p in want]
        total += len(ids)
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for own in by_sequence.values():
        own.sort()
        ends = [0, *itertools.accumulate(n for _, n in own)]
        assert [at for at, _ in own] == ends[:-1] and ends[-1] <= 4096
    assert len(by_sequence) <= -(-total // 4096) + 1


def test_empty_and_odd_tables(spark, tmp_path):
    bench = spark.createDataFrame([(1, None)], "item_id long, text string")
    schema = "doc_id long, text string, lang string, source string, n_chars long, `a.b` int"
    same = "the same text stands here twice and more than once in this table"
    rows = [(1, same, "en", "s", 1, 1), (1, same, "en", "s", 1, 1), (None, same + " again and again", "en", "s", 1, 1), (2, None, None, None, None, None),
            (3, "", "en", None, 0, 0), (4, "word and text " * 30000, None, "s", 1, 2)]
    for name, own in (("none", []), ("odd", rows)):
        folder = tmp_path / name
        spark.createDataFrame(own, schema).write.parquet(f"{folder}/documents.parquet")
        bench.write.parquet(f"{folder}/benchmark.parquet")
        got = C.run(spark, str(folder)).collect()
        assert {r.doc_id for r in got} == ({1, None, 4} if own else set())
        assert len([r for r in got if r.doc_id == 1]) == bool(own)
