"""Near-duplicate documents by a signature-coordinate inverted join.

A document's set holds its distinct word shingles; equal sets form a class and only one
document of it is posted. Each posted document has ``COORDINATES`` minhash values and is
listed under every (coordinate, value) it has. Two documents of the wanted similarity agree in
at least ``MATCHES`` coordinates but for a chance of about 1e-8, so:

- prefix: values that nobody else has cannot match; of a document's other values only the rarest
  are posted, as many as a pair with ``MATCHES`` agreements must share one of;
- hubs: the documents of a posting that agree with its most connected one in enough coordinates are its
  neighbours. A hub's neighbours meet once, with their full sets: what is linked to the hub is
  joined, and only what is not is compared with the others. A task gives a spanning tree of the links it
  finds, never all pairs. Neighbourhoods of more than ``TOKENS`` shingles are cut into blocks, and what is
  then still apart from the hub visits every block;
- skip: other pairs of a posting are formed only between different groups, only if their sizes
  allow the similarity, only under the first posting they share, and only with
  ``MATCHES`` agreements in all coordinates; they are confirmed on the full sets.

Every pair that shares a posting is thus compared or already joined through others; no link is lost.

Edge cases: null or wordless texts have empty sets, link with nothing and stay. A
text with fewer words than a shingle is one shingle. Ids that are null, repeated
or not whole numbers are ordered as ``common.keyed`` states; rows that repeat both id and text are
one document. Empty tables give no rows. ``filter`` keeps all columns, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..operators.joins import BROADCAST_ROWS, sized
from . import anchors, segment_join as S
from .common import keyed, query, stored, table
from .components import components

COORDINATES = 64
MATCHES = 32
#: Documents of one posting that are compared in one task; larger postings are cut into pairs of such blocks.
BLOCK = 2048
#: Shingles of a neighbourhood that are compared in one task.
TOKENS = 400_000
SEED = 20200102


def _shingles(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, sorted within each, and the size of each set."""
    raw, offsets = anchors.text_buffers(texts)
    _, _, word, first = anchors.words(raw, offsets, lower=True)
    count = np.diff(first)
    length = np.where(count < words, count, words)
    n = np.where(count < words, (count > 0).astype(np.int64), count - words + 1)
    text = np.repeat(np.arange(len(count)), n)
    start = np.repeat(first[:-1], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    sums = anchors.prefix_sums(word)
    hashes = anchors.mixed(anchors.span_hash(sums, start, start + length[text]) + length[text].astype(np.uint64))
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    return hashes[new], np.bincount(text[new], minlength=len(count))


def _signatures(hashes: np.ndarray, size: np.ndarray) -> np.ndarray:
    """One row of minhash values per set that is not empty."""
    rng = np.random.default_rng(SEED)
    odd = rng.integers(1, 1 << 63, COORDINATES).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    flip = rng.integers(1, 1 << 63, COORDINATES).astype(np.uint64)
    start = (np.cumsum(size) - size)[size > 0]
    out = np.zeros((len(start), COORDINATES), np.uint64)
    for k in range(COORDINATES):
        x = (hashes ^ flip[k]) * odd[k]
        x ^= x >> np.uint64(29)
        out[:, k] = np.minimum.reduceat(x * odd[-1 - k], start) if len(start) else 0
    return (out >> np.uint64(32)).astype(np.uint32).view(np.int32)


def sketches(rows: DataFrame, words: int) -> DataFrame:
    """key, n_shingles, mark1, mark2 (of the set), signature (binary) of keyed documents."""
    def run(batches):
        for batch in batches:
            for lo, texts in S.slices(batch.column(1)):
                hashes, size = _shingles(texts, words)
                full = size > 0
                start = (np.cumsum(size) - size)[full]
                marks = np.zeros((2, len(size)), np.uint64)
                if full.any():
                    marks[0, full] = np.add.reduceat(anchors.mixed(hashes), start)
                    marks[1, full] = np.add.reduceat(anchors.mixed(hashes ^ np.uint64(anchors.BASE)), start)
                signature = np.full(len(size), None, object)
                signature[full] = [s.tobytes() for s in _signatures(hashes, size)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, len(texts)), pa.array(size), pa.array(marks[0].view(np.int64)),
                     pa.array(marks[1].view(np.int64)), pa.array(signature, pa.binary())],
                    ["key", "n_shingles", "mark1", "mark2", "signature"])

    return rows.select("key", "text").mapInArrow(
        run, "key long, n_shingles long, mark1 long, mark2 long, signature binary")


def _values(posted: DataFrame) -> DataFrame:
    """A row per document and coordinate: key and spot (coordinate and value in one number)."""
    def run(batches):
        high = np.arange(COORDINATES, dtype=np.int64) << 32
        for batch in batches:
            values = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint32).astype(np.int64)
            times = len(values) // COORDINATES
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(pa.array(np.repeat(np.arange(times), COORDINATES))),
                 pa.array(values | np.tile(high, times))], ["key", "spot"])

    return posted.select("key", "signature").mapInArrow(run, "key long, spot long")


def postings(posted: DataFrame, matches: int = MATCHES) -> DataFrame:
    """Prefix postings: key, n, spot, weight (how connected the document is), prefix (its posted coordinates as bits)."""
    values = _values(posted)
    common = values.groupBy("spot").agg(F.count("*").alias("held")).filter("held > 1")
    listed = values.join(common, "spot")
    own = listed.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("held", "spot"))).alias("own"))
    # at most COORDINATES entries a document; the rarest that a pair with enough matches cannot all miss
    own = own.filter(F.size("own") >= matches).withColumn("weight", F.expr("aggregate(own, 0L, (s, x) -> s + x.held)"))
    own = own.withColumn("own", F.expr(f"slice(own, 1, size(own) - {matches} + 1)"))
    prefix = F.expr("aggregate(own, 0L, (s, x) -> s | shiftleft(1L, cast(shiftright(x.spot, 32) as int)))")
    return own.select("key", "weight", prefix.alias("prefix"), F.explode("own.spot").alias("spot")).join(
        posted.select("key", "n"), "key")


def _sets(rows: DataFrame, keys: DataFrame, words: int) -> DataFrame:
    """(key, set) with the full shingle sets of the given documents."""
    def run(batches):
        for batch in batches:
            for lo, texts in S.slices(batch.column("text")):
                hashes, size = _shingles(texts, words)
                offsets = pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").slice(lo, len(texts)), pa.ListArray.from_arrays(offsets, pa.array(hashes.view(np.int64)))],
                    ["key", "set"])

    return rows.select("key", "text").join(sized(keys), "key", "left_semi").mapInArrow(run, "key long, set array<long>")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose full sets are similar enough."""
    both = pairs.join(sets.select(F.col("key").alias("a"), F.col("set").alias("set_a")), "a").join(
        sets.select(F.col("key").alias("b"), F.col("set").alias("set_b")), "b")
    shared = F.size(F.array_intersect("set_a", "set_b"))
    both = both.select("a", "b", shared.alias("shared"), (F.size("set_a") + F.size("set_b")).alias("sizes"))
    return both.filter(100 * F.col("shared") >= percent * (F.col("sizes") - F.col("shared"))).select("a", "b")


def _compatible(n: str, m: str, percent: int):
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def _rest(listed: DataFrame, hubs: DataFrame, near: DataFrame, posted: DataFrame, group: DataFrame, percent: int,
          matches: int) -> DataFrame:
    """Pairs (a, b) that a posting lists, of different groups, not both near its hub, that agree in enough coordinates."""
    named = listed.join(group, "key", "left").withColumn("component", F.coalesce("component", "key")).join(
        hubs.select("spot", "hub"), "spot").join(near.select("key", "hub", F.lit(True).alias("near")), ["key", "hub"], "left")
    named = named.withColumn("near", F.coalesce("near", F.col("key") == F.col("hub")))
    mixed = named.groupBy("spot").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("held"),
        F.count_if(~F.col("near")).alias("far")).filter("low < high AND far > 0")
    live = named.join(mixed.select("spot", "held"), "spot")
    # large postings: a row for each pair of blocks that its block takes part in
    blocks = F.ceil(F.col("held") / BLOCK).cast("int")
    live = live.withColumn("block", F.pmod(F.xxhash64("key"), blocks).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    live = live.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
    live = live.join(posted.select("key", "signature"), "key").select(
        "spot", "i", "j", "block", "key", "n", "near", "component", "prefix", "signature")

    def solve(own: pa.Table):
        key, n, component, near_hub, spot, i, j, block = (
            np.asarray(own[c]) for c in ("key", "n", "component", "near", "spot", "i", "j", "block"))
        at = np.uint64(spot[0] >> 32)
        prefix = np.asarray(own["prefix"]).view(np.uint64)
        signature = np.frombuffer(b"".join(own["signature"].to_pylist()), np.int32).reshape(len(key), -1)
        a_all, b_all = [], []
        for a in np.flatnonzero(~near_hub):
            b = np.arange(len(key))
            b = b[(component != component[a]) & (100 * np.minimum(n[a], n) >= percent * np.maximum(n[a], n))
                  & (near_hub | (b > a)) & ((i[a] == j[a]) | (block != block[a]))]
            if not len(b):
                continue
            same = signature[b] == signature[a]
            keep = same.sum(1) >= matches
            # bits of the coordinates that both list and agree in; the lowest is where the pair counts
            bits = np.packbits(same, axis=1, bitorder="little").view(np.uint64)[:, 0] & prefix[a] & prefix[b]
            keep &= (bits & (~bits + np.uint64(1))) == np.uint64(1) << at
            a_all.append(np.full(keep.sum(), key[a]))
            b_all.append(key[b[keep]])
        a, b = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (a_all, b_all))
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    return live.repartition("spot", "i", "j").sortWithinPartitions("spot", "i", "j").mapInArrow(
        _by_group(["spot", "i", "j"], solve), "a long, b long")


def _by_group(names: list[str], solve):
    """Run ``solve`` on each group of rows that are sorted by ``names``, across batches."""
    def run(batches):
        held: list[pa.RecordBatch] = []

        def solved():
            own = pa.Table.from_batches(held)
            return solve(own.combine_chunks()) if len(own) > 1 else None
        for batch in batches:
            marks = [np.asarray(batch.column(c)) for c in names]
            new = np.zeros(batch.num_rows, bool)
            new[1:] = np.any([m[1:] != m[:-1] for m in marks], axis=0)
            if held and batch.num_rows:
                new[0] = any(held[-1].column(c)[-1].as_py() != m[0] for c, m in zip(names, marks))
            lo = 0
            for hi in np.flatnonzero(new):
                if hi > lo:
                    held.append(batch.slice(lo, hi - lo))
                done = solved() if held else None
                if done is not None and done.num_rows:
                    yield done
                held, lo = [], hi
            if lo < batch.num_rows:
                held.append(batch.slice(lo))
        done = solved() if held else None
        if done is not None and done.num_rows:
            yield done
    return run


HUB, MEMBER, VISITOR = 0, 1, 2


def _spanning(own: pa.Table, percent: int) -> pa.RecordBatch:
    """Links of one block of a neighbourhood, as a spanning forest: to its hub, then of all that is not linked to it.

    Visitors are compared with the members only.
    """
    key, role = np.asarray(own["key"]), np.asarray(own["role"])
    component = np.asarray(own["component"])
    sets = [np.frombuffer(x, np.int64) for x in own["set"].to_pylist()]
    size = np.array([len(x) for x in sets])
    owner = np.repeat(np.arange(len(sets)), size)
    tokens, code = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(code, kind="stable")
    holders, start = owner[order], np.searchsorted(code[order], np.arange(len(tokens) + 1))
    first = np.cumsum(size) - size
    root = np.arange(len(sets))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x
    seen: dict[int, int] = {}
    for x in range(len(sets)):  # what is known to be joined
        root[find(x)] = find(seen.setdefault(int(component[x]), x))
    a_all, b_all = [], []

    def compare(x: int, others: np.ndarray) -> None:
        mine = code[first[x]:first[x] + size[x]]
        count = start[mine + 1] - start[mine]
        at = np.repeat(start[mine] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        shared = np.bincount(holders[at], minlength=len(sets))
        hit = others & (100 * shared >= percent * (size[x] + size - shared))
        hit[x] = False
        for y in np.flatnonzero(hit):
            p, q = find(x), find(int(y))
            if p != q:
                root[p] = q
                a_all.append(key[x])
                b_all.append(key[y])
    everyone = role != VISITOR
    for x in np.flatnonzero(role == HUB):
        compare(int(x), everyone)
    visitors = np.flatnonzero(role == VISITOR)
    if len(visitors):
        todo, others = visitors, role == MEMBER
    else:
        hub = [find(int(x)) for x in np.flatnonzero(role == HUB)]
        todo, others = [x for x in range(len(sets)) if not hub or find(x) != hub[0]], everyone
    for x in todo:
        compare(int(x), others)
    return pa.RecordBatch.from_arrays([pa.array(a_all, pa.int64()), pa.array(b_all, pa.int64())], ["a", "b"])


def _meet(rows: DataFrame, places: DataFrame, words: int, percent: int) -> DataFrame:
    """Links found where documents meet: ``places`` (key, hub, block, role, component) get the sets and are solved."""
    lists = stored(places.groupBy("key", "component").agg(F.collect_list(F.struct("hub", "block", "role")).alias("at")), "places")
    # measured by entries: only a short list is broadcast, beyond that the texts are shuffled to it
    few = (lists.agg(F.sum(F.size("at"))).first()[0] or 0) <= BROADCAST_ROWS
    both = rows.select("key", "text").join(F.broadcast(lists) if few else lists, "key")
    schema = "hub long, block int, role int, key long, component long, set binary"

    def run(batches):
        for batch in batches:
            for lo, texts in S.slices(batch.column("text")):
                hashes, size = _shingles(texts, words)
                ends = np.cumsum(size)
                keys, components_, lists_ = (batch.column(c).slice(lo, len(texts)).to_pylist() for c in ("key", "component", "at"))
                entries = [(x, i) for i, own in enumerate(lists_) for x in own]
                for c in range(0, len(entries), 512):
                    some = entries[c:c + 512]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x["hub"] for x, _ in some], pa.int64()), pa.array([x["block"] for x, _ in some], pa.int32()),
                         pa.array([x["role"] for x, _ in some], pa.int32()), pa.array([keys[i] for _, i in some], pa.int64()),
                         pa.array([components_[i] for _, i in some], pa.int64()),
                         pa.array([hashes[ends[i] - size[i]:ends[i]].tobytes() for _, i in some], pa.binary())],
                        ["hub", "block", "role", "key", "component", "set"])

    return both.mapInArrow(run, schema).repartition("hub", "block").sortWithinPartitions("hub", "block").mapInArrow(
        _by_group(["hub", "block"], lambda own: _spanning(own, percent)), "a long, b long")


def _neighbourhoods(rows: DataFrame, near: DataFrame, words: int, percent: int) -> DataFrame:
    """Links among the neighbours of each hub. ``near``: key, hub, n."""
    sizes = near.groupBy("hub").agg(F.sum("n").alias("tokens"))
    blocks = sizes.select("hub", F.ceil(F.col("tokens") / TOKENS).cast("int").alias("blocks"))
    members = near.join(blocks, "hub").select(
        "key", "hub", F.pmod(F.xxhash64("key"), "blocks").cast("int").alias("block"), F.lit(MEMBER).alias("role"), "blocks")
    heads = blocks.select(F.col("hub").alias("key"), "hub", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
                          F.lit(HUB).alias("role"))
    places = members.drop("blocks").unionByName(heads).withColumn("component", F.col("key"))
    found = stored(_meet(rows, places, words, percent), "links")
    wide = stored(members.filter("blocks > 1"), "wide")
    if wide.isEmpty():
        return found
    group = stored(components(found), "groups")
    named = wide.join(group, "key", "left").withColumn("component", F.coalesce("component", "key"))
    of_hub = wide.select("hub").distinct().join(
        group.select(F.col("key").alias("hub"), F.col("component").alias("joined")), "hub", "left").withColumn(
        "joined", F.coalesce("joined", "hub"))
    apart = named.join(of_hub, "hub").filter("component != joined")
    visits = apart.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).filter("other != block").select(
        "key", "hub", F.col("other").alias("block"), F.lit(VISITOR).alias("role"), "component")
    hosts = named.join(apart.select("hub").distinct(), "hub", "left_semi").select("key", "hub", "block", "role", "component")
    return found.unionByName(stored(_meet(rows, hosts.unionByName(visits), words, percent), "links"))


def _agreeing(pairs: DataFrame, posted: DataFrame, matches: int) -> DataFrame:
    """Those of the pairs (a, b) whose signatures agree in enough coordinates."""
    both = pairs.join(posted.select(F.col("key").alias("a"), F.col("signature").alias("sig_a")), "a").join(
        posted.select(F.col("key").alias("b"), F.col("signature").alias("sig_b")), "b")

    def run(batches):
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.int32).reshape(batch.num_rows, -1)
                    for c in ("sig_a", "sig_b"))
            yield batch.select(["a", "b"]).filter(pa.array((a == b).sum(1) >= matches))

    return both.select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long")


def linked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 2, percent: int = 80,
           matches: int = MATCHES) -> DataFrame:
    """key, id, mark (hash of the text), n_shingles, component (a key), component_id, kept: one row per document."""
    rows = keyed(docs, id_col, text_col)
    drawn = stored(sketches(rows, words), "sketches")
    marks = ["n_shingles", "mark1", "mark2"]
    classes = drawn.filter("n_shingles > 0").groupBy(*marks).agg(F.min("key").alias("class"))
    posted = drawn.join(classes.select(F.col("class").alias("key")), "key", "left_semi").withColumnRenamed(
        "n_shingles", "n")
    posted = stored(posted.select("key", "n", "signature"), "posted")
    listed = stored(postings(posted, matches), "postings")
    hubs = listed.groupBy("spot").agg(F.max(F.struct("weight", (-F.col("key")).alias("least"), "n")).alias("hub")).select(
        "spot", (-F.col("hub.least")).alias("hub"), F.col("hub.n").alias("m"))
    pairs = listed.join(hubs, "spot").filter("key != hub").filter(_compatible("n", "m", percent)).select(
        F.col("key").alias("a"), F.col("hub").alias("b")).distinct()
    near = stored(_agreeing(pairs, posted, matches).select(F.col("a").alias("key"), F.col("b").alias("hub")).join(
        posted.select("key", "n"), "key"), "near")
    links = _neighbourhoods(rows, near, words, percent)
    group = stored(components(links), "groups")
    others = stored(_rest(listed, hubs, near, posted, group, percent, matches), "pairs")
    keys = others.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    rest = confirmed(others, stored(_sets(rows, keys, words), "sets"), percent)
    found = components(links.unionByName(rest))
    whole = classes.join(found.withColumnRenamed("key", "class"), "class", "left").select(
        *marks, F.coalesce("component", "class").alias("component"))
    ids = rows.select("key", "id").distinct()
    return rows.select("key", "id", F.xxhash64("text").alias("mark")).join(
        drawn.drop("signature").distinct(), "key").join(whole, marks, "left").select(
        "key", "id", "mark", "n_shingles", F.coalesce("component", "key").alias("component")).join(
        ids.select(F.col("key").alias("component"), F.col("id").alias("component_id")), "component").withColumn(
        "kept", F.col("key") == F.col("component"))


def filter(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay, one document of each group, all columns as they are."""
    found = linked(docs, id_col, text_col, words, percent)
    # what goes, by id and text, as an id may stand for several texts
    gone = found.filter("NOT kept").select("id", "mark").distinct()
    text = F.xxhash64(F.coalesce(docs[text_col], F.lit("")))
    return docs.join(gone, docs[id_col].eqNullSafe(gone["id"]) & (text == gone["mark"]), "left_anti")


@query("op8_minhash_dedup")
def op8(spark, sf_dir):
    return linked(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")
