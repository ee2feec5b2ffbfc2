"""N-gram Jaccard join by size-banded tiles with hashed bitmap signatures.

A document's set holds its distinct word shingles; equal sets form a class and only one document of it is
compared. Two sets link when their Jaccard similarity reaches ``percent``.

- Survivors. Of a set of n shingles that a link shares at least ``needed(n)`` of, the
  n - needed(n) + e smallest hashes must hold e shared ones, whatever the partner. Only these are posted, counted
  with combining before the shuffle, and a document with fewer than e of them held by others leaves at once.
- Clusters. A survivor lists the rarest of its shared hashes, as many as two linked documents cannot all
  miss. Documents that share a listed hash are in one cluster, found by connected components, so a text moves once.
- Tiles. Band borders grow so that linked sets lie in one band or in two that touch. A tile is a band of a cluster with
  the band below as guests, so that every pair of compatible sizes meets in exactly one tile.
- Bitmaps. In a tile every set hashes into a bitmap as wide as the band needs. Half of the
  sum of sizes less the differing bits bounds the overlap from above; only pairs that pass go through the exact intersection of sorted
  arrays. The most connected set of a tile (its hub) is compared with all others first. What is linked to it is joined, and only
  sets that are not yet joined are compared further; a task hands on a spanning forest of its links.
- A tile of more than ``TOKENS`` shingles is cut into blocks. The hub visits each of them, and after that only those
  sets that are apart from the hub's component visit the other blocks. This is exact, and its cost is that of the sets apart
  times the tile, not of the tile squared.

Every pair of a similarity of at least ``percent`` is thus compared or already joined through others; no link is lost.

Edge cases: null or wordless texts have empty sets, link with nothing and are their own component. A text with
fewer words than a shingle is one shingle. Ids that are null, repeated or not whole numbers are ordered as
``common.keyed`` states; rows that repeat both id and text are one document and get the same line. Empty tables give no
rows. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.joins import sized
from . import anchors
from .common import keyed, query, row_slices, stored, table
from .components import components

WORDS = 4
PERCENT = 85
#: Shingles of the sets that are compared in one task.
TOKENS = 2_000_000
#: Bytes of text a task works on at once.
SLICE = 2 << 20
#: Bits of the widest bitmap.
WIDEST = 1 << 16
#: Keys that are sent to all executors at most (24 bytes each); more are joined by a shuffle.
KEYS = 2_000_000

HOST, HUB, VISITOR = 0, 1, 2


def needed(n: Column | int, percent: int):
    """Shingles that a set of n must share with any linked partner: the least whole number not below n percent."""
    if isinstance(n, int):
        return -(-n * percent // 100)
    return F.floor((n * percent + 99) / 100).cast("long")


def surplus(n, percent: int):
    """How many posted shingles two linked sets must share; grows with n and never exceeds ``needed``."""
    if isinstance(n, np.ndarray):
        return np.minimum(-(-n * percent // 100), np.maximum(8, n // 10))
    return F.least(needed(n, percent), F.greatest(F.lit(8), F.floor(n / 10))).cast("long")


def borders(percent: int, largest: int) -> list[int]:
    """Least size of each band: sets two bands apart are never similar enough. ``percent`` above 0."""
    out = [1]
    while out[-1] <= largest:
        out.append(100 * out[-1] // percent + 1)  # the least size that is not compatible with the border before
    return out


def shingles(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, sorted within each, and the size of each set."""
    raw, offsets = anchors.text_buffers(texts)
    _, _, word, first = anchors.words(raw, offsets, lower=True)
    count = np.diff(first)
    length = np.minimum(count, words)
    n = np.where(count < words, np.minimum(count, 1), count - words + 1)
    owner = np.repeat(np.arange(len(count)), n)
    start = np.repeat(first[:-1] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    hashes = anchors.mixed(anchors.span_hash(anchors.prefix_sums(word), start, start + length[owner])
                           + length[owner].astype(np.uint64))
    hashes = hashes.view(np.int64)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[new], np.bincount(owner[new], minlength=len(count))


def _slices(batch: pa.RecordBatch):
    """(first row, texts) of slices of bounded size."""
    texts = batch.column("text")
    _, offsets = anchors.text_buffers(texts)
    for lo, hi in row_slices(len(texts), offsets, SLICE):
        yield lo, texts.slice(lo, hi - lo)


def sketches(rows: DataFrame, words: int, percent: int) -> DataFrame:
    """key, n, mark1, mark2 (of the set), posted (its smallest hashes) of keyed documents."""
    def run(batches):
        for batch in batches:
            for lo, texts in _slices(batch):
                hashes, size = shingles(texts, words)
                start = np.cumsum(size) - size
                full = size > 0
                marks = np.zeros((2, len(size)), np.uint64)
                if full.any():
                    bits = hashes.view(np.uint64)
                    marks[0, full] = np.add.reduceat(anchors.mixed(bits), start[full])
                    marks[1, full] = np.add.reduceat(anchors.mixed(bits ^ np.uint64(anchors.BASE)), start[full])
                take = size - (-(-size * percent // 100)) + surplus(size, percent)
                take = np.where(full, take, 0)
                at = np.repeat(start - (np.cumsum(take) - take), take) + np.arange(take.sum())
                offsets = pa.array(np.concatenate([[0], np.cumsum(take)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").slice(lo, len(texts)), pa.array(size), pa.array(marks[0].view(np.int64)),
                     pa.array(marks[1].view(np.int64)), pa.ListArray.from_arrays(offsets, pa.array(hashes[at]))],
                    ["key", "n", "mark1", "mark2", "posted"])

    return rows.select("key", "text").mapInArrow(run, "key long, n long, mark1 long, mark2 long, posted array<long>")


def _held(values: DataFrame) -> DataFrame:
    """key and own: the (held, token) pairs of its tokens that other documents hold too, the rarest first."""
    common = values.groupBy("token").agg(F.count("*").alias("held")).filter("held > 1")
    # a document's own tokens, so its text bounds the list
    return values.join(common, "token").groupBy("key").agg(F.sort_array(F.collect_list(F.struct("held", "token"))).alias("own"))


def listings(posted: DataFrame, percent: int) -> DataFrame:
    """key, n, weight (how common its tokens are), token: what each survivor lists."""
    sizes = posted.select("key", "n", surplus(needed(F.col("n"), percent), percent).alias("least"))
    values = posted.select("key", F.explode("posted").alias("token"))
    rarest = F.slice("own.token", F.lit(1), (F.size("own") - F.col("least") + 1).cast("int"))
    weight = F.aggregate("own.held", F.lit(0).cast("long"), lambda total, held: total + held)
    for _ in range(2):  # again, as tokens of documents that left no longer count
        own = _held(values).join(sizes, "key").filter(F.size("own") >= F.col("least"))
        own = stored(own.select("key", "n", weight.alias("weight"), F.col("own.token").alias("tokens"), rarest.alias("rarest")), "survivors")
        values = own.select("key", F.explode("tokens").alias("token"))
    return stored(own.select("key", "n", "weight", F.explode("rarest").alias("token")), "listings")


def clusters(listed: DataFrame) -> DataFrame:
    """key, n, weight, cluster of the documents that share a listed token with another one."""
    first = listed.groupBy("token").agg(F.min("key").alias("b"), F.max("key").alias("last")).filter("b < last")
    edges = listed.select("token", F.col("key").alias("a")).join(first.select("token", "b"), "token").filter("a != b").select("a", "b").distinct()
    found = components(edges).withColumnRenamed("component", "cluster")
    return stored(listed.select("key", "n", "weight").distinct().join(found, "key"), "clusters")


def _band(n: Column, at: list[int]) -> Column:
    """Number of the band of a size, from the sorted borders (a few dozen numbers)."""
    return (F.size(F.filter(F.array(*[F.lit(b) for b in at]), lambda b: b <= n)) - 1).cast("int")


def _places(found: DataFrame, percent: int, tokens: int) -> DataFrame:
    """cluster, band, key, n, own (not a guest), weight, blocks, block: where each document is compared."""
    largest = found.agg(F.max("n")).first()[0] or 1
    found = found.withColumn("band", _band(F.col("n"), borders(percent, largest)))
    own = found.withColumn("own", F.lit(True))
    above = found.select("cluster", (F.col("band") - 1).alias("band")).distinct()
    guests = found.join(sized(above), ["cluster", "band"], "left_semi").withColumns({"band": F.col("band") + 1, "own": F.lit(False)})
    both = own.unionByName(guests)
    # a tile's sizes and hub are combined before the shuffle; a tile of one document has nothing to compare
    head = F.max(F.struct(F.col("own"), "weight", (-F.col("key")).alias("least"))).alias("head")
    tiles = both.groupBy("cluster", "band").agg(F.sum("n").alias("tokens"), F.count("*").alias("held"), head).filter("held > 1")
    tiles = tiles.select("cluster", "band", F.ceil(F.col("tokens") / tokens).cast("int").alias("blocks"),
                         (-F.col("head.least")).alias("hub"))
    return both.join(sized(tiles), ["cluster", "band"]).withColumn("block", F.pmod(F.xxhash64("key"), "blocks").cast("int"))


def _bitmaps(sets: list[np.ndarray], size: np.ndarray) -> np.ndarray:
    """A row of 64-bit words per set; twice as many bits as the largest set has members, up to ``WIDEST``."""
    width = min(WIDEST, 64 << max(0, int(2 * size.max() - 1).bit_length() - 6))
    out = np.zeros((len(sets), width), bool)
    for i, s in enumerate(sets):
        out[i, (s.view(np.uint64) >> np.uint64(40)).astype(np.int64) & (width - 1)] = True
    return np.packbits(out, axis=1).view(np.uint64)


def solve(key: np.ndarray, role: np.ndarray, own: np.ndarray, component: np.ndarray, sets: list[np.ndarray],
          percent: int) -> tuple[list[int], list[int]]:
    """Links (a, b) of one block of a tile, a spanning forest over the known components."""
    size = np.array([len(s) for s in sets])
    bits = _bitmaps(sets, size)
    label = np.unique(component, return_inverse=True)[1].ravel()
    a, b = [], []

    def compare(x: int, others: np.ndarray) -> None:
        others = others[(label[others] != label[x]) & (100 * np.minimum(size[x], size[others]) >= percent * np.maximum(size[x], size[others]))]
        if not len(others):
            return
        total = size[x] + size[others]
        most = (total - np.bitwise_count(bits[others] ^ bits[x]).sum(1, dtype=np.int64)) // 2
        for i in np.flatnonzero(100 * most >= percent * (total - most)):
            y = others[i]
            if label[x] == label[y]:
                continue
            place = np.searchsorted(sets[y], sets[x])
            place[place == size[y]] = 0
            shared = int((sets[y][place] == sets[x]).sum())
            if 100 * shared >= percent * (total[i] - shared):
                a.append(int(key[x]))
                b.append(int(key[y]))
                label[label == label[y]] = label[x]

    everyone = np.arange(len(key))
    visitors = np.flatnonzero(role == VISITOR)
    if len(visitors):
        hosts = everyone[role != VISITOR]
        for x in visitors:
            compare(int(x), hosts if own[x] else hosts[own[hosts]])
        return a, b
    for x in np.flatnonzero(role == HUB):
        compare(int(x), everyone if own[x] else everyone[own])
    hub = np.flatnonzero(role == HUB)
    members = everyone[own]
    for x in everyone:
        if len(hub) and label[x] == label[hub[0]]:
            continue  # whoever is not with the hub looks for the rest
        compare(int(x), everyone if own[x] else members)
    return a, b


def _links(rows: DataFrame, places: DataFrame, words: int, percent: int) -> DataFrame:
    """Links of all tiles. ``places``: cluster, band, block, key, role, own, component."""
    at = F.collect_list(F.struct("cluster", "band", "block", "role", "own", "component")).alias("at")
    lists = stored(places.groupBy("key").agg(at), "places")
    both = rows.select("key", "text").join(sized(lists.select("key"), KEYS), "key", "left_semi").join(lists, "key")
    fields = [("cluster", pa.int64()), ("band", pa.int32()), ("block", pa.int32()), ("role", pa.int32()), ("own", pa.bool_()),
              ("component", pa.int64())]

    def spread(batches):
        for batch in batches:
            for lo, texts in _slices(batch):
                hashes, size = shingles(texts, words)
                ends = np.cumsum(size)
                keys, lists_ = (batch.column(c).slice(lo, len(texts)).to_pylist() for c in ("key", "at"))
                entries = [(x, i) for i, own in enumerate(lists_) for x in own]
                while entries:
                    some, held = [], 0
                    while entries and (not some or held < SLICE):  # copies of a long set go one by one
                        some.append(entries.pop())
                        held += 8 * int(size[some[-1][1]])
                    yield pa.RecordBatch.from_arrays(
                        [*[pa.array([x[f] for x, _ in some], t) for f, t in fields], pa.array([keys[i] for _, i in some], pa.int64()),
                         pa.array([hashes[ends[i] - size[i]:ends[i]].tobytes() for _, i in some], pa.binary())],
                        [*[f for f, _ in fields], "key", "set"])

    def groups(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            marks = [np.asarray(batch.column(c)) for c in ("cluster", "band", "block")]
            new = np.any([m[1:] != m[:-1] for m in marks], axis=0)
            cuts = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
            if held and any(held[-1].column(c)[-1].as_py() != m[0] for c, m in zip(("cluster", "band", "block"), marks)):
                yield held
                held = []
            for lo, hi in zip(cuts[:-2], cuts[1:-1]):
                yield [*held, batch.slice(lo, hi - lo)]
                held = []
            held.append(batch.slice(cuts[-2]))
        if held:
            yield held

    def solved(batches):
        a, b = [], []
        for group in groups(batches):
            tile = pa.Table.from_batches(group).combine_chunks()
            if len(tile) > 1:
                sets = [np.frombuffer(x, np.int64) for x in tile["set"].to_pylist()]
                more = solve(*(np.asarray(tile[c]) for c in ("key", "role", "own", "component")), sets, percent)
                a += more[0]
                b += more[1]
            if len(a) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
                a, b = [], []
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    schema = ("cluster long, band int, block int, role int, own boolean, component long, key long, set binary")
    tile = ["cluster", "band", "block"]
    return both.mapInArrow(spread, schema).repartition(*tile).sortWithinPartitions(*tile).mapInArrow(solved, "a long, b long")


def tile_links(rows: DataFrame, found: DataFrame, words: int, percent: int, tokens: int) -> DataFrame:
    """A spanning forest of the links among clustered documents: (a, b) by key."""
    places = stored(_places(found, percent, tokens), "tiles")
    tile, columns = ["cluster", "band"], ["cluster", "band", "block", "key", "role", "own", "component"]
    plain = places.withColumns({"role": F.when(F.col("key") == F.col("hub"), HUB).otherwise(HOST), "component": F.col("key")})
    # the hub of a tile that is cut goes to all its blocks
    many = F.when((F.col("role") == HUB) & (F.col("blocks") > 1), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(
        F.array("block"))
    links = stored(_links(rows, plain.withColumn("block", F.explode(many)).select(*columns), words, percent), "links")
    cut = places.filter("blocks > 1")
    if cut.isEmpty():
        return links
    group = stored(components(links), "groups")
    named = cut.join(group, "key", "left").withColumn("component", F.coalesce("component", "key"))
    of_hub = named.filter(F.col("key") == F.col("hub")).select(*tile, F.col("component").alias("joined"))
    apart = stored(named.join(of_hub, tile).filter("component != joined").drop("joined"), "apart")
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    visits = apart.select("cluster", "band", "key", "own", "component", F.col("block").alias("home"), others).filter(
        "block != home").withColumn("role", F.lit(VISITOR)).select(*columns)
    hosts = named.join(apart.select(*tile).distinct(), tile, "left_semi").withColumn("role", F.lit(HOST)).select(*columns)
    return links.unionByName(stored(_links(rows, hosts.unionByName(visits), words, percent), "links"))


def linked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT,
           tokens: int = TOKENS) -> DataFrame:
    """key, id, n_shingles, component (a key), component_id: one row per row of ``docs``."""
    rows = keyed(docs, id_col, text_col)
    drawn = stored(sketches(rows, words, percent), "sketches")
    marks = ["n", "mark1", "mark2"]
    each = drawn.select("key", *marks).distinct()
    classes = stored(each.filter("n > 0").groupBy(*marks).agg(F.min("key").alias("class"), F.count("*").alias("copies")), "classes")
    # documents of a class beyond its first one: they need no comparison
    shared = classes.filter("copies > 1").select(*marks, "class")
    copies = stored(each.join(shared, marks).filter("key != class").select("key", "class"), "copies")
    posted = drawn.filter("n > 0").select("key", "n", "posted").dropDuplicates(["key"]) if _repeats(drawn) else \
        drawn.filter("n > 0").select("key", "n", "posted")
    posted = posted.join(sized(copies.select("key"), KEYS), "key", "left_anti")
    found = clusters(listings(posted, percent))
    group = stored(components(tile_links(rows, found, words, percent, tokens)), "groups")
    # only what is a copy or linked has another component than itself
    of_copies = copies.join(group.withColumnRenamed("key", "class"), "class", "left").select(
        "key", F.coalesce("component", "class").alias("component"))
    moved = stored(of_copies.unionByName(group).filter("key != component"), "moved")
    ids = rows.select("key", "id").distinct()
    named = moved.join(ids.withColumnsRenamed({"key": "component", "id": "component_id"}), "component")
    sizes = rows.select("key", "id").join(each.select("key", F.col("n").alias("n_shingles")), "key")
    return sizes.join(named, "key", "left").select(
        "key", "id", "n_shingles", F.coalesce("component", "key").alias("component"),
        F.when(F.col("component").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))


def _repeats(drawn: DataFrame) -> bool:
    """Whether some key stands in several rows, as rows that repeat id and text do."""
    return not drawn.groupBy("key").count().filter("count > 1").isEmpty()


@query("op11_jaccard_join")
def op11(spark, sf_dir):
    return linked(table(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "n_shingles", "component_id")
