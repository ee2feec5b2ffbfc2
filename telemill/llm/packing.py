"""Best-fit packing of token pieces with matching of large items.

Pieces over a third of the capacity are matched first, the longest with the
longest that fits beside it, so at most two share a sequence. Shorter pieces,
longest first, then go into the smallest gap that takes them; a new sequence is
opened only where no gap does.

How many pieces have which length is all the plan needs: at most ``capacity``
counts, whatever the size of the corpus. The driver plans whole runs of equal
sequences from these counts; which piece takes which place follows from its rank
among the pieces of its length, found in salted blocks so that no length, however
common, is ranked in one task.

Edge cases: a null or empty text is one piece with the end id alone. Repeated rows
(or ids) are packed as they come, each its own piece. An empty table gives no
rows. Only id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import bisect
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from .common import query, row_slices, stored, table
from .tokens import default_path, word_tokenizer

CAPACITY = 4096
END_ID = 1
#: Pieces of one length that are ranked together.
BLOCK = 2048
#: Bytes of text a task tokenizes at once.
SLICE = 4 << 20


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
           tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """id, piece, start, length, ids_crc32 (and ids as little-endian binary if asked for) of each piece."""
    path = tokenizer or default_path()
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    schema = f"id {kind}, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")

    def cut(batches):
        words = word_tokenizer(path)
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            for lo, hi in _slices(texts):
                part = texts.slice(lo, hi - lo)
                ids, bounds = words.ids(part)
                row, piece, start, length, crc, kept = [], [], [], [], [], []
                for i in range(hi - lo):
                    doc = np.append(ids[bounds[i]:bounds[i + 1]], END_ID).astype("<u4")
                    for k, at in enumerate(range(0, len(doc), capacity)):
                        own = doc[at:at + capacity].tobytes()
                        row.append(lo + i)
                        piece.append(k)
                        start.append(at)
                        length.append(len(own) // 4)
                        crc.append(zlib.crc32(own))
                        if with_ids:
                            kept.append(own)
                columns = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                           pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                names = ["id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array(kept, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(cut, schema)


def _slices(texts: pa.Array):
    size = np.concatenate([[0], np.cumsum(np.asarray(pc.binary_length(texts), np.int64))])
    return row_slices(len(texts), size, SLICE)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Places for all pieces, from the number of pieces of each length.

    Rows (length, first rank, first sequence, pieces per sequence, offset of the
    first): pieces of ``length`` from that rank on fill sequence after sequence.
    Every step uses up a length or a run of equal sequences, so there are a few
    times ``capacity`` rows at most.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    runs: list[tuple[tuple, int, int]] = []  # ((length, times), ...), gap, sequences
    lengths = sorted(left)
    large = [n for n in lengths if 3 * n > capacity]
    while large:
        n = large[-1]
        fit = bisect.bisect_right(large, capacity - n)
        mate = large[fit - 1] if fit else None
        if mate == n and left[n] < 2:
            mate = large[fit - 2] if fit > 1 else None
        if mate is None:
            runs.append((((n, 1),), capacity - n, left[n]))
            left[n] = 0
        elif mate == n:
            runs.append((((n, 2),), capacity - 2 * n, left[n] // 2))
            left[n] %= 2
        else:
            both = min(left[n], left[mate])
            runs.append((((n, 1), (mate, 1)), capacity - n - mate, both))
            left[n] -= both
            left[mate] -= both
        large = [x for x in large if left[x]]
    gaps: dict[int, list] = {}
    for items, gap, n in runs:
        gaps.setdefault(gap, []).append((items, n))
    order = sorted(gaps)
    full: list[tuple[tuple, int]] = []

    def put(gap: int, items: tuple, n: int) -> None:
        if n:
            if gap not in gaps:
                gaps[gap] = []
                bisect.insort(order, gap)
            gaps[gap].append((items, n))

    for n in reversed([x for x in lengths if 3 * x <= capacity]):
        while left[n]:
            k = bisect.bisect_left(order, n)
            if k < len(order):
                gap = order[k]
                items, room = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap]
                    order.pop(k)
            else:
                gap, items, room = capacity, (), left[n]
            times = gap // n
            whole = min(room, left[n] // times)
            rest = left[n] - whole * times if whole < room else 0
            rest = min(rest, times - 1)
            put(gap - times * n, (*items, (n, times)), whole)
            left[n] -= whole * times
            if rest and whole < room:
                put(gap - rest * n, (*items, (n, rest)), 1)
                left[n] -= rest
                whole += 1
            if items:
                put(gap, items, room - whole)
    rank: dict[int, int] = {}
    rows, sequence = [], 0
    for gap in sorted(gaps):
        full += gaps[gap]
    for items, n in full:
        offset = 0
        for length, times in items:
            rows.append((length, rank.get(length, 0), sequence, times, offset))
            rank[length] = rank.get(length, 0) + n * times
            offset += length * times
        sequence += n
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to written pieces (columns id, piece, length and any others)."""
    counts = {r.length: r.n for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = plan(counts, capacity)
    salts = max(1, -(-max(counts.values(), default=0) // BLOCK))
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("id", "piece", "ids_crc32"), F.lit(salts)).cast("int"))
    block = Window.partitionBy("length", "salt")
    ranked = salted.withColumn("at", F.row_number().over(block.orderBy("id", "piece", "ids_crc32")).cast("long"))
    sums = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1))
    starts = sums.select("length", "salt", F.coalesce(before, F.lit(0)).alias("first"))
    ranked = ranked.join(starts, ["length", "salt"]).withColumn("rank", F.col("first") + F.col("at") - 1).drop(
        "salt", "at", "first")
    names = [c for c in ranked.columns if c != "rank"]
    schema = ", ".join(f"`{c}` {t}" for c, t in ranked.select(names).dtypes) + ", sequence_id long, offset long"
    keys = (places[:, 0] << 44) + places[:, 1]

    def place(batches):
        for batch in batches:
            length = np.asarray(batch.column("length"))
            rank = np.asarray(batch.column("rank"))
            _, first, sequence, times, offset = places[np.searchsorted(keys, (length << 44) + rank, "right") - 1].T
            nth = rank - first
            columns = [batch.column(c) for c in names]
            columns += [pa.array(sequence + nth // times), pa.array(offset + nth % times * length)]
            yield pa.RecordBatch.from_arrays(columns, [*names, "sequence_id", "offset"])

    return ranked.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                   tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their places; tokenized once, into the shared folder."""
    cut = stored(pieces(docs, id_col, text_col, capacity, tokenizer, with_ids), "pieces")
    return pack(cut, capacity).withColumnRenamed("id", id_col)


@query("op5_best_fit_packing")
def op5(spark, sf_dir):
    return pack_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
