"""Isolation forest per device: a sample of its own for every tree, scoring spread over rows.

Tree t of a device takes the ``SAMPLE`` complete rows with the smallest hash of (row, t), whatever the number of
rows; every row can be in any tree. Of a large device only rows whose hash for some tree lies under a
threshold leave their task, about ``DRAWN`` per tree, and the exact cut follows where the trees are grown.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.numeric import known_numbers
from ..session import checkpointed, written

TREES = 100
SAMPLE = 256
# Rows expected under a tree's threshold. That fewer than SAMPLE are found has a chance below 1e-15.
DRAWN = SAMPLE + 10 * 16
SEED = 42
MIN_ROWS = 20
ROWS_PER_TASK = 100_000
SCORE_DIGITS = 6
CHUNK = 2048
EULER_GAMMA = 0.5772156649015329


def average_path(n: np.ndarray) -> np.ndarray:
    """Mean depth of an unsuccessful search among n rows."""
    n = np.asarray(n, dtype="float64")
    big = np.where(n > 2, n, 3.0)
    path = 2.0 * (np.log(big - 1.0) + EULER_GAMMA) - 2.0 * (big - 1.0) / big
    return np.where(n > 2, path, np.where(n == 2, 1.0, 0.0))


def grow_forest(samples: np.ndarray, rng: np.random.Generator):
    """Grow all trees together, one level at a time, each from its own sample (trees x rows x features).

    Node k has children 2k+1 and 2k+2. Returns per tree and node the split
    feature (-1 in a leaf), the split value and the path length of a leaf.
    """
    trees, size, features = samples.shape
    depth = max(1, math.ceil(math.log2(max(size, 2))))
    nodes = 2 ** (depth + 1) - 1
    data = samples.reshape(trees * size, features)
    tree = np.repeat(np.arange(trees), size)
    node = np.zeros(trees * size, dtype="int64")
    feature = np.full((trees, nodes), -1, dtype="int8")
    cut = np.zeros((trees, nodes))
    path = np.zeros((trees, nodes))
    for level in range(depth + 1):
        group = tree * nodes + node
        order = np.argsort(group, kind="stable")
        ranked = group[order]
        starts = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
        ids, counts = ranked[starts], np.diff(np.append(starts, len(ranked)))
        at_tree, at_node = ids // nodes, ids % nodes
        path[at_tree, at_node] = level + average_path(counts)
        if level == depth:
            break
        tree, node, data = tree[order], node[order], data[order]
        low, high = np.minimum.reduceat(data, starts, axis=0), np.maximum.reduceat(data, starts, axis=0)
        spread = high > low
        open_ = spread.any(axis=1) & (counts > 1)
        # a uniform choice among the features that still vary in the node
        choice = np.where(spread, rng.random(spread.shape), -1.0).argmax(axis=1)
        rows_at = np.arange(len(ids))
        lo, hi = low[rows_at, choice], high[rows_at, choice]
        value = lo + rng.random(len(ids)) * (hi - lo)
        feature[at_tree[open_], at_node[open_]] = choice[open_]
        cut[at_tree[open_], at_node[open_]] = value[open_]
        where = np.repeat(rows_at, counts)
        keep = open_[where]
        tree, node, data, where = tree[keep], node[keep], data[keep], where[keep]
        if not len(node):
            break
        right = data[np.arange(len(node)), choice[where]] > value[where]
        node = 2 * node + 1 + right
    return feature, cut, path, size


def score_rows(x: np.ndarray, feature: np.ndarray, cut: np.ndarray, path: np.ndarray, size: int) -> np.ndarray:
    """2^(-mean path / expected path): near 1 for rows that isolate early."""
    trees, nodes = feature.shape
    depth = int(math.log2(nodes + 1)) - 1
    base = (np.arange(trees) * nodes)[:, None]
    total = np.zeros(len(x))
    for start in range(0, len(x), CHUNK):
        part = x[start:start + CHUNK]
        everyone = np.arange(len(part))[None, :]
        node = np.zeros((trees, len(part)), dtype="int64")
        for _ in range(depth):
            at = base + node
            split = feature.ravel()[at]
            right = part[everyone, np.maximum(split, 0)] > cut.ravel()[at]
            node = np.where(split >= 0, 2 * node + 1 + right, node)
        total[start:start + CHUNK] = path.ravel()[base + node].sum(axis=0, dtype="float64")
    expected = float(average_path(np.array([size]))[0]) or 1.0
    return np.power(2.0, -(total / trees) / expected)


def tree_hash(hashes: np.ndarray, tree: int) -> np.ndarray:
    """A hash of row and tree from the row's own (splitmix64)."""
    x = hashes.view(np.uint64) + np.uint64((tree + 1) * 0x9E3779B97F4A7C15 % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def smallest(x: np.ndarray, hashes: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` rows of the smallest hashes in order; rows with one hash (repeated ids) go by their features."""
    near = np.arange(len(x))
    if len(x) > size:
        near = np.flatnonzero(hashes <= np.partition(hashes, size - 1)[size - 1])
    return x[near[np.lexsort((*x[near].T[::-1], hashes[near]))[:size]]]


def tree_samples(x: np.ndarray, hashes: np.ndarray, trees: int = TREES, sample: int = SAMPLE) -> np.ndarray:
    """Samples of all trees (trees x rows x features) out of all rows of a device."""
    size = min(sample, len(x))
    return np.stack([smallest(x, tree_hash(hashes, t), size) for t in range(trees)])


def _forest(device, samples: np.ndarray, seed: int):
    """Trees of one device. Shifting and scaling a feature leave uniform splits
    unchanged, so the readings are used as they are."""
    return grow_forest(samples, np.random.default_rng([seed, zlib.crc32(str(device).encode())]))


def _matrix(rows: pa.Table, features: list[str]) -> np.ndarray:
    return np.column_stack([rows.column(f).to_numpy(zero_copy_only=False).astype("float64") for f in features])


def _with_scores(rows: pa.Table, x: np.ndarray, forest) -> pa.Table:
    whole = ~np.isnan(x).any(axis=1)
    out = np.zeros(len(x))
    if whole.any():
        out[whole] = np.round(score_rows(x[whole], *forest), SCORE_DIGITS)
    return rows.append_column("iforest_score", pa.array(out, pa.float64(), mask=~whole))


def _draw(key: str, features: list[str]):
    """(key, tree, hash, features) of the rows under a tree's threshold; a device's ``_whole`` complete rows set it."""
    def draw(batches):
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            hashes = rows.column("_hash").to_numpy()
            whole = rows.column("_whole").to_numpy().astype("float64")
            limit = np.minimum(DRAWN / np.maximum(whole, 1.0), 1.0) * (2.0**64 - 2.0**12)
            for t in range(TREES):
                own = tree_hash(hashes, t)
                at = pa.array(np.flatnonzero(own <= limit.astype(np.uint64)))
                if len(at):
                    part = rows.take(at).select([key, *features])
                    part = part.append_column("_tree", pa.array([t] * len(at), pa.int32()))
                    yield from part.append_column("_own", pa.array(own.view(np.int64)[at.to_numpy()])).to_batches()
    return draw


def _train(key: str, features: list[str], seed: int):
    """Exact samples out of what was drawn, then the trees of one device."""
    def train(pdf: pd.DataFrame) -> pd.DataFrame:
        cut = [smallest(own[features].to_numpy(dtype="float64"), own["_own"].to_numpy().view(np.uint64), SAMPLE)
               for _, own in pdf.groupby("_tree", sort=True)]
        rows = min(map(len, cut))
        feature, cuts, path, size = _forest(pdf[key].iloc[0], np.stack([c[:rows] for c in cut]), seed)
        return pd.DataFrame({
            key: [pdf[key].iloc[0]], "_trees": [feature.shape[0]], "_size": [size], "_feature": [feature.tobytes()],
            "_cut": [cuts.tobytes()], "_path": [path.tobytes()]})
    return train


def _score(features: list[str]):
    """Score one part of a large device with its model."""
    def score(rows: pa.Table, model: pa.Table) -> pa.Table:
        if not rows.num_rows or not model.num_rows:
            return rows.append_column("iforest_score", pa.array([0.0] * rows.num_rows, pa.float64()))
        m = {c: model.column(c)[0].as_py() for c in ("_trees", "_size", "_feature", "_cut", "_path")}
        arrays = [np.frombuffer(m[c], dtype=t).reshape(m["_trees"], -1)
                  for c, t in (("_feature", "int8"), ("_cut", "float64"), ("_path", "float64"))]
        return _with_scores(rows, _matrix(rows, features), (*arrays, m["_size"]))
    return score


def _train_and_score(key: str, features: list[str], seed: int):
    """Everything for one device of bounded size."""
    def run(rows: pa.Table) -> pa.Table:
        x = _matrix(rows, features)
        hashes = rows.column("_hash").to_numpy()
        rows = rows.drop_columns(["_hash"])
        whole = ~np.isnan(x).any(axis=1)
        if whole.sum() < MIN_ROWS:
            return rows.append_column("iforest_score", pa.array(np.zeros(len(x)), pa.float64()))
        return _with_scores(rows, x, _forest(rows.column(key)[0].as_py(), tree_samples(x[whole], hashes[whole]), seed))
    return run


def isolation_scores(df: DataFrame, key: str, row_id: str, features: list[str], seed: int = SEED,
                     rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Add ``iforest_score`` (higher is odder) to every row.

    Groups with fewer than 20 complete rows score 0; rows with a null feature in
    other groups score null. Every tree has a uniform sample of its own out of all complete rows. Groups of up to
    ``rows_per_task`` rows are trained and scored in one go. Larger ones are trained on what
    was drawn for their trees and scored in salted parts, each with a copy of the model; both
    ways give the same scores.
    """
    df = known_numbers(df, features)  # one rule for both ways: a null or NaN feature makes a row incomplete
    whole = F.lit(True)
    for f in features:
        whole = whole & F.col(f).isNotNull()
    out = T.StructType([*df.schema.fields, T.StructField("iforest_score", T.DoubleType())])
    hashed = df.withColumn("_hash", F.xxhash64(F.col(row_id), F.lit(seed)))
    sizes = checkpointed(
        df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"), F.count_if(whole).alias("_whole")))
    large = sizes.filter(F.col("_rows") > rows_per_task)
    # Growing trees costs time, not bytes: fix the number of tasks, or small shuffles would be merged into few.
    total = sizes.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]
    shuffle = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(shuffle, math.ceil(total / rows_per_task))
    if large.isEmpty():
        spread = hashed.repartition(tasks, key)
        return written(spread.groupBy(key).applyInArrow(_train_and_score(key, features, seed), out), "scores")

    # at most total/rows_per_task groups are large, so that list is safe to broadcast
    large = F.broadcast(large)
    small_rows = hashed.join(large.select(key), key, "left_anti").repartition(tasks, key)
    small_scored = small_rows.groupBy(key).applyInArrow(_train_and_score(key, features, seed), out)

    big_rows = hashed.join(large, key)
    kind = df.schema[key].dataType.simpleString()
    wide = ", ".join(f"`{f}` double" for f in features)
    complete = big_rows.filter(whole & (F.col("_whole") >= MIN_ROWS)).select(
        key, *[F.col(f).cast("double").alias(f) for f in features], "_hash", "_whole")
    drawn = complete.mapInArrow(_draw(key, features), f"{key} {kind}, {wide}, _tree int, _own long")
    model = f"{key} {kind}, _trees int, _size int, _feature binary, _cut binary, _path binary"
    models = drawn.groupBy(key).applyInPandas(_train(key, features, seed), model)

    parts = F.ceil(F.col("_rows") / F.lit(float(rows_per_task)))
    part = F.pmod(F.xxhash64(F.lit("part"), F.col(row_id)), parts)
    salted_rows = big_rows.withColumn("_part", part).select(*df.columns, "_part")
    salted_models = models.join(large.select(key, parts.alias("_parts")), key).withColumn(
        "_part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_parts") - 1))).drop("_parts")
    with_part = T.StructType([*salted_rows.schema.fields, T.StructField("iforest_score", T.DoubleType())])
    big_scored = salted_rows.groupBy(key, "_part").cogroup(salted_models.groupBy(key, "_part")).applyInArrow(
        _score(features), with_part)
    return written(small_scored.unionByName(big_scored.drop("_part")), "scores")
