"""Exact dedup by progressive refinement: length, then prefix hash, then full hash.

Texts are equal when they are identical after each run of white space
(tab to carriage return, blank) became one blank. Null counts as empty.

Edge cases: empty texts form one group like any other text. A null id comes
after every other id, so such a row stays only where its whole group has no id.
Rows that repeat both id and text are one document: ``assign`` gives each the
same line, ``filter`` keeps one of them. An empty table gives no rows. Other
columns, whatever their names, pass through ``filter`` unchanged. Texts of any length are hashed whole.

Each step looks only at the rows that the one before left: lengths alone first, prefixes of rows with a shared
length, full hashes of rows with a shared prefix. Shared lengths and prefixes are measured; where they are few
they are sent to the rows, and no text moves or is hashed that has no partner. Where they are
many, texts are hashed before the join instead, for moving them would cost more. ``assign`` reports the hash of
every text and so hashes all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.joins import sized
from ..session import checkpointed
from .common import named, query, table

#: Characters of the normalised text in the prefix hash.
PREFIX_CHARS = 256
#: (size, prefix) pairs and groups that are sent to all rows at most; about 100 bytes each.
FEW = 200_000


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, the normalised text, which later steps prune or hash in place, and its size."""
    rows = docs.select(named(id_col).alias("id"), normalised(named(text_col)).alias("norm"))
    return rows.withColumn("size", F.length("norm"))


def _prefix() -> Column:
    return F.xxhash64(F.substring("norm", 1, PREFIX_CHARS))


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(size, prefix) pairs held by more than one row.

    Sizes and prefixes are counted with combining before the shuffle, so a hot
    group sends one row per task. Lengths come first and alone: prefixes are
    taken only of rows whose length is shared.
    """
    rows = _rows(docs, id_col, text_col)
    sizes = sized(rows.groupBy("size").agg(F.count("*").alias("n")).filter("n > 1").select("size"), FEW)
    alike = rows.join(sizes, "size", "left_semi").select("size", _prefix().alias("prefix"))
    return alike.groupBy("size", "prefix").agg(F.count("*").alias("n")).filter("n > 1").select("size", "prefix")


def _shared(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, bool]:
    """The candidates, computed once, and whether they are few enough to be sent to the rows."""
    shared = checkpointed(candidates(docs, id_col, text_col))
    few = shared.count() <= FEW
    return (F.broadcast(shared) if few else shared), few


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           shared: tuple[DataFrame, bool] | None = None) -> DataFrame:
    """One row per text that several rows hold: size, prefix, sha, keep_id, group_size, keep_copies.

    ``keep_copies`` counts the rows that carry the id which stays.
    """
    pairs, few = shared or _shared(docs, id_col, text_col)
    rows = _rows(docs, id_col, text_col).withColumn("prefix", _prefix())
    sha = F.sha2("norm", 256).alias("sha")
    if few:
        alike = rows.join(pairs, ["size", "prefix"], "left_semi").select("id", "size", "prefix", sha)
    else:  # the hash is computed before the rows move, so texts never do
        alike = rows.select("id", "size", "prefix", sha).join(pairs, ["size", "prefix"], "left_semi")
    by_id = alike.groupBy("size", "prefix", "sha", "id").agg(F.count("*").alias("n"))
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "n")).alias("first")
    return by_id.groupBy("size", "prefix", "sha").agg(first, F.sum("n").alias("group_size")).filter(
        "group_size > 1").select("size", "prefix", "sha", F.col("first.id").alias("keep_id"), "group_size",
                                 F.col("first.n").alias("keep_copies"))


def assign(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256."""
    rows = _rows(docs, id_col, text_col).select("id", F.sha2("norm", 256).alias("sha"))
    found = sized(groups(docs, id_col, text_col).select("sha", "keep_id", "group_size"), FEW)
    several = F.col("group_size").isNotNull()
    keep = F.when(several, F.col("keep_id")).otherwise(F.col("id"))
    return rows.join(found, "sha", "left").select(
        F.col("id").alias(id_col), keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.col("id").eqNullSafe(keep).alias("kept"), F.col("sha").alias("text_sha256"))


def filter(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they are: one row per distinct text."""
    columns = docs.columns
    inner = docs.select(*[named(c).alias(f"c{i}") for i, c in enumerate(columns)])
    i, t = (f"c{columns.index(c)}" for c in (id_col, text_col))
    pairs, few = _shared(docs, id_col, text_col)
    norm = normalised(F.col(t))
    if few:  # a text without a partner is never hashed
        inner = inner.withColumn("norm", norm).withColumns({"size": F.length("norm"), "prefix": _prefix()}).join(
            pairs.withColumn("several", F.lit(True)), ["size", "prefix"], "left").withColumn(
            "_sha", F.when(F.col("several"), F.sha2("norm", 256))).drop("norm", "size", "prefix", "several")
    else:
        inner = inner.withColumn("_sha", F.sha2(norm, 256))
    found = sized(groups(docs, id_col, text_col, (pairs, few)).select(F.col("sha").alias("_sha"), "keep_id", "keep_copies"), FEW)
    joined = inner.join(found, "_sha", "left").filter(
        F.col("keep_copies").isNull() | F.col(i).eqNullSafe(F.col("keep_id")))
    single = joined.filter("coalesce(keep_copies, 1) = 1")
    # rows that repeat an id that stays: few, and combined before their shuffle
    repeated = joined.filter("keep_copies > 1").dropDuplicates(["_sha"])
    return single.unionByName(repeated).select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(columns)])


SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
FROM t WINDOW same AS (PARTITION BY norm)
"""


@query("op10_exact_dedup", SQL)
def op10(spark, sf_dir):
    return assign(table(spark, sf_dir, "documents"))
