"""Helpers that several corpus operators share: tables, written intermediates, row keys, row counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import new_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, and its SQL where there is one."""
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(column: str) -> str:
    """A column's name for schemas and expressions, whatever characters it has."""
    return "`" + column.replace("`", "``") + "`"


def named(column: str) -> Column:
    """A column by its whole name."""
    return F.col(quoted(column))


def plain_names(df: DataFrame) -> DataFrame:
    """The same columns as c0, c1, ...: Spark's Python functions take no column with a backtick in its name."""
    return df.select(*[named(c).alias(f"c{i}") for i, c in enumerate(df.columns)])


def own_names(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns by place, under their own names again."""
    return df.toDF(*columns)


def stored(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write to the shared folder and read back: computed once, pruned on reading, safe from lost executors.

    Large row sets that stay until the end of a job may ask for the denser ``zstd``.
    """
    path = new_folder(df.sparkSession, name)
    # Spark drops the shuffle files of ended jobs when the driver collects its garbage: do so before more are written
    df.sparkSession.sparkContext._jvm.System.gc()
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_slices(n: int, offsets, limit: int):
    """Cut rows 0..n into runs of about ``limit`` bytes each, one row at least."""
    lo = 0
    while lo < n:
        hi = lo + 1
        while hi < n and offsets[hi + 1] - offsets[lo] <= limit:
            hi += 1
        yield lo, hi
        lo = hi


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Columns key (long, unique per document, in id order), id, text.

    Ids that are whole numbers, without null and unique, are the keys themselves.
    Else distinct (id, text) pairs are numbered by id, nulls last, then by a hash
    of the text; rows that repeat both are one document and share a key.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    whole = dict(docs.select(id_col).dtypes)[id_col] in ("bigint", "int", "smallint", "tinyint")
    # one narrow aggregate: ids are grouped map-side, so repeated ids do not pile up
    if whole:
        most, empty = rows.groupBy("id").agg(F.count("*").alias("n")).agg(
            F.max("n"), F.max(F.col("id").isNull())).first()
        if (most or 0) <= 1 and not empty:
            return rows.select(F.col("id").cast("long").alias("key"), "id", "text")
    mark = rows.select("id", F.xxhash64("text").alias("mark")).distinct()
    numbers = numbered(mark, [F.col("id").asc_nulls_last(), F.col("mark").asc()], "key")
    return rows.withColumn("mark", F.xxhash64("text")).alias("r").join(
        numbers.alias("m"), F.expr("r.id <=> m.id AND r.mark = m.mark")).select("m.key", "r.id", "r.text")


def numbered(df: DataFrame, order: list, name: str) -> DataFrame:
    """Add 0, 1, 2 ... in the given order without bringing the rows to one task.

    Rows are range-partitioned and written; each partition counts its rows, and
    only these counts (one row per partition) are summed up in order.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = stored(df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()), "numbered")
    counts = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("_part", F.coalesce(before, F.lit(0)).alias("_from"))
    at = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return ranged.withColumn("_at", at).join(F.broadcast(starts), "_part").withColumn(
        name, F.col("_from") + F.col("_at") - 1).drop("_part", "_at", "_from")
